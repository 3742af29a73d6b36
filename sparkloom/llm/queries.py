"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import common as C
from . import ann, decontaminate, lines, mixing, quality, simhash, suffix, tokens, toxicity, warc


def op1_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(C.load(spark, sf_dir, "documents"))


def op2_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return tokens.digest(C.load(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=2)


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(C.load(spark, sf_dir, "documents"), C.load(spark, sf_dir, "labels"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.digest(C.load(spark, sf_dir, "documents"))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.digest(C.load(spark, sf_dir, "documents"), C.load(spark, sf_dir, "benchmark"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.digest(C.load(spark, sf_dir, "documents"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.digest(C.load(spark, sf_dir, "pages"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.grade(C.load(spark, sf_dir, "documents"), C.load(spark, sf_dir, "labels"))


def op9_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(C.load(spark, sf_dir, "embeddings"))


def op10_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.digest(C.load(spark, sf_dir, "documents"))


QUERIES = {"op1_mix": op1_mix, "op2_tokens": op2_tokens, "op3_quality": op3_quality, "op4_simhash": op4_simhash, "op5_decontaminate": op5_decontaminate, "op6_line_dedup": op6_line_dedup, "op7_warc": op7_warc, "op8_toxicity": op8_toxicity, "op9_ann": op9_ann, "op10_suffix": op10_suffix}
ORACLES = {"op1_mix": mixing.SQL, "op6_line_dedup": lines.SQL, "op7_warc": warc.SQL}
