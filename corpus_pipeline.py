"""Corpus pipeline: toxicity filter, near-dedup, decontamination, mixing, token output.

Every stage takes (spark, docs, sf_dir) and returns a frame that is written as Parquet and read again as the next
stage's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from sparkloom.llm import common as C
from sparkloom.llm import decontaminate, mixing, simhash, tokens, toxicity

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
END_ID = 2


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose expected severity is below the threshold."""
    return toxicity.keep_clean(docs, C.load(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of exact and near copies."""
    return simhash.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.keep_clean(docs, C.load(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out so that sources meet their target weights, dealt out in hash order."""
    return mixing.mix(docs, marks=False)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token records in ascending doc_id order, read back: doc_id, start, n_tokens, ids_crc32."""
    return tokens.digest(docs, TOKENIZER, END_ID)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("token_output", write_tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = C.load(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = C.materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


#: Learned scores, fingerprints and the tokenizer are beyond SQL; tests/llm/test_pipeline.py holds a brute-force version.
ORACLE_SQL = None
