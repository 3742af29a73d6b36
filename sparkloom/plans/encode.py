"""Batch pre-encode plan: manifest, shard, resume, split, chunks, encode, completion, records."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import draws as D
from ..functions import text as T
from ..operators import records as R
from ..operators import windows as W


def plan_chunks(manifest: DataFrame, done: DataFrame, n_samples: str, chunk: int, rate: int, val_ratio: float, n_shards: int = 1, shard: int = 0) -> DataFrame:
    """One row a chunk of the rows still to do: row_base, split, chunk_idx, num_chunks, valid, seconds, prompt, tempo.

    Filters come before any decoding, and the anti-join on finished rows before the chunks."""
    rows = R.row_context(manifest, "audio_s3_uri", chunk / rate)
    rows = rows.withColumn("row_base", T.output_base(F.col("sample_id"), F.col("audio_s3_uri")))
    rows = rows.filter(F.pmod(F.xxhash64("row_base"), F.lit(n_shards)) == shard) if n_shards > 1 else rows
    rows = R.resume(rows, done.select(F.col("key").alias("row_base"), "status"), "row_base")
    rows = rows.withColumn("split", D.split("row_base", val_ratio))
    rows = rows.withColumn("base", R.base_conditioning(F.col("one_line_caption"), F.col("dense_caption"), F.col("vivid_caption"), F.col("tempo"))).drop("tempo")
    out = W.chunks(rows, F.col(n_samples), chunk).withColumns({"num_chunks": F.ceil(F.col(n_samples) / chunk).cast("int"), "seconds_start": F.col("chunk_start") / rate, "seconds_total": F.col(n_samples) / rate, "chunk_seconds": F.lit(chunk / rate)})
    return R.chunk_metadata(out).select("row_base", "split", "chunk_idx", "num_chunks", "valid", "seconds_start", "seconds_total", "timestamps", "normalized_track_position", "base.prompt", "base.tempo")


def encode(chunks: DataFrame, model: Callable, schema: str) -> DataFrame:
    """An opaque encoder over Arrow batches."""
    return chunks.mapInPandas(model, schema)


def completed(encoded: DataFrame) -> DataFrame:
    """The chunks of rows all of whose chunks are there."""
    ok = R.barrier(encoded, "row_base", F.col("num_chunks"))
    return encoded.join(ok.select("row_base"), "row_base", "left_semi")
