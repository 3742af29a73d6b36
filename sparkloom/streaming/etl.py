"""Streaming forms: completion barrier, file source, micro-batch encoding with exactly-once shards."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions import draws as D
from ..storage import shared_root


def _scratch(spark: SparkSession, name: str) -> str:
    return f"{shared_root(spark)}/stream/{name}-{uuid.uuid4().hex[:10]}"


def barrier_stream(messages: DataFrame, forget_ms: int | None = None) -> DataFrame:
    """(key, n) once all chunks of a key have come, in whatever order.

    messages: key string, chunk_idx int (null for the end message), expected int (set on the end message). Chunks that
    come again do not count twice; a key is reported once. The state holds the chunks of open keys; of a reported key
    only a mark stays. With ``forget_ms``, which needs a watermark on the messages, the mark goes when event time has
    moved on by that much (chunks that come again later than that would open the key anew).
    """
    timeout = GroupStateTimeout.NoTimeout if forget_ms is None else GroupStateTimeout.EventTimeTimeout

    def keep_mark(state: GroupState) -> None:
        if forget_ms is not None:
            state.setTimeoutTimestamp(max(state.getCurrentWatermarkMs(), 0) + forget_ms)

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        expected, seen, done = state.get if state.exists else (-1, [], False)
        if state.hasTimedOut:
            state.remove()
            return
        if done:
            keep_mark(state)
            return
        have = set(seen)
        for pdf in frames:
            have |= {int(c) for c in pdf["chunk_idx"].dropna()}
            ends = pdf["expected"].dropna()
            if len(ends):
                expected = max(expected, int(ends.max()))
        if 0 <= expected <= len(have):
            state.update((expected, [], True))
            keep_mark(state)
            yield pd.DataFrame({"key": [key[0]], "n": [len(have)]})
        else:
            state.update((expected, sorted(have), False))

    return messages.groupBy("key").applyInPandasWithState(step, "key string, n long", "expected int, seen array<int>, done boolean", "append", timeout)


def run_once(stream: DataFrame, name: str, mode: str = "append") -> DataFrame:
    """Process what is there, write Parquet with a checkpoint, and read the result."""
    spark = stream.sparkSession
    path = _scratch(spark, name)
    if mode == "append":
        q = stream.writeStream.format("parquet").option("path", f"{path}/out").option("checkpointLocation", f"{path}/log").outputMode("append").trigger(availableNow=True).start()
    else:
        q = stream.writeStream.foreachBatch(lambda df, _: df.write.mode("overwrite").parquet(f"{path}/out")).option("checkpointLocation", f"{path}/log").outputMode(mode).trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{path}/out")


def table_stream(spark: SparkSession, path: str, files_per_trigger: int = 1) -> DataFrame:
    """A Parquet file or folder as a stream of files."""
    schema = spark.read.parquet(path).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path + "*")


def barrier_over_table(spark: SparkSession, path: str) -> DataFrame:
    """The barrier over conversations: turns are chunks, a last turn also says how many there are."""
    rows = table_stream(spark, path)
    last = spark.read.parquet(path).groupBy("conv_id").agg((F.max("turn") + 1).cast("int").alias("n"))
    chunks = rows.join(last, "conv_id").select(F.col("conv_id").cast("string").alias("key"), F.col("turn").cast("int").alias("chunk_idx"), F.when(F.col("turn") + 1 == F.col("n"), F.col("n")).alias("expected"))
    return run_once(barrier_stream(chunks), "barrier")


def daily_counts_over_table(spark: SparkSession, path: str) -> DataFrame:
    """Event-time counts by day and type with a watermark."""
    rows = table_stream(spark, path).withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", "1 day")
    out = rows.groupBy(F.window("ts", "1 day"), "event_type").agg(F.count(F.lit(1)).alias("n"))
    return run_once(out.select(F.col("window.start").alias("day"), "event_type", "n"), "daily", "complete")


def sessions(events: DataFrame, key: str, gap: str) -> DataFrame:
    """Session windows of a stream or table with a timestamp column ts."""
    return events.groupBy(key, F.session_window("ts", gap)).agg(F.count(F.lit(1)).alias("n"))


def encode_stream(chunks: DataFrame, encode: Callable[[pd.DataFrame], pd.DataFrame], schema: str, path: str, policy: str = "skip", batched: bool = False):
    """A query that encodes micro-batches into ``path/data/batch=<id>``; failures go to ``path/errors`` or, with the
    policy 'fail', end the query. With ``batched`` the encoder, which must then refuse frames with any row it cannot
    encode, gets whole frames first and single rows only of refused ones. A batch that runs again overwrites its own folder, so nothing is lost or doubled."""

    def safe(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            if batched:
                try:
                    yield encode(pdf).assign(error=None, failed_key=None)
                    continue
                except Exception:
                    if policy == "fail":
                        raise
            for k in range(len(pdf)):
                one = pdf.iloc[k : k + 1]
                try:
                    yield encode(one).assign(error=None, failed_key=None)
                except Exception as e:
                    if policy == "fail":
                        raise
                    yield pd.DataFrame({"error": [repr(e)], "failed_key": [str(one.iloc[0, 0])]})

    def write(df: DataFrame, batch: int) -> None:
        names = [c.split()[0] for c in schema.split(",")]
        spark = df.sparkSession
        whole = lambda x: x.reindex(columns=[*names, "error", "failed_key"]).astype(object).where(lambda v: v.notna(), None)
        out = df.mapInPandas(lambda it: (whole(x) for x in safe(it)), schema + ", error string, failed_key string")
        staged = f"{path}/staged/batch={batch}"
        out.write.mode("overwrite").parquet(staged)
        done = spark.read.parquet(staged)
        done.filter("error is null").drop("error", "failed_key").write.mode("overwrite").parquet(f"{path}/data/batch={batch}")
        done.filter("error is not null").select("failed_key", "error").write.mode("overwrite").json(f"{path}/errors/batch={batch}")

    return chunks.writeStream.foreachBatch(write).option("checkpointLocation", f"{path}/log").trigger(availableNow=True).start()


def resampled_stream(df: DataFrame, key: str, per_second: int, seed: int = 0) -> DataFrame:
    """An endless stream of draws with replacement: draw, epoch and all columns. An epoch is as many draws as df has
    rows; every draw follows from its number."""
    n = df.count()
    draws = df.sparkSession.readStream.format("rate").option("rowsPerSecond", per_second).load().select(F.col("value").alias("draw"))
    place = F.least(F.floor(D.uniform(F.col("draw"), f"{seed}.draw") * n), F.lit(n - 1)).cast("long")
    return draws.withColumns({"epoch": F.floor(F.col("draw") / max(n, 1)), "__n": place}).join(D.numbered(df, key), "__n").drop("__n")


class Telemetry(StreamingQueryListener):
    """The last progress of each query, kept at most once in ``every`` seconds; ends and failures are always kept."""

    def __init__(self, every: float = 5.0):
        self.every, self.last, self._at = every, {}, {}

    def onQueryStarted(self, event) -> None:
        self.last[str(event.id)] = {"state": "started", "name": event.name}

    def onQueryProgress(self, event) -> None:
        p, now = event.progress, time.monotonic()
        key = str(p.id)
        if now - self._at.get(key, -self.every) >= self.every:
            self._at[key] = now
            self.last[key] = {"state": "running", "name": p.name, "batch": p.batchId, "rows": p.numInputRows, "rows_per_second": p.processedRowsPerSecond}

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        key = str(event.id)
        self.last[key] = {**self.last.get(key, {}), "state": "failed" if event.exception else "ended", "error": event.exception}


def micro_batches(df: DataFrame, keys: list[str], order: str, size: int, idle: Column | None = None) -> DataFrame:
    """df with batch: groups of at most ``size`` rows in order; where ``idle`` holds, a new group begins."""
    w = Window.partitionBy(*keys).orderBy(order)
    gap = F.sum(F.coalesce(idle, F.lit(False)).cast("int")).over(w) if idle is not None else F.lit(0)
    out = df.withColumn("__g", gap)
    place = F.row_number().over(Window.partitionBy(*keys, "__g").orderBy(order)) - 1
    return out.withColumn("batch", F.struct("__g", F.floor(place / size).cast("int").alias("k"))).drop("__g")


def round_robin(df: DataFrame, workers: int) -> DataFrame:
    return df.repartition(workers)


def unresolved(messages: DataFrame) -> DataFrame:
    """key, expected, n of keys that are not complete; empty after a clean end."""
    got = messages.groupBy("key").agg(F.max("expected").alias("expected"), F.count_distinct("chunk_idx").alias("n"))
    return got.filter("expected is null or n < expected")


def assert_resolved(messages: DataFrame) -> None:
    left = unresolved(messages).limit(5).collect()
    if left:
        raise RuntimeError(f"keys are not complete, such as {[r['key'] for r in left]}")
