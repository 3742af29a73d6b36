"""Chunks, stitching, frames, spans, recurrences and packing over ordered rows."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import arrays as A
from ..functions import draws as D
from ..functions.schedules import ema_decay


def chunks(df: DataFrame, n: Column, c: int) -> DataFrame:
    """df exploded to chunk_idx, chunk_start, valid; rows of length 0 vanish."""
    return df.withColumn("__c", F.explode(A.chunk_plan(n, c))).select("*", F.col("__c.idx").alias("chunk_idx"), F.col("__c.start").alias("chunk_start"), F.col("__c.valid").alias("valid")).drop("__c")


def stitch(df: DataFrame, key: str, text: str, c: int, overlap: int) -> DataFrame:
    """key, stitched: a text cut into overlapping chunks and put together again, later chunks over earlier ones."""
    half, n = overlap // 2, F.char_length(text)
    plan = df.select(key, text, A.overlap_starts(n, c, overlap).alias("__s"), F.least(n, F.lit(c)).alias("__n"))

    def part(start: Column, k: Column) -> Column:
        lo = F.when(k == 0, 0).otherwise(half)
        hi = F.when(k == F.size("__s") - 1, F.col("__n")).otherwise(c - half)
        return F.struct(k.alias("k"), start.alias("start"), lo.alias("lo"), hi.alias("hi"), F.substring(text, start + 1, F.lit(c)).alias("chunk"))

    # chunks are cut before rows are made of them, so that no row but a text's own holds the text
    parts = plan.select(key, F.explode(F.transform("__s", part)).alias("__x")).groupBy(key).agg(F.array_sort(F.collect_list("__x")).alias("__x"))

    def piece(x: Column, i: Column) -> Column:
        """Up to where the next chunk begins to overwrite."""
        following = F.get("__x", i + 1)
        end = F.coalesce(F.least(x["hi"], following["start"] + following["lo"] - x["start"]), x["hi"])
        return F.substring(x["chunk"], x["lo"] + 1, end - x["lo"])

    return parts.select(key, F.array_join(F.transform("__x", piece), "").alias("stitched"))


def band(keys: list[str], order: list[str], left: int, right: int):
    """Window over the rows from ``left`` before to ``right`` after: sliding-window attention's neighbourhood."""
    return Window.partitionBy(*keys).orderBy(*order).rowsBetween(-left, right)


def band_pairs(df: DataFrame, key: str, pos: str, left: int, right: int) -> DataFrame:
    """(key, q, k) with -left <= k - q <= right. Positions meet in blocks of the band's width, so it is an equi-join."""
    w = max(1, left + right + 1)
    block = lambda p: F.floor(p / w).cast("long")
    q = df.select(F.col(key), F.col(pos).alias("q"), F.explode(F.sequence(block(F.col(pos) - left), block(F.col(pos) + right))).alias("__b"))
    k = df.select(F.col(key), F.col(pos).alias("k"), block(F.col(pos)).alias("__b"))
    return q.join(k, [key, "__b"]).filter(F.expr(f"k - q between {-left} and {right}")).select(key, "q", "k")


def spans(df: DataFrame, keys: list[str], order: str, on: Column) -> DataFrame:
    """keys, first, last, n: runs of consecutive rows where ``on`` holds."""
    w = Window.partitionBy(*keys).orderBy(order)
    flagged = df.withColumn("__on", F.coalesce(on, F.lit(False)))
    start = (F.col("__on") & ~F.coalesce(F.lag("__on").over(w), F.lit(False))).cast("int")
    run = flagged.withColumn("__s", start).withColumn("__r", F.sum("__s").over(w)).filter("__on")
    return run.groupBy(*keys, "__r").agg(F.min(order).alias("first"), F.max(order).alias("last"), F.count(F.lit(1)).alias("n")).drop("__r")


def cumulative(df: DataFrame, key: str, length: Column) -> DataFrame:
    """key, start, end: running sums of lengths in key order, by key ranges and not in one task. Null lengths are 0."""
    rows = D.ranges(df.select(key, F.coalesce(length.cast("long"), F.lit(0).cast("long")).alias("__n")), key)
    inside = F.sum("__n").over(Window.partitionBy("__p").orderBy(key, "__at").rowsBetween(Window.unboundedPreceding, 0))
    out = rows.withColumn("end", D.before(rows, F.col("__n")) + inside)
    return out.select(key, (F.col("end") - F.col("__n")).alias("start"), "end")


def differences(df: DataFrame, keys: list[str], order: str, value: str) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(order)
    return df.withColumn("dt", F.lead(value).over(w) - F.col(value)).filter("dt is not null")


def ema(df: DataFrame, keys: list[str], order: list[str], value: str, beta: float = 0.9995, power: float = 0.75, inv_gamma: float = 1.0, every: int = 1, after: int = 0) -> DataFrame:
    """keys, n, ema: an ordered fold; a decay of 0 copies. Only every ``every``-th value counts, after ``after`` values."""
    ordered = F.array_sort(F.collect_list(F.struct(*order, F.col(value).cast("double").alias("__x"))))
    start = F.struct(F.lit(0).alias("n"), F.lit(0.0).alias("e"))

    def step(a: Column, x: Column) -> Column:
        use = (a["n"] % every == 0)
        d = F.when(a["n"] <= after, F.lit(0.0)).otherwise(ema_decay(a["n"] - after, beta, power, inv_gamma))
        e = F.when(d <= 0, x["__x"]).otherwise(a["e"] + (x["__x"] - a["e"]) * (1 - d))
        return F.struct((a["n"] + 1).alias("n"), F.when(use, e).otherwise(a["e"]).alias("e"))

    return df.groupBy(*keys).agg(F.aggregate(ordered, start, step).alias("__a")).select(*keys, F.col("__a.n").cast("long").alias("n"), F.col("__a.e").alias("ema"))


def pack(df: DataFrame, keys: list[str], order: str, group: str, size: str, cap: int) -> DataFrame:
    """keys, group, shard: groups in order go to the open shard while it has room; a larger group fills shards of its
    own. A fold within each key, in bounded state: rows come sorted and only counters are kept."""

    def fold(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, shard, held = None, 0, 0
        for pdf in frames:
            out = []
            for row in pdf.itertuples(index=False):
                now = tuple(row[: len(keys)])
                if now != key:
                    key, shard, held = now, 0, 0
                n = int(row[-1])
                if held and held + n > cap:
                    shard, held = shard + 1, 0
                out.append((*now, row[len(keys) + 1], shard))
                held += n
                while held >= cap:
                    shard, held = shard + 1, held - cap
            yield pd.DataFrame(out, columns=[*keys, group, "shard"])

    from pyspark.sql.types import LongType, StructField, StructType

    schema = StructType([*[df.schema[k] for k in keys], df.schema[group], StructField("shard", LongType())])
    rows = df.select(*keys, order, group, size).repartition(*keys).sortWithinPartitions(*keys, order)
    return rows.mapInPandas(fold, schema)


def trim_concat(df: DataFrame, key: str, order: str, x: str, keep: Column) -> DataFrame:
    """key, joined: arrays cut to their own lengths and put one after the other."""
    parts = F.array_sort(F.collect_list(F.struct(F.col(order), F.slice(x, 1, keep).alias("x"))))
    return df.groupBy(key).agg(F.flatten(F.transform(parts, lambda p: p["x"])).alias("joined"))
