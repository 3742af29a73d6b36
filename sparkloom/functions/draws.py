"""Seeded draws as columns: every random choice follows from a key and a tag, not from partitioning or task order."""

from __future__ import annotations

import math
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import arrays as A

#: Chances of the caption kinds, of the policies for structured captions, and of an active numeric tempo (fixed values).
CAPTION_CHANCES = (("dense", 0.30), ("vivid", 0.375), ("one_line", 0.325))
POLICY_CHANCES = (("keep", 0.40), ("omit", 0.30), ("prefix", 0.30))
TEMPO_CHANCE = 0.70


def uniform(key: Column | str, tag: str = "0") -> Column:
    """A double in [0, 1): the first 64 bits of the SHA-1 of ``tag:key``."""
    key = F.col(key) if isinstance(key, str) else key
    top = F.conv(F.substring(F.sha1(F.concat_ws(":", F.lit(tag), key.cast("string"))), 1, 16), 16, 10)
    return top.cast("decimal(20,0)").cast("double") / F.lit(float(2**64))


def chance(key: Column | str, p: float, tag: str) -> Column:
    """Bernoulli draw (augmentation, condition dropout, one-shot timesteps)."""
    return uniform(key, tag) < F.lit(float(p))


def choice(u: Column, weighted: Sequence[tuple[str, float]]) -> Column:
    """The item whose share of the total weight holds u; the last one where rounding leaves a gap."""
    total, at, out = sum(w for _, w in weighted), 0.0, None
    for item, w in weighted[:-1]:
        at += w
        out = (out.when if out is not None else F.when)(u * total < at, F.lit(item))
    return F.lit(weighted[-1][0]) if out is None else out.otherwise(F.lit(weighted[-1][0]))


def split(key: Column | str, val_ratio: float, tag: str = "0") -> Column:
    """'train' or 'val'. Ratios of 0 and below, or 1 and above, are all of one."""
    if val_ratio <= 0:
        return F.lit("train")
    if val_ratio >= 1:
        return F.lit("val")
    return F.when(uniform(key, tag) < val_ratio, "val").otherwise("train")


def offset(key: Column | str, highest: Column, tag: str = "crop") -> Column:
    """A whole number from 0 to highest, both included."""
    return F.least(F.floor(uniform(key, tag) * (F.greatest(highest, F.lit(0)) + 1)), F.greatest(highest, F.lit(0))).cast("int")


def exponential(key: Column | str, scale: float, tag: str = "exp") -> Column:
    return -F.ln(F.lit(1.0) - uniform(key, tag)) * F.lit(float(scale))


def normal(key: Column | str, tag: str = "z") -> Column:
    """Box-Muller on two draws."""
    u1, u2 = uniform(key, f"{tag}.1"), uniform(key, f"{tag}.2")
    return F.sqrt(F.lit(-2.0) * F.ln(F.lit(1.0) - u1)) * F.cos(F.lit(2 * math.pi) * u2)


def sigmoid(x: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-x))


def _safe(t: Column) -> Column:
    return F.greatest(F.least(t, F.lit(1 - 1e-4)), F.lit(1e-4))


def timestep(key: Column | str, how: str = "uniform", **p: float) -> Column:
    """A training timestep in [0, 1].

    uniform; logit_normal; log_snr (mean, std); log_snr_uniform (low, high), the last two kept 1e-4 from the ends.
    """
    if how == "uniform":
        return uniform(key, "t")
    if how == "logit_normal":
        return sigmoid(normal(key, "t"))
    if how == "log_snr":
        return _safe(sigmoid(-(normal(key, "t") * p.get("std", 2.0) + p.get("mean", -1.2))))
    if how == "log_snr_uniform":
        low, high = p.get("low", -6.0), p.get("high", 5.0)
        return _safe(sigmoid(-(uniform(key, "t") * (high - low) + low)))
    raise ValueError(f"unknown timestep draw {how}")


def truncated_logistic(key: Column | str, left: float = 0.075, tag: str = "t") -> Column:
    """Logistic-normal draws cut at ``left`` and stretched to [0, 1)."""
    @F.pandas_udf("double")
    def inverse(u: pd.Series) -> pd.Series:
        from statistics import NormalDist

        z = NormalDist()
        low = z.cdf(math.log(left / (1 - left)))
        return u.map(lambda v: (1 / (1 + math.exp(-z.inv_cdf(min(max(low + (1 - low) * v, 1e-15), 1 - 1e-15)))) - left) / (1 - left))

    return inverse(uniform(key, tag))


def radical_inverse(index: Column, digits: int = 32) -> Column:
    """Base-2 van der Corput value of an index: the first dimension of a Sobol sequence."""
    steps = F.sequence(F.lit(0), F.lit(digits - 1))
    return F.aggregate(steps, F.lit(0.0), lambda a, k: a + F.getbit(index.cast("long"), k).cast("double") / F.pow(F.lit(2.0), k + 1))


def shuffled(df: DataFrame, key: str, seed: int = 0) -> DataFrame:
    """Rows in a seeded order; ties fall by the key."""
    return df.orderBy(uniform(key, f"{seed}.order"), F.col(key))


def resample(df: DataFrame, key: str, epoch: int, seed: int = 0) -> DataFrame:
    """``epoch`` draws with replacement: (draw, all columns). Draws and rows meet on a dense row number.

    Rows that share a key are numbered in the order of a hash of all their columns.
    """
    n = df.count()
    if not n:
        return df.select(F.lit(0).cast("long").alias("draw"), "*")
    draws = df.sparkSession.range(epoch).select(F.col("id").alias("draw"), F.least(F.floor(uniform(F.col("id"), f"{seed}.draw") * n), F.lit(n - 1)).cast("long").alias("__n"))
    return draws.join(numbered(df, key), "__n").drop("__n")


#: Rows looked at for each range to find bounds that share out the keys evenly.
PER_RANGE = 30


def ranges(df: DataFrame, key: str) -> DataFrame:
    """df with __at, a unique order within equal keys, and __p, the number of a key range.

    Ranges follow from bounds that are part of the plan, so a row has the same range however often it is computed. The
    bounds come from the rows of the least key hashes; whatever they are, every row has one range.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    out = df.withColumn("__at", F.xxhash64(*df.columns))
    some = out.select(key, "__at").orderBy(F.xxhash64(key, "__at")).limit(PER_RANGE * parts).orderBy(key, "__at").collect()
    place = lambda k, at: F.struct(k.alias("k"), at.alias("at"))
    kind = df.schema[key].dataType
    bounds = [place(F.lit(r[0]).cast(kind), F.lit(r[1])) for r in some[PER_RANGE::PER_RANGE]]
    return out.withColumn("__p", A.passed(F.array(*bounds), place(F.col(key), F.col("__at"))) if bounds else F.lit(0))


def before(df: DataFrame, value: Column) -> Column:
    """The sum of value over all ranges before a row's own; df has __p. The driver holds a number a range."""
    found = {r[0]: r[1] for r in df.groupBy("__p").agg(F.sum(value)).collect()}
    total, starts = 0, []
    for p in range(max(found, default=0) + 1):
        starts.append(F.lit(total).cast("long"))
        total += found.get(p, 0) or 0
    return F.get(F.array(*starts), F.col("__p"))


def numbered(df: DataFrame, key: str, name: str = "__n") -> DataFrame:
    """Dense numbers from 0 in key order (null first), without a window over all rows."""
    ranged = ranges(df, key)
    within = F.row_number().over(Window.partitionBy("__p").orderBy(key, "__at")) - 1
    return ranged.withColumn(name, before(ranged, F.lit(1)) + within).drop("__p", "__at")


def replace_rejected(df: DataFrame, key: str, rejected: Column, seed: int = 0) -> DataFrame:
    """Rejected rows give way to a drawn survivor (kept under their own key, in ``source_key``)."""
    good = numbered(df.filter(~rejected), key)
    n = good.count()
    bad = df.filter(rejected).select(F.col(key).alias("__key"))
    if not n:
        return df.limit(0).withColumn("source_key", F.col(key))
    drawn = bad.withColumn("__n", F.least(F.floor(uniform(F.col("__key"), f"{seed}.again") * n), F.lit(n - 1)).cast("long")).join(good, "__n")
    others = [c for c in df.columns if c != key]
    again = drawn.select(F.col("__key").alias(key), *others, F.col(key).alias("source_key"))
    return df.filter(~rejected).withColumn("source_key", F.col(key)).unionByName(again)


def weighted_union(sources: dict[str, tuple[DataFrame, float]], key: str, seed: int = 0) -> DataFrame:
    """UNION ALL of named sources, rows kept with a chance of weight / largest weight; columns dataset_id and weight."""
    top, out = max(w for _, w in sources.values()), None
    for name, (df, w) in sources.items():
        part = df.filter(chance(key, w / top, f"{seed}.{name}")).withColumns({"dataset_id": F.lit(name), "weight": F.lit(float(w))})
        out = part if out is None else out.unionByName(part)
    return out
