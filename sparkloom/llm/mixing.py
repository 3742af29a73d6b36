"""Mixing sources to target weights by Poisson replication (DataFrame functions only).

Every document gets the count at which the Poisson distribution function with its source's mean repetition rate
passes a hash-seeded uniform draw, is exploded by that count and dealt out in a global hash order.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.arrays import passed
from . import common as C

#: Production weights: share of the mixed corpus, in characters. Sources not named share OTHER.
WEIGHTS = {"src0": 0.10, "src1": 0.08, "src2": 0.08, "src3": 0.06, "src4": 0.06}
OTHER = 0.62
#: The largest rate of one draw. A larger rate is the sum of several draws of equal rates, which has the same
#: distribution, so tables stay short however small a source is for its weight.
ONE_DRAW = 1_000.0


def _bucket(weights: dict[str, float]) -> Column:
    """The name of the weight that applies to a row's source; '' for all that is not named."""
    return F.when(F.col("source").isin(list(weights)), F.col("source")).otherwise(F.lit(""))


def _distribution(rate: Column) -> Column:
    """Values of the Poisson distribution function at 0, 1, ... until the rest has a chance under 2^-52.

    Terms are summed as exp(k ln(rate) - rate - ln k!), so that large rates do not underflow.
    """
    top = F.ceil(rate + 12 * F.sqrt(rate) + 24).cast("int")
    start = F.struct(F.lit(0.0).alias("lf"), F.lit(0.0).alias("sum"), F.array().cast("array<double>").alias("cdf"))

    def step(acc: Column, k: Column) -> Column:
        lf = acc["lf"] + F.when(k > 0, F.ln(k.cast("double"))).otherwise(0.0)
        total = acc["sum"] + F.exp(k.cast("double") * F.ln(rate) - rate - lf)
        return F.struct(lf.alias("lf"), total.alias("sum"), F.concat(acc["cdf"], F.array(total)).alias("cdf"))

    return F.when(rate > 0, F.aggregate(F.sequence(F.lit(0), top), start, step, lambda acc: acc["cdf"]))


def rates(docs: DataFrame, weights: dict[str, float], other: float, scale: float) -> DataFrame:
    """(bucket, draws, cdf): at most len(weights) + 1 rows, whatever the input. Mass is counted in characters."""
    mass = docs.select(_bucket(weights).alias("bucket"), F.coalesce(F.char_length("text"), F.lit(0)).cast("long").alias("n")).groupBy("bucket").agg(F.sum("n").alias("mass"))
    found = {r["bucket"]: r["mass"] for r in mass.collect()}  # at most len(weights) + 1 rows
    whole, total_weight = sum(found.values()), sum(weights.values()) + other
    rate = {k: weights.get(k, other) / total_weight * whole * scale / n if n else 0.0 for k, n in found.items()}
    draws = {k: max(1, math.ceil(r / ONE_DRAW)) for k, r in rate.items()}
    row = lambda k, r, n: F.struct(F.lit(k).alias("bucket"), F.lit(r / n).alias("rate"), F.lit(n).cast("long").alias("draws"))
    table = docs.sparkSession.range(1).select(F.inline(F.array(*([row(k, r, draws[k]) for k, r in rate.items()] or [row("", 0.0, 1)]))))
    return table.select("bucket", "draws", _distribution(F.col("rate")).alias("cdf"))


def mix(docs: DataFrame, weights: dict[str, float] | None = None, other: float = OTHER, scale: float = 1.0, seed: int = 17, marks: bool = True) -> DataFrame:
    """The input's columns plus, with marks, copy (from 0) and shuffle_key, one row per copy, dealt out in hash order.

    A mark whose name the input has gets underscores behind it.

    Shares of the result are weights / (sum of weights + other), in expectation. A source of mass 0 (null or empty
    texts only) and a weight of 0 give no copies. Null sources belong to the rest. Repeated rows draw alike. A null
    doc_id draws as an empty one. An empty table gives an empty result.
    """
    weights = WEIGHTS if weights is None else weights
    if any(v < 0 or not math.isfinite(v) for v in [*weights.values(), other, scale]) or sum(weights.values()) + other <= 0:
        raise ValueError("weights must be finite, not negative, and not all zero")
    spark, keep = docs.sparkSession, docs.columns
    table = rates(docs, weights, other, scale).select(F.col("bucket").alias("__bucket"), F.col("draws").alias("__draws"), F.col("cdf").alias("__cdf"))
    u = C.draw(seed, F.col("doc_id"))
    again = F.transform(F.sequence(F.lit(1).cast("long"), F.col("__draws") - 1), lambda j: passed(F.col("__cdf"), C.draw(F.concat(F.lit(f"{seed}."), j.cast("string")), F.col("doc_id"))).cast("long"))
    more = F.when(F.col("__draws") > 1, F.aggregate(again, F.lit(0).cast("long"), lambda a, x: a + x)).otherwise(0)
    count = passed(F.col("__cdf"), F.col("__u")) + more
    copies = (
        docs.withColumn("__bucket", _bucket(weights))
        .withColumn("__u", u)
        .join(F.broadcast(table), "__bucket", "left")
        .withColumn("__n", F.when(F.col("__cdf").isNotNull(), count).otherwise(0))
        .filter("__n > 0")
        .withColumn("__copy", F.explode(F.sequence(F.lit(0), F.col("__n") - 1)))
        .withColumn("__key", F.md5(F.concat_ws(":", F.lit(f"{seed}.order"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("__copy").cast("string"))))
    )
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = copies.repartition(n, "__key").sortWithinPartitions("__key")
    own = [F.col("__copy").cast("int").alias(C.free("copy", keep)), F.col("__key").alias(C.free("shuffle_key", keep))]
    return dealt.select(*[F.col(f"`{c}`") for c in keep], *(own if marks else []))


SQL = f"""
WITH d AS (
  SELECT *, CASE WHEN source IN ({", ".join(f"'{k}'" for k in WEIGHTS)}) THEN source ELSE '' END AS bucket FROM documents),
mass AS (SELECT bucket, sum(coalesce(length(text), 0))::DOUBLE AS mass FROM d GROUP BY bucket),
rate AS (
  SELECT bucket, (CASE bucket {" ".join(f"WHEN '{k}' THEN {v!r}::DOUBLE" for k, v in WEIGHTS.items())} ELSE {OTHER!r}::DOUBLE END)
         / {(sum(WEIGHTS.values()) + OTHER)!r}::DOUBLE * (SELECT sum(mass) FROM mass) / mass AS rate
  FROM mass WHERE mass > 0),
term AS (
  SELECT bucket, k, exp(k::DOUBLE * ln(rate) - rate - lgamma(k::DOUBLE + 1)) AS p
  FROM rate, unnest(range(0, 25 + ceil(rate + 12 * sqrt(rate))::BIGINT)) AS t(k)),
cdf AS (SELECT bucket, k, sum(p) OVER (PARTITION BY bucket ORDER BY k ROWS UNBOUNDED PRECEDING) AS c FROM term),
drawn AS (
  SELECT d.*, ('0x' || substr(md5('17:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT::DOUBLE / 4503599627370496.0::DOUBLE AS u FROM d),
n AS (SELECT w.doc_id, count(*) AS n FROM drawn w JOIN cdf c ON w.bucket = c.bucket AND c.c <= w.u GROUP BY w.doc_id),
copies AS (SELECT doc_id, unnest(range(0, n)) AS copy FROM n)
SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, c.copy::INTEGER AS copy,
       md5('17.order:' || d.doc_id::VARCHAR || ':' || c.copy::VARCHAR) AS shuffle_key
FROM copies c JOIN d ON c.doc_id = d.doc_id
"""
