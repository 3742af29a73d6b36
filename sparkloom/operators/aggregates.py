"""Masked, bucketed and windowed aggregates over long tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

EPS = 1e-8


def masked_mean(df: DataFrame, group: str, value: Column, valid: Column) -> DataFrame:
    """Mean over groups of their means of valid values (a group without any counts as 0). One row: masked_mean."""
    per = df.groupBy(group).agg((F.coalesce(F.sum(F.when(valid, value)), F.lit(0.0)) / (F.count(F.when(valid, 1)) + F.lit(EPS))).alias("m"))
    return per.agg(F.avg("m").alias("masked_mean"))


def masked_sum(df: DataFrame, keys: list[str], value: Column, valid: Column) -> DataFrame:
    return df.groupBy(*keys).agg(F.sum(F.when(valid, value).otherwise(0.0)).alias("masked_sum"))


def masked_loss(df: DataFrame, sample: str, loss: Column, valid: Column, weight: float = 0.0, signal_only: bool = False) -> DataFrame:
    """loss, signal_mean, padding_mean: the mean over samples of (signal + w padding) / (their counts), and pooled means."""
    w = 0.0 if signal_only else weight
    per = df.groupBy(sample).agg(
        F.coalesce(F.sum(F.when(valid, loss)), F.lit(0.0)).alias("s"),
        F.count(F.when(valid, 1)).alias("ns"),
        F.coalesce(F.sum(F.when(~valid, loss)), F.lit(0.0)).alias("p"),
        F.count(F.when(~valid, 1)).alias("np"),
    )
    one = (F.col("s") + w * F.col("p")) / (F.col("ns") + w * F.col("np") + F.lit(EPS))
    return per.agg(
        F.avg(one).alias("loss"),
        (F.sum("s") / (F.sum("ns") + F.lit(EPS))).alias("signal_mean"),
        (F.sum("p") / (F.sum("np") + F.lit(EPS))).alias("padding_mean"),
    )


def normalized_mse(df: DataFrame, pred: Column, target: Column, valid: Column, by: list[str] | None, eps: float = 1e-6, over_all: bool = False) -> DataFrame:
    """df with nmse: squared error over the target's population variance within ``by`` (valid rows only, unless
    over_all), where valid; raw squared error elsewhere and without ``by``; 1 where nothing is valid."""
    mse = (pred - target) * (pred - target)
    if by is None:
        return df.withColumn("nmse", mse)
    seen = target if over_all else F.when(valid, target)
    # variances are aggregated before they meet the rows: few keys would otherwise be few tasks
    same = [F.col(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(by)]
    var = df.groupBy(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(by)]).agg(F.var_pop(seen).alias("__var"))
    out = df.join(var, same, "left").withColumn("nmse", F.when(valid, mse / F.coalesce(F.col("__var") + eps, F.lit(1.0))).otherwise(mse))
    return out.select(*df.columns, "nmse")


def bucketed_mean(df: DataFrame, sigma: Column, value: Column, valid: Column, buckets: int = 10) -> DataFrame:
    """bucket, mean, n for every bucket [i/n, (i+1)/n) of sigma; empty ones are null; sigma = 1 is in none."""
    i = F.floor(sigma * buckets).cast("int")
    found = df.filter((sigma >= 0) & (sigma < 1)).groupBy(i.alias("bucket")).agg(F.avg(F.when(valid, value)).alias("mean"), F.count(F.when(valid, value)).alias("n"))
    every = df.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket"))
    return every.join(found, "bucket", "left").select("bucket", "mean", F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def tumbling_flush(df: DataFrame, keys: list[str], order: list[str], value: str, every: int) -> DataFrame:
    """keys, window, n, avg of every ``every`` rows in order; a window with a value that is not finite is dropped."""
    rn = F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1
    out = df.withColumn("window", F.floor(rn / every).cast("int")).groupBy(*keys, "window").agg(F.count(F.lit(1)).alias("n"), F.avg(value).alias("avg"))
    return out.filter(F.col("avg").isNotNull() & ~F.isnan("avg") & (F.abs("avg") < float("inf")))


def validation_means(df: DataFrame, step: str, value: str) -> DataFrame:
    """Mean over timesteps of their means."""
    return df.groupBy(step).agg(F.avg(value).alias("m")).agg(F.avg("m").alias("validation_mean"))


def valid_std(df: DataFrame, keys: list[str], value: Column, valid: Column) -> DataFrame:
    return df.groupBy(*keys).agg(F.stddev_samp(F.when(valid, value)).alias("std"))


def bottleneck_stats(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """mean, std and a penalty that is 0 at mean 0 and variance 1."""
    m, v = F.avg(value), F.var_pop(value)
    return df.groupBy(*by).agg(m.alias("mean"), F.sqrt(v).alias("std"), (m * m + v - F.ln(v + F.lit(EPS)) - 1).alias("penalty"))


def timing_pivot(df: DataFrame, row: str, column: str, value: str, columns: list[str]) -> DataFrame:
    """Median of value for each row and column."""
    return df.groupBy(row).pivot(column, columns).agg(F.median(value))


def timing_stats(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.median(value).alias("median"), F.avg(value).alias("mean"), F.min(value).alias("min"), F.max(value).alias("max"))


def progress(df: DataFrame, done: Column, seconds: Column) -> DataFrame:
    """total, finished, percent, rows_per_minute, eta_seconds of a progress table."""
    n, k, s = F.count(F.lit(1)), F.count(F.when(done, 1)), F.max(seconds)
    return df.agg(n.alias("total"), k.alias("finished"), (100 * k / n).alias("percent"), F.try_divide(60 * k, s).alias("rows_per_minute"), F.try_divide((n - k) * s, k).alias("eta_seconds"))


def agreed_rank(df: DataFrame, rank: str) -> DataFrame:
    """rank, agreed: the smallest rank and whether there is only one."""
    return df.agg(F.min(rank).alias("rank"), (F.count_distinct(rank) == 1).alias("agreed"))


def pca(df: DataFrame, vector: str, k: int = 3) -> DataFrame:
    """df with ``pca``: array<double> of the k leading components, from the covariance of centred vectors; the vectors
    themselves are projected. Each component's largest coefficient is positive."""
    import numpy as np
    import pyarrow as pa

    def sums(batches):
        acc = None
        for b in batches:
            x = b.column(0).flatten().to_numpy(zero_copy_only=False)
            if not b.num_rows:
                continue
            x = x.reshape(b.num_rows, -1)
            part = np.concatenate([[len(x)], x.sum(0), (x.T @ x).ravel()])
            acc = part if acc is None else acc + part
        if acc is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(acc), dtype=np.int32)), pa.array(acc)], names=["i", "v"])

    cols = df.select(F.col(vector).cast("array<double>").alias("x")).filter("x is not null")
    got = np.array([r[1] for r in cols.mapInArrow(sums, "i int, v double").groupBy("i").agg(F.sum("v")).orderBy("i").collect()])
    if not len(got):
        return df.withColumn("pca", F.lit(None).cast("array<double>"))
    d = int((-1 + (1 + 4 * (len(got) - 1)) ** 0.5) / 2)
    n, s = got[0], got[1 : 1 + d]
    cov = got[1 + d :].reshape(d, d) / n - np.outer(s, s) / n**2
    vec = np.linalg.eigh(cov)[1][:, ::-1][:, :k]
    vec = vec * np.sign(vec[np.abs(vec).argmax(0), np.arange(vec.shape[1])])
    lit = lambda col: F.array(*[F.lit(float(v)) for v in col])
    from ..functions.arrays import dot

    return df.withColumn("pca", F.array(*[dot(F.col(vector), lit(vec[:, j])) for j in range(vec.shape[1])]))


def collate(df: DataFrame, batch: Column, order: str, cols: list[str]) -> DataFrame:
    """batch_id, rows: array of structs in order."""
    return df.groupBy(batch.alias("batch_id")).agg(F.array_sort(F.collect_list(F.struct(order, *[c for c in cols if c != order]))).alias("rows"))
