"""Low-rank weight updates over long tables (row, column, value) and on state-dict rows."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def long_product(up: DataFrame, down: DataFrame, scale: float = 1.0) -> DataFrame:
    """(r, c, v) = scale * up(r, k) @ down(k, c): a join on k and a sum, for factors of any size."""
    pairs = up.select("r", "k", F.col("v").alias("__a")).join(down.select("k", "c", F.col("v").alias("__b")), "k")
    return pairs.groupBy("r", "c").agg((F.sum(F.col("__a") * F.col("__b")) * scale).alias("v"))


def norms(w: DataFrame, by: str) -> DataFrame:
    """Row or column norms: (by, norm)."""
    return w.groupBy(by).agg(F.sqrt(F.sum(F.col("v") * F.col("v"))).alias("norm"))


def dora(w: DataFrame, delta: DataFrame, magnitude: DataFrame, by: str = "r") -> DataFrame:
    """(r, c, v): w + delta, every row (or column) scaled to its magnitude (by, norm)."""
    merged = w.select("r", "c", "v").union(delta.select("r", "c", "v")).groupBy("r", "c").agg(F.sum("v").alias("v"))
    now = norms(merged, by).withColumnRenamed("norm", "__n")
    return merged.join(now, by).join(magnitude.select(by, F.col("norm").alias("__m")), by).select("r", "c", (F.col("v") * F.col("__m") / F.greatest("__n", F.lit(1e-12))).alias("v"))


def merge(adapters: DataFrame) -> DataFrame:
    """(name, r, c, v): adapters (name, weight, r, c, v) summed with their weights."""
    return adapters.groupBy("name", "r", "c").agg(F.sum(F.col("weight") * F.col("v")).alias("v"))


def svd_bases(tensors: DataFrame, rank: int) -> DataFrame:
    """tensors (name, rows, cols, values array<double>) to (name, up, down): leading singular bases, each left vector's
    largest entry positive. One matrix is one row, so a task holds one at a time."""
    import numpy as np

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            out = []
            for name, r, c, v in zip(pdf["name"], pdf["rows"], pdf["cols"], pdf["values"], strict=True):
                u, s, vt = np.linalg.svd(np.asarray(v, float).reshape(r, c), full_matrices=False)
                k = min(rank, len(s))
                u, vt = u[:, :k], vt[:k]
                sign = np.sign(u[np.abs(u).argmax(0), np.arange(k)])
                sign[sign == 0] = 1
                out.append((name, (u * sign).ravel().tolist(), (vt * sign[:, None]).ravel().tolist()))
            yield pd.DataFrame(out, columns=["name", "up", "down"])

    return tensors.select("name", "rows", "cols", "values").mapInPandas(run, "name string, up array<double>, down array<double>")


def core_product(up: DataFrame, core: DataFrame, down: DataFrame, scale: float = 1.0) -> DataFrame:
    """(r, c, v) = scale * up(r, k) @ core(k, c) @ down(k, c), with fixed outer bases and a small learned core."""
    left = long_product(up, core).withColumnRenamed("c", "k")
    return long_product(left, down, scale)


def bora(w: DataFrame, delta: DataFrame, rows: DataFrame, columns: DataFrame) -> DataFrame:
    """(r, c, v): w + delta, scaled to row magnitudes (r, norm) and then to column magnitudes (c, norm)."""
    none = delta.withColumn("v", F.lit(0.0))
    return dora(dora(w, delta, rows, "r"), none, columns, "c")


def set_strength(adapters: DataFrame, strength: dict[str, float]) -> DataFrame:
    """Adapters (adapter, name, weight, r, c, v) with new weights; others stay."""
    weight = F.col("weight")
    for name, s in strength.items():
        weight = F.when(F.col("adapter") == name, F.lit(float(s))).otherwise(weight)
    return adapters.withColumn("weight", weight)


def select_adapters(adapters: DataFrame, keep: list[str] | None = None, remove: list[str] = ()) -> DataFrame:
    out = adapters.filter(F.col("adapter").isin(*keep)) if keep is not None else adapters
    return out.filter(~F.col("adapter").isin(*remove)) if remove else out


def adapter_count(adapters: DataFrame) -> DataFrame:
    return adapters.agg(F.count_distinct("adapter").alias("n_adapters"))


def magnitude_variant(name: Column, shape: Column) -> Column:
    """What a magnitude tensor scales: 'dora-cols' for (1, n), 'dora-rows' for (n, 1), else null."""
    two = F.endswith(name, F.lit(".magnitude")) & (F.size(shape) == 2)
    return F.when(two & (F.get(shape, F.lit(0)) == 1), "dora-cols").when(two & (F.get(shape, F.lit(1)) == 1), "dora-rows")


def squeezed(shape: Column) -> Column:
    """A shape without the places of length 1."""
    return F.filter(shape, lambda n: n != 1)
