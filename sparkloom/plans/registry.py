"""The table of registered queries and what their definitions share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict = {}
ORACLES: dict = {}


def query(sql: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLES[fn.__name__] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rounded(c, name: str, digits: int = 6):
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c, digits).alias(name)


def uniform_sql(tag: str, key: str) -> str:
    """uniform() in DuckDB."""
    return f"(('0x' || substr(sha1('{tag}:' || {key}), 1, 16))::UBIGINT::DOUBLE / 18446744073709551616.0::DOUBLE)"


#: The embedding as doubles, and the sum of an expression's items times their places, in DuckDB.
VEC = "list_transform(embedding, lambda x: x::DOUBLE)"


def weighed_sql(x: str) -> str:
    return f"list_sum(list_transform(range(1, len({x}) + 1), lambda i: ({x})[i] * i))"


def weighed(x):
    """The sum of an array's items times their places from 1: tells permuted arrays apart."""
    places = F.transform(x, lambda v, i: v.cast("double") * (i + 1))
    return F.aggregate(places, F.lit(0.0), lambda a, v: a + v)
