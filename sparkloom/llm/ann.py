"""Approximate nearest neighbours by cross-polytope hashing.

A hash turns a unit vector by three rounds of random signs and a fast Hadamard transform and takes the nearest signed
axis. A table joins two hashes. Rows are indexed by (table, cell) and id alone; queries look into cells in the order of
their closeness, over all tables together, until those cells hold a number of rows that follows from the size of the
table by one rule: BASE * k + BUDGET * n ** POWER. Candidates are joined by cell, each is compared once, by exact distance, and
vectors meet the queries in blocks, so no shuffle carries a vector for every cell.

Equal vectors are indexed once, with the k + 1 smallest of their ids: no query can need more of them. A query that
finds too few neighbours in its cells is compared with all rows, in blocks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common as C

TABLES = 16
#: Rows in the cells that a query looks into, counted once a table: BASE * k + BUDGET * n ** POWER. A query's work grows
#: with the square root of the table. Vectors without any structure, whose neighbours are hardly closer than other rows,
#: lose recall as a table grows by this rule (measured in the README); a larger budget buys it back.
BASE, BUDGET, POWER = 100, 32.0, 0.5
#: Signed axes that a hash tells apart, at most, and the nearest of them that a query looks at.
AXES, NEAR = 128, 64
#: Vectors of a block; a block is compared with its queries in one task.
PART = 4_096
#: Probes (12 bytes, about 60 in a hash table) and numbers of query vectors (8 bytes) up to these counts are broadcast.
BROADCAST_PROBES, BROADCAST_NUMBERS = 500_000, 2_000_000
SCHEMA = "query_id long, rank int, vec_id long, score double"


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of the rows, orthonormal."""
    n, out, h = x.shape[1], x, 1
    while h < n:
        y = out.reshape(len(x), n // (2 * h), 2, h)
        out = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], 2).reshape(len(x), n)
        h *= 2
    return out / math.sqrt(n)


def rotations(dim: int, hashes: int, seed: int) -> np.ndarray:
    """(hashes, 3, padded dim) random signs."""
    width = 1 << max(0, (dim - 1).bit_length())
    return np.random.default_rng(seed).choice(np.array([-1.0, 1.0]), (hashes, 3, width))


def axes(x: np.ndarray, signs: np.ndarray) -> np.ndarray:
    """Turned unit vectors, next to their negatives: column v is the closeness to signed axis v. Of wide vectors the
    first AXES / 2 turned coordinates count."""
    y = np.zeros((len(x), signs.shape[1]))
    y[:, : x.shape[1]] = x / np.linalg.norm(x, axis=1, keepdims=True)
    for s in signs:
        y = hadamard(y * s)
    y = y[:, : AXES // 2]
    return np.concatenate([y, -y], 1)


class Tables:
    """The cells of vectors, and the cells that queries look into."""

    def __init__(self, dim: int, tables: int, seed: int):
        self.signs = rotations(dim, 2 * tables, seed)
        self.width = min(AXES, 2 * self.signs.shape[2])
        self.tables, self.cells = tables, self.width**2

    def codes(self, x: np.ndarray) -> np.ndarray:
        """(row, table) -> number of the cell, over all tables."""
        best = np.stack([axes(x, s).argmax(1) for s in self.signs], 1)
        return best[:, 0::2] * self.width + best[:, 1::2] + np.arange(self.tables) * self.cells

    def look(self, x: np.ndarray, sizes: np.ndarray, budget: int) -> Iterator[np.ndarray]:
        """For each row the cells that hold a row, nearest first over all tables, until they hold ``budget`` rows."""
        for v in x:
            close = [axes(v[None], s)[0] for s in self.signs]
            cell, near = [], []
            for t in range(self.tables):
                a, b = close[2 * t], close[2 * t + 1]
                first, second = np.argsort(-a)[:NEAR], np.argsort(-b)[:NEAR]
                cell.append((first[:, None] * self.width + second[None] + t * self.cells).ravel())
                near.append((a[first][:, None] + b[second][None]).ravel())
            cell, near = np.concatenate(cell), np.concatenate(near)
            held = sizes[cell] > 0
            cell, near = cell[held], near[held]
            cell = cell[np.argsort(-near, kind="stable")]
            yield cell[: int(np.searchsorted(np.cumsum(sizes[cell]), budget)) + 1]


def _vectors(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def usable(embeddings: DataFrame) -> DataFrame:
    """(vec_id, x) of the rows that take part.

    Left out are null ids and vectors that are null, empty or zero or hold null or non-finite components.
    """
    x = F.col("x")
    good = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("x")).filter("vec_id is not null and x is not null")
    return good.filter(F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists(x, lambda v: v != 0))


def _blocks(spark: SparkSession, rows: DataFrame, asks: DataFrame, n_parts: int, k: int) -> DataFrame:
    """query, vec_id, score: the k + 1 best ids for each query in every block it asks.

    rows: (part, id, ids, x); asks: (part, id, ids, x), ids null for all of the block. Rows of a part come before its
    asks, so a task holds one block and a batch of asks at a time.
    """

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, known, held, ready = None, [], None, False
        for batch in batches:
            parts, kinds, ids = (batch.column(c).to_numpy() for c in ("part", "kind", "id"))
            lists, x = batch.column("ids"), batch.column("x")
            out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
            for i in range(batch.num_rows):
                if parts[i] != part:
                    part, known, ready = parts[i], [], False
                if kinds[i] == 0:
                    known.append((ids[i], lists[i].values.to_numpy(), x[i].values.to_numpy()))
                    continue
                if not known:
                    continue
                if not ready:
                    reps = np.array([r for r, _, _ in known])
                    order = np.argsort(reps)
                    own = [known[j][1] for j in order]
                    n = np.fromiter(map(len, own), np.int64, len(own))
                    held = reps[order], np.concatenate(own), n, np.cumsum(n) - n, np.stack([known[j][2] for j in order])
                    ready = True
                reps, flat, n, start, vectors = held
                wanted = lists[i].values
                at = np.arange(len(reps)) if wanted is None else np.searchsorted(reps, wanted.to_numpy())
                d = np.sqrt(np.square(vectors[at] - x[i].values.to_numpy()).sum(1))
                reach = n[at]
                ends = np.cumsum(reach)
                vec = flat[np.arange(int(ends[-1])) + np.repeat(start[at] - ends + reach, reach)]
                score = np.repeat(d, reach)
                best = np.lexsort((vec, score))
                first = np.sort(np.unique(vec[best], return_index=True)[1])[: k + 1]
                best = best[first]
                out.append((np.full(len(best), ids[i]), vec[best], score[best]))
            if out:
                q, v, s = (np.concatenate(c) for c in zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(q), pa.array(v), pa.array(s)], names=["query", "vec_id", "score"])

    both = rows.select("part", F.lit(0).alias("kind"), "id", "ids", "x").unionByName(asks.select("part", F.lit(1).alias("kind"), "id", "ids", "x"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = both.repartition(min(n, n_parts), "part").sortWithinPartitions("part", "kind")
    return dealt.mapInArrow(search, "query long, vec_id long, score double")


def _search(rows: DataFrame, dim: int, every: int, k: int, tables: int, budget: float, power: float, seed: int) -> DataFrame:
    """The result for vectors of one length; rows: (vec_id, x)."""
    spark = rows.sparkSession
    copy = F.row_number().over(Window.partitionBy("x").orderBy("vec_id"))
    few = rows.distinct().withColumn("copy", copy).filter(F.col("copy") <= k + 1)
    index = C.materialize(few.groupBy("x").agg(F.min("vec_id").alias("id"), F.array_sort(F.collect_list("vec_id")).alias("ids")), "vectors")
    n = index.count()
    n_parts = max(1, -(-n // PART))
    index = index.withColumn("part", F.pmod(F.xxhash64("id", "x"), F.lit(n_parts)).cast("int"))
    # a vector is named by a hash of itself, as an id may come with several
    index = index.withColumn("id", F.xxhash64("x"))
    asked = rows.filter(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("query_id"), "x").distinct()
    asked = C.materialize(asked.withColumn("id", F.xxhash64("x")), "queries")
    queries = asked.select("id", "x").dropDuplicates(["id"])
    made = Tables(dim, tables, seed)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 1024):
                part = batch.slice(a, 1024)
                cells = made.codes(_vectors(part.column("x"), dim)).astype(np.int32)
                cols = [np.repeat(part.column(c).to_numpy(), made.tables) for c in ("id", "part")]
                yield pa.RecordBatch.from_arrays([pa.array(cells.ravel()), *map(pa.array, cols)], names=["cell", "id", "part"])

    codes = C.materialize(index.select("id", "part", "x").mapInArrow(code, "cell int, id long, part int"), "cells")
    sizes = np.zeros(made.tables * made.cells, np.int64)  # a count for each cell of the tables, whatever the input
    counts = codes.groupBy("cell").count().toArrow()
    sizes[counts["cell"].to_numpy()] = counts["count"].to_numpy()
    rows_wanted = BASE * k + math.ceil(budget * n**power)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 64):
                part = batch.slice(a, 64)
                cells = list(made.look(_vectors(part.column("x"), dim), sizes, rows_wanted))
                ids = np.repeat(part.column("id").to_numpy(), [len(c) for c in cells])
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(np.concatenate(cells).astype(np.int32))], names=["query", "cell"])

    shuffles = int(spark.conf.get("spark.sql.shuffle.partitions"))
    small = lambda df, rows: F.broadcast(df) if C.fits(df, rows) else df.hint("merge")
    queries = C.materialize(queries, "query-vectors")
    probes = C.materialize(queries.repartition(shuffles, "id").mapInArrow(probe, "query long, cell int"), "probes")
    asks = codes.join(small(probes, BROADCAST_PROBES), "cell").groupBy("query", "part").agg(F.collect_set("id").alias("ids"))
    known = small(queries.select(F.col("id").alias("query"), "x"), max(1, BROADCAST_NUMBERS // dim))
    asks = asks.join(known, "query").select("part", F.col("query").alias("id"), "ids", "x")
    best = _best(_blocks(spark, index, asks, n_parts, k), k)
    best = C.materialize(best, "neighbours")

    total = rows.select("vec_id").distinct().count()
    short = best.groupBy(F.col("query").alias("id")).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min(k + 1, total)).select("id")
    short = C.materialize(queries.join(short, "id", "left_anti"), "short-queries")
    if not short.isEmpty():
        every_part = short.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(n_parts - 1)))).withColumn("ids", F.lit(None).cast("array<long>"))
        more = _best(_blocks(spark, index, every_part, n_parts, k), k)
        best = best.join(short.select(F.col("id").alias("query")), "query", "left_anti").unionByName(more)
    out = asked.select("query_id", F.col("id").alias("query")).join(best, "query").filter("query_id <> vec_id")
    out = out.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    result = out.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
    C.release(codes, probes)
    return result


def _best(found: DataFrame, k: int) -> DataFrame:
    """The k + 1 nearest ids of every query, an id with several vectors at its nearest."""
    found = found.groupBy("query", "vec_id").agg(F.min("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query").orderBy("score", "vec_id"))
    return found.withColumn("r", rank).filter(F.col("r") <= k + 1).drop("r")


def nearest(embeddings: DataFrame, every: int = 100, k: int = 10, tables: int = TABLES, budget: float = BUDGET, power: float = POWER, seed: int = 11) -> DataFrame:
    """query_id, rank, vec_id, score (Euclidean distance): for rows whose vec_id is divisible by ``every``, the k nearest
    rows of other ids that were found, ties to the smaller vec_id; all of them where there are no more than k.

    Vectors are compared with those of their own length, each length in a search of its own. Rows that repeat id and
    vector count once; an id with several vectors asks with each of them and counts at its nearest. Other columns are
    ignored; no rows, no result.
    """
    rows = usable(embeddings)
    dims = [r["d"] for r in rows.select(F.size("x").alias("d")).distinct().orderBy("d").collect()]  # the lengths of vectors: few
    out = None
    for dim in dims:
        part = _search(rows.filter(F.size("x") == dim), dim, every, k, tables, budget, power, seed)
        out = part if out is None else out.unionByName(part)
    if out is None:
        return embeddings.sparkSession.createDataFrame([], SCHEMA)
    if len(dims) > 1:  # an id with vectors of several lengths
        out = out.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
        rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
        out = out.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
    return out
