"""Connected components of an edge table, by alternating large-star and small-star steps.

Every step is an aggregation and a join on narrow rows; nothing is gathered by vertex or on the driver. Each round is
written to the shared folder.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

#: Keys that the edges of one vertex are spread over.
SALT = 16


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(vertex, smallest vertex of its component) for all vertices but the smallest ones, in memory."""
    if not len(a):
        return a, b
    nodes, inverse = np.unique(np.concatenate([a, b]), return_inverse=True)
    u, v = inverse[: len(a)], inverse[len(a) :]
    label = np.arange(len(nodes))
    while True:
        x, y = label[u], label[v]
        far = x != y
        if not far.any():
            break
        np.minimum.at(label, np.maximum(x[far], y[far]), np.minimum(x[far], y[far]))
        while True:
            up = label[label]
            if (up == label).all():
                break
            label = up
    other = label != np.arange(len(nodes))
    return nodes[other], nodes[label[other]]


def components(edges: DataFrame) -> DataFrame:
    """(v, root): every vertex of the edges (a, b) but the smallest of each component, with that smallest one.

    Null ends and loops are ignored; repeated and reversed edges do no harm. No edge gives no row.
    """
    links = edges.filter("a <> b").select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("root")).distinct()
    links = C.materialize(links, "links")
    state = _state(links)
    while state[0]:
        both = links.select(F.col("v").alias("x"), F.col("root").alias("y")).union(links.select("root", "v"))
        # the rows of a hub are spread over SALT keys, and its least neighbour goes to each
        least = both.groupBy("x").agg(F.min("y").alias("m")).select("x", F.least("x", "m").alias("m"), F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))).alias("salt"))
        large = C.materialize(both.filter("y > x").withColumn("salt", F.pmod(F.xxhash64("y"), F.lit(SALT)).cast("int")).join(least.hint("merge"), ["x", "salt"]).select(F.col("y").alias("v"), F.col("m").alias("root")).distinct(), "large-star")
        down = large.groupBy("v").agg(F.min("root").alias("m"))
        small = large.join(down, "v").filter("root <> m").select(F.col("root").alias("v"), F.col("m").alias("root")).union(down.select("v", "m")).distinct()
        old, links = links, C.materialize(small, "small-star")
        C.release(old, large)
        now = _state(links)
        if now == state:
            break
        state = now
    return links


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("v", "root").cast("decimal(20,0)"))).first())
