"""Line dedup: explode normalised lines, hash, count distinct documents per hash, drop lines over a threshold,
reassemble by position.

Only hashes and positions are shuffled by the counting passes; texts move once, to meet their drop lists.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common as C

#: Up to so many frequent keys (24 bytes each) are broadcast; more are joined by shuffle.
BROADCAST_KEYS = 500_000
_NO_ID = -(1 << 63)


def _key(line: Column) -> Column:
    return C.ascii_lower(F.btrim(line, F.lit(C.WS)))


def _hash(line: Column, min_chars: int) -> Column:
    key = _key(line)
    return F.when(F.char_length(key) >= min_chars, F.struct(F.xxhash64(key).alias("a"), F.xxhash64(F.lit(7), key).alias("b")))


def line_dedup(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """One row per input row: doc_id, text (kept lines joined by newline), n_lines, n_dropped.

    Null or empty text is one empty line. Rows that share a doc_id are one document when documents are counted and
    keep their own lines. A null doc_id counts as one document smaller than all others. Other columns are ignored.
    """
    spark = docs.sparkSession
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    rows = d.select(F.coalesce("doc_id", F.lit(_NO_ID)).alias("k"), "text")
    repeated = not rows.groupBy("k").count().filter("count > 1").isEmpty()
    hashes = F.transform(F.split("text", "\n"), lambda x: _hash(x, min_chars))
    # lines are cut and hashed once; counting and dropping read 16 bytes a line
    hashed = C.materialize(rows.select("k", F.xxhash64("text").alias("t"), hashes.alias("hashes")), "line-hashes")
    once = hashed.select("k", F.explode(F.filter(F.array_distinct("hashes"), lambda h: h.isNotNull())).alias("h"))
    n_docs = F.count_distinct("k") if repeated else F.count(F.lit(1))
    frequent = C.materialize(
        once.groupBy(F.col("h.a").alias("a"), F.col("h.b").alias("b")).agg(n_docs.alias("n"), F.max("k").alias("last")).filter(F.col("n") >= min_docs).select("a", "b", "last"),
        "frequent-lines",
    )
    small = F.broadcast(frequent) if C.fits(frequent, BROADCAST_KEYS) else frequent
    at = hashed.select("k", "t", F.posexplode("hashes").alias("pos", "h")).filter("h is not null")
    drops = (
        at.select("k", "t", "pos", F.col("h.a").alias("a"), F.col("h.b").alias("b"))
        .join(small, ["a", "b"])
        .filter(F.col("k") != F.col("last"))
        .groupBy("k", "t")
        .agg(F.collect_set("pos").alias("drops"))
    )
    out = rows.select("k", F.xxhash64("text").alias("t"), "text").join(drops, ["k", "t"], "left")
    lines = F.split("text", "\n")
    kept = F.array_join(F.transform(F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("drops")), lambda i: F.get(lines, i)), "\n")
    return out.select(
        F.when(F.col("k") != _NO_ID, F.col("k")).alias("doc_id"),
        F.when(F.col("drops").isNull(), F.col("text")).otherwise(kept).alias("text"),
        F.size(lines).cast("long").alias("n_lines"),
        F.coalesce(F.size("drops"), F.lit(0)).cast("long").alias("n_dropped"),
    )


def digest(docs: DataFrame) -> DataFrame:
    out = line_dedup(docs)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


SQL = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         unnest(range(0, len(string_split(coalesce(text, ''), chr(10))))) AS pos FROM documents),
keyed AS (
  SELECT doc_id, pos, line,
         translate(trim(line, chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' '), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM lines),
freq AS (
  SELECT k, max(doc_id) AS last FROM keyed WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) >= 3),
marked AS (
  SELECT a.doc_id, a.pos, a.line, f.k IS NOT NULL AND a.doc_id <> f.last AS gone FROM keyed a LEFT JOIN freq f ON a.k = f.k)
SELECT doc_id, count(*)::BIGINT AS n_lines, (count(*) FILTER (WHERE gone))::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
