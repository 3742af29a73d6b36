"""SimHash near-duplicates by a segment-popcount embedding.

A fingerprint is cut into segments of two bits; the bit count of each segment is a coordinate. Manhattan distance
between coordinates is never more than the Hamming distance, so coordinates are joined on a grid under a Manhattan
radius and the survivors are compared exactly. Coordinates are dealt into groups. Of two fingerprints within
``max_bits``, some group is within ``max_bits // groups``; a grid join of radius 2 (both sides list the cells within 1)
is therefore whole for up to ``3 * groups - 1`` bits.

Fingerprints travel by the cell of the first half of a group's segments, to the home cell and its neighbours there; the
cells of the second half are told apart where they arrive, so a fingerprint is sent for about half of its cells.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C
from .components import components, forest

#: Bytes of a text that are cut into shingles at a time.
BLOCK = 1 << 20
#: Cells of up to so many fingerprints are compared pair by pair in one go; larger ones by growing clusters.
SMALL_CELL = 48
NARROW_BATCH = 50_000
_EVEN = np.uint64(0x5555555555555555)


def _mix(h: np.ndarray, k: int) -> np.ndarray:
    """The k-th word of a longer hash, from the first one (k = 0: itself)."""
    if not k:
        return h
    z = h + np.uint64((0x9E3779B97F4A7C15 * k) & (2**64 - 1))
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def _ones(h: np.ndarray) -> np.ndarray:
    """How often each of the 64 bits is set."""
    bits = np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    whole = len(bits) // 255 * 255
    out = bits[whole:].sum(0, dtype=np.int64)
    if whole:
        out += bits[:whole].reshape(-1, 255, 64).sum(1, dtype=np.uint8).sum(0, dtype=np.int64)
    return out


def fingerprint(text: bytes, n_words: int, n_fp: int = 1) -> list[int]:
    """n_fp words of 64 bits: bits set in over half the hashes of all shingles, repeats included; no words: zero."""
    import xxhash

    digest = xxhash.xxh64_intdigest
    ones, n, before = np.zeros((n_fp, 64), np.int64), 0, []
    for part in C.stretches(text, BLOCK, C.WS.encode()):
        words = before + part.lower().split()  # on bytes both touch ASCII only
        if len(words) < n_words:
            before = words
            continue
        joined = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate([[0], ends[:-1] + 1])[: len(words) - n_words + 1]
        h = np.array([digest(joined[a:b], 42) for a, b in zip(starts.tolist(), ends[n_words - 1 :].tolist(), strict=True)], np.uint64)
        for k in range(n_fp):
            ones[k] += _ones(_mix(h, k))
        n, before = n + len(h), words[len(words) - n_words + 1 :]
    if not n:
        if not before:
            return [0] * n_fp
        h, n = np.array([digest(b" ".join(before), 42)], np.uint64), 1
        for k in range(n_fp):
            ones[k] = _ones(_mix(h, k))
    packed = np.packbits(ones * 2 > n, axis=1, bitorder="little")
    return packed.view("<u8").ravel().tolist()


def fingerprints(docs: DataFrame, n_words: int, n_fp: int = 1) -> DataFrame:
    """(doc_id, t, f0, ...) for every row, materialised; t is a hash of the text. Null text has no words."""
    names = [f"f{k}" for k in range(n_fp)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.large_binary()).fill_null(b"")
            fp = np.array([fingerprint(t.as_py(), n_words, n_fp) for t in texts], np.uint64).reshape(-1, n_fp).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("t"), *(pa.array(fp[:, k]) for k in range(n_fp))], names=["doc_id", "t", *names])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("t"), F.col("text").cast("string").alias("text"))
    return C.materialize(rows.mapInArrow(run, "doc_id long, t long, " + ", ".join(f"{c} long" for c in names)), "fingerprints")


def coordinates(fp: np.ndarray, per: int) -> np.ndarray:
    """(row, group, segment) -> bit count of the segment."""
    n, words = fp.shape
    counts = fp - ((fp >> np.uint64(1)) & _EVEN)  # 32 fields of two bits, each the bit count of its segment
    fields = ((counts[:, :, None] >> np.arange(0, 64, 2, dtype=np.uint64)) & np.uint64(3)).astype(np.int64).reshape(n, words * 32)
    groups = words * 32 // per
    return fields[:, : groups * per].reshape(n, groups, per)


def _around(fields: np.ndarray) -> tuple[tuple[np.ndarray, np.ndarray, np.ndarray], np.ndarray]:
    """((row, group, cell) of each home cell and of its neighbours at distance 1, whether it is a home)."""
    n, groups, per = fields.shape
    step = np.int64(1) << (2 * np.arange(per, dtype=np.int64))
    home = (fields * step).sum(2)
    r, g = (x.ravel() for x in np.indices((n, groups)))
    out = [(r, g, home.ravel())]
    for ok, sign in ((fields < 2, 1), (fields > 0, -1)):
        r, g, i = np.nonzero(ok)
        out.append((r, g, home[r, g] + sign * step[i]))
    r, g, cell = (np.concatenate(x) for x in zip(*out, strict=True))
    return (r, g, cell), np.arange(len(r)) < n * groups


def coarse(fp: np.ndarray, per: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, key, home): the keys that a fingerprint is sent to, of group and cell of the first half of its segments;
    one of them is its home."""
    fields = coordinates(fp, per)
    (r, g, cell), home = _around(fields[:, :, : per // 2])
    return r, g << (2 * (per // 2)) | cell, home


def fine(fp: np.ndarray, key: np.ndarray, home: np.ndarray, per: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, cell of the second half): where a fingerprint came home, its own and those around; else its own alone.
    With the key these are all cells of a group within Manhattan distance 1."""
    rest = coordinates(fp, per)[np.arange(len(fp)), key >> (2 * (per // 2)), per // 2 :][:, None]
    (r, _, cell), own = _around(rest)
    keep = own | home[r]
    return r[keep], cell[keep]


def cells(fp: np.ndarray, per: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, cell) of the grid cells within Manhattan distance 1, for every group of ``per`` segments."""
    row, key, home = coarse(fp, per)
    r, cell = fine(fp[row], key, home, per)
    return row[r], key[r] << (2 * (per - per // 2)) | cell


def distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b).sum(-1, dtype=np.int64)


def grow(fp: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that span the components of one cell, without listing its pairs: every row joins the first one that reaches it."""
    rest, a, b = np.arange(len(fp)), [], []
    queue: list[int] = []
    while len(rest):
        if not queue:
            queue, rest = [int(rest[0])], rest[1:]
        at = queue.pop()
        near = distance(fp[rest], fp[at]) <= max_bits
        if near.any():
            a.append(np.full(int(near.sum()), at))
            b.append(rest[near])
            queue += rest[near].tolist()
            rest = rest[~near]
    return (np.concatenate(a), np.concatenate(b)) if a else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def cell_links(key: np.ndarray, fp: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Row pairs that span the links within every run of equal keys."""
    change = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    size = np.diff(np.concatenate([change, [len(key)]]))
    small = np.repeat(size <= SMALL_CELL, size)
    a, b = [], []
    for lag in range(1, int(size[size <= SMALL_CELL].max(initial=1))):
        i = np.flatnonzero((key[lag:] == key[:-lag]) & small[lag:])
        i = i[distance(fp[i], fp[i + lag]) <= max_bits]
        a.append(i)
        b.append(i + lag)
    for s, n in zip(change[size > SMALL_CELL].tolist(), size[size > SMALL_CELL].tolist(), strict=True):
        x, y = grow(fp[s : s + n], max_bits)
        a.append(x + s)
        b.append(y + s)
    return (np.concatenate(a), np.concatenate(b)) if a else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def links(distinct: DataFrame, n_fp: int, max_bits: int, per: int) -> DataFrame:
    """(a, b) over the id column: edges whose components are those of all pairs within max_bits that share a cell."""
    spark = distinct.sparkSession
    names = [f"f{k}" for k in range(n_fp)]

    def matrix(batch: pa.RecordBatch) -> np.ndarray:
        return np.stack([batch.column(c).to_numpy() for c in names], 1).view(np.uint64)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                row, key, home = coarse(matrix(part), per)
                cols = [pa.array(key * 2 + home), *(pa.array(part.column(c).to_numpy()[row]) for c in ["id", *names])]
                yield pa.RecordBatch.from_arrays(cols, names=["key", "id", *names])

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        found: list[tuple[np.ndarray, np.ndarray]] = []
        n_found = 0

        def flush(upto_last: bool) -> None:
            nonlocal held, found, n_found, n_held
            sent, ids, fp = (np.concatenate(x) for x in zip(*held, strict=True))
            key = sent >> 1
            cut = len(key) if upto_last else int(np.searchsorted(key, key[-1], side="left"))
            held = [(sent[cut:], ids[cut:], fp[cut:])] if cut < len(key) else []
            n_held = len(key) - cut
            if cut:
                row, cell = fine(fp[:cut], key[:cut], (sent[:cut] & 1) > 0, per)
                order = np.lexsort((cell, key[row]))
                row = row[order]
                a, b = cell_links(key[row] << (2 * (per - per // 2)) | cell[order], fp[row], max_bits)
                found.append((ids[row[a]], ids[row[b]]))
                n_found += len(a)
                if n_found > 1 << 20:
                    found = [forest(*(np.concatenate(x) for x in zip(*found, strict=True)))]
                    n_found = 0

        n_held = 0
        for batch in batches:
            if batch.num_rows:
                held.append((batch.column("key").to_numpy(), batch.column("id").to_numpy(), matrix(batch)))
                n_held += batch.num_rows
                # all rows of a key meet, so one is held until it ends
                if n_held >= NARROW_BATCH and held[0][0][0] >> 1 != held[-1][0][-1] >> 1:
                    flush(False)
        if held:
            flush(True)
        if found:
            v, root = forest(*(np.concatenate(x) for x in zip(*found, strict=True)))
            for at in range(0, len(v), NARROW_BATCH):
                yield pa.RecordBatch.from_arrays([pa.array(v[at : at + NARROW_BATCH]), pa.array(root[at : at + NARROW_BATCH])], names=["a", "b"])

    kinds = "".join(f", {c} long" for c in names)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = distinct.select("id", *names).mapInArrow(place, f"key long, id long{kinds}").repartition(n, F.shiftright("key", 1)).sortWithinPartitions("key")
    return C.materialize(placed.mapInArrow(join, "a long, b long"), "fingerprint-links")


def group(docs: DataFrame, n_words: int = 5, n_fp: int = 1, max_bits: int = 4, per: int = 16) -> DataFrame:
    """doc_id, t, f0, ..., component_id, kept for every row.

    component_id is the smallest doc_id reachable over fingerprints within max_bits of each other. Rows with equal
    fingerprints are one vertex. A null doc_id is never the smallest, and a component of nulls alone has none. kept
    marks the first row of a component, by doc_id (null last) and t, a hash of the text; rows that repeat it are marked
    too.
    """
    names = [f"f{k}" for k in range(n_fp)]
    fps = fingerprints(docs, n_words, n_fp)
    first = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "t")
    distinct = fps.groupBy(*names).agg(F.min(first).alias("first"))
    # a fingerprint of one word is its own vertex number; longer ones are numbered by a 64-bit hash of all words
    distinct = C.materialize(distinct.select(F.col("f0").alias("id") if n_fp == 1 else F.xxhash64(*names).alias("id"), *names, "first"), "distinct-fingerprints")
    edges = links(distinct, n_fp, max_bits, per)
    roots = components(edges)
    linked = roots.select(F.col("v").alias("id"), "root").union(roots.select("root", "root").distinct())
    linked = C.materialize(linked.join(distinct.select("id", "first"), "id"), "linked-fingerprints")
    C.release(edges, roots)
    best = linked.groupBy("root").agg(F.min("first").alias("best"))
    mapped = distinct.join(linked.join(best, "root").select("id", "best"), "id", "left")
    mapped = mapped.select(*names, F.coalesce("best", "first").alias("best"))
    out = fps.join(mapped, names, "left")
    kept = F.col("doc_id").eqNullSafe(F.col("best.doc_id")) & (F.col("t") == F.col("best.t"))
    return C.resting_on(out.select("doc_id", "t", *names, F.col("best.doc_id").alias("component_id"), kept.alias("kept")), fps, distinct, linked)


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (hex), component_id: shingles of four words, links at four bits or fewer."""
    out = group(docs, n_words=4, n_fp=1, max_bits=4, per=16)
    return out.select("doc_id", F.lower(F.lpad(F.hex("f0"), 16, "0")).alias("fingerprint"), "component_id")


#: The pipeline's stage: shingles of five words, 320 bits, thirteen groups of twelve segments. Similarity is the cosine
#: of shingle counts, which is what a fingerprint measures: at a cosine of 0.8 two documents differ in 20.5 % of the bits
#: on average, 66 of 320. A Jaccard similarity of 0.8 is a cosine of 0.89 (48 bits, with a deviation of 6); 68 reaches
#: practically all of these, and they share a cell of some group in 994 of 1,000 cases.
STAGE = {"n_words": 5, "n_fp": 5, "max_bits": 68, "per": 12}
#: Up to so many dropped rows (16 bytes each) are broadcast; more are joined by shuffle.
BROADCAST_DROPS = 1_000_000


def keep_one(docs: DataFrame, **how: int) -> DataFrame:
    """The rows of docs, with their columns, but one of each group: the first by doc_id (null last) and text hash."""
    out = group(docs, **(how or STAGE))
    drops = C.materialize(out.filter(~F.col("kept")).select(F.col("doc_id").alias("__i"), F.col("t").alias("__t")).distinct(), "near-duplicates")
    repeated = not out.filter("kept").groupBy("doc_id", "t").count().filter("count > 1").isEmpty()
    C.release(out)
    keys = [F.col("doc_id").cast("long").eqNullSafe(F.col("__i")), F.xxhash64("text") == F.col("__t")]
    kept = docs.join(F.broadcast(drops) if C.fits(drops, BROADCAST_DROPS) else drops, keys, "left_anti")
    if repeated:  # rows that repeat both doc_id and text
        kept = kept.withColumn("__t", F.xxhash64("text")).dropDuplicates(["doc_id", "__t"]).drop("__t")
    return kept
