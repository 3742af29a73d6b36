"""Removal of repeated byte strings by external induced sorting of suffixes.

A string of ``length`` bytes repeats if it starts anywhere else too. Suffixes need an order on their first ``length``
bytes only, and only those need one that share a sampled core with another suffix:

1. Every window of ``length`` bytes has an anchor: the position in it whose core of CORE bytes hashes least. Equal
   windows have equal anchors, so anchors are sampled suffixes that depend on content alone.
2. Cores that occur once are left out: no window with such an anchor repeats.
3. Sampled suffixes are dealt into shards by core. A core with more than HOT of them is split by the bytes around it:
   windows whose anchor lies from ``lo`` to ``hi`` bytes behind their start all hold the bytes from ``lo`` before the
   anchor to ``length - hi`` behind it, so equal windows share a hash of those and meet in one of several smaller keys.
4. Within a shard the sampled suffixes come sorted by their bytes from Spark's own external sort, which writes runs to
   disk and merges them, and are read as a stream; neighbours give their common prefix.
5. The order of all other suffixes is induced from right to left, a byte a round: the suffixes one byte to the left, in
   the order of their first byte and then of the suffix they came from. A priority queue with a bucket a byte value
   takes tuples (suffix, common prefix, bytes still to the left) in the old order and gives them in the new one; beyond
   a bound its tuples go to files, so a shard or a single core may be far larger than memory. A common prefix is one
   more than the least on the way from the last tuple of the same bucket. Each round feeds the next.
6. A window repeats if the common prefix with a neighbour is ``length`` or more, or its content occurs twice. Runs of
   such windows travel in the tuples and leave as a stream, too.

Why one level of sampling is enough: induced sorting recurses to order sampled suffixes whose strings up to the next
sample are equal, as suffixes of unbounded length need it. Here two suffixes that agree on ``length`` bytes need no
order, so step 4 settles all sampled suffixes by at most ``length`` bytes and the reduced string of names would only
be compared to that depth. The induction itself is applied to its own results, ``length - CORE`` rounds deep.

Texts are shuffled twice: to meet their sampled suffixes, and to meet the spans that go.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

LENGTH, CORE = 200, 40
_BASE = 0x9E3779B97F4A7C15 | 1
_POSITION_BITS = 20
#: Bytes of a text whose anchors are found at a time; windows are never cut by it.
STRETCH = 1 << 19
#: Suffixes of a shard that are induced together; a core with more stays together, its tuples in files.
BLOCK = 16_384
#: Bytes of tuples that a queue holds before it writes to disk; tuples taken from it at a time.
QUEUE_BYTES, TAKE = 8 << 20, 4_096
#: Sampled suffixes of one core from which it is split by the bytes around it, and the width of the split.
HOT, SPLIT = 20_000, 40
_NO_ID, _CLOSED = -(1 << 63), 255
_powers: dict[str, np.ndarray] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, modulo 2^64."""
    if len(_powers.get("up", ())) < n:
        size = max(n, 1 << 16)
        for name, b in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            x = np.full(size, np.uint64(b), np.uint64)
            x[0] = 1
            _powers[name] = np.cumprod(x, dtype=np.uint64)
    return _powers["up"][:n], _powers["down"][:n]


def _core_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of the CORE bytes from every position."""
    up, down = _power_tables(len(data))
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up, dtype=np.uint64, out=total[1:])
    h = (total[CORE:] - total[: len(total) - CORE]) * down[: len(data) - CORE + 1]
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)


def anchors(text: bytes, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(core hash, first window, number of windows, anchor minus first window), the windows of an anchor in a row."""
    width = length - CORE + 1
    out = []
    for begin in range(0, max(0, len(text) - length + 1), STRETCH):
        data = np.frombuffer(text, np.uint8, min(len(text) - begin, STRETCH + length - 1), begin)
        h = _core_hashes(data)
        bits = np.uint64(_POSITION_BITS)
        ranked = ((h >> bits) << bits) | np.arange(len(h), dtype=np.uint64)
        n = len(ranked) - width + 1
        padded = np.full(-(-len(ranked) // width) * width, np.uint64(2**64 - 1), np.uint64)
        padded[: len(ranked)] = ranked
        rows = padded.reshape(-1, width)
        ahead = np.minimum.accumulate(rows, 1).ravel()
        behind = np.minimum.accumulate(rows[:, ::-1], 1)[:, ::-1].ravel()
        at = (np.minimum(behind[:n], ahead[width - 1 : width - 1 + n]) & np.uint64((1 << _POSITION_BITS) - 1)).astype(np.int64)
        first = np.concatenate([[0], np.flatnonzero(at[1:] != at[:-1]) + 1])
        out.append((h[at[first]].view(np.int64), first + begin, np.diff(np.concatenate([first, [n]])), at[first] - first))
    if not out:
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _tuples(width: int) -> np.dtype:
    """Names of a suffix (core, content), common prefix with the tuple before, the anchor's distance, the least one of
    its windows, whether its content repeats, where a run of repeated windows began, and the bytes still to the left."""
    return np.dtype([("h", "<i8"), ("s", "<i8"), ("lcp", "u1"), ("shift", "u1"), ("low", "u1"), ("many", "u1"), ("open", "u1"), ("left", "u1", (width,))])


class TupleQueue:
    """Tuples in, in order; out by byte value, first in first out among equal ones. Beyond ``memory`` bytes they go to
    files below ``folder``, in the storage that survives a lost executor; a retried task writes files of its own."""

    def __init__(self, kind: np.dtype, memory: int, folder: str):
        self.kind, self.memory, self.folder, self.held = kind, memory, folder, 0
        self.files: list[str] = []
        self.buckets: list[list[np.ndarray]] = [[] for _ in range(256)]
        self.runs: list[list[tuple[int, int, int]]] = [[] for _ in range(256)]

    def push(self, bytes_: np.ndarray, tuples: np.ndarray) -> None:
        """bytes_ ascending; equal ones in order."""
        values, start = np.unique(bytes_, return_index=True)
        for v, part in zip(values.tolist(), np.split(tuples, start[1:]), strict=True):
            self.buckets[v].append(part)
        self.held += tuples.nbytes
        if self.held > self.memory:
            self._spill()

    def _spill(self) -> None:
        path = f"{self.folder}/{uuid.uuid4().hex}.tuples"
        fs, local = C.filesystem(path)
        fs.create_dir(local.rpartition("/")[0], recursive=True)
        at = 0
        with fs.open_output_stream(local, compression=None) as out:
            for v, parts in enumerate(self.buckets):
                if parts:
                    size = sum(out.write(np.ascontiguousarray(p).tobytes()) for p in parts)
                    self.runs[v].append((len(self.files), at, size))
                    at += size
        self.files.append(path)
        self.buckets, self.held = [[] for _ in range(256)], 0

    def take(self) -> Iterator[np.ndarray]:
        """All tuples, in blocks; the queue is empty then, its files are gone."""
        fs, opened = None, []
        for path in self.files:
            fs, local = C.filesystem(path)
            opened.append((local, fs.open_input_file(local)))
        wait: list[np.ndarray] = []
        n = 0
        try:
            for v in range(256):
                for part in self._bucket(v, opened):
                    wait.append(part)
                    n += len(part)
                    if n >= TAKE:
                        yield np.concatenate(wait)
                        wait, n = [], 0
            if wait:
                yield np.concatenate(wait)
        finally:
            for local, f in opened:
                f.close()
                fs.delete_file(local)
            self.files = []

    def _bucket(self, v: int, opened: list) -> Iterator[np.ndarray]:
        step = TAKE * self.kind.itemsize
        for k, at, size in self.runs[v]:
            for off in range(0, size, step):
                opened[k][1].seek(at + off)
                yield np.frombuffer(opened[k][1].read(min(step, size - off)), self.kind)
        yield from self.buckets[v]
        self.buckets[v] = []


class _Induce:
    """Turns tuples in the order of one round into those of the next, block by block."""

    def __init__(self):
        self.least = np.full(256, 0, np.int64)  # from the last tuple of a byte to the end of the last block

    def __call__(self, byte: np.ndarray, lcp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(order by byte, least common prefix since the last tuple of the same byte) for a block."""
        order = np.argsort(byte, kind="stable")
        c, n = byte[order], len(byte)
        fresh = np.concatenate([[True], c[1:] != c[:-1]])
        low = np.empty(n, np.int64)
        head = np.minimum.accumulate(lcp)
        low[fresh] = np.minimum(self.least[c[fresh]], head[order[fresh]])
        later = np.flatnonzero(~fresh)
        if len(later):
            bounds = np.empty(2 * len(later), np.int64)
            bounds[0::2], bounds[1::2] = order[later - 1] + 1, order[later] + 1
            low[later] = np.minimum.reduceat(np.append(lcp, 255), bounds)[0::2]
        tail = np.append(np.minimum.accumulate(lcp[::-1])[::-1], 255)
        self.least = np.minimum(self.least, tail[0])
        last = np.flatnonzero(np.concatenate([c[1:] != c[:-1], [True]]))
        self.least[c[last]] = tail[order[last] + 1]
        return order, low

    def some(self, byte: np.ndarray, lcp: np.ndarray, go: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same for the tuples that go on; those that end still stand between others and count towards the least."""
        keep = np.flatnonzero(go)
        if len(keep) == len(go):
            return self(byte, lcp)
        if not len(keep):
            self.least = np.minimum(self.least, lcp.min())
            return keep, keep
        bounds = np.empty(2 * len(keep), np.int64)
        bounds[0::2], bounds[1::2] = np.concatenate([[0], keep[:-1] + 1]), keep + 1
        order, low = self(byte[keep], np.minimum.reduceat(np.append(lcp, 255), bounds)[0::2])
        self.least = np.minimum(self.least, lcp[keep[-1] + 1 :].min(initial=255))
        return keep[order], low


def _matrix(values: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, lengths) of binary values of up to ``width`` bytes, one a row, with zeros behind them."""
    values = values.cast(pa.large_binary())
    ends = np.frombuffer(values.buffers()[1], np.int64)[values.offset : values.offset + len(values) + 1]
    n = np.diff(ends)
    out = np.zeros((len(values), width), np.uint8)
    if ends[-1] > ends[0]:
        out[np.arange(width) < n[:, None]] = np.frombuffer(values.buffers()[2], np.uint8)[ends[0] : ends[-1]]
    return out, n


class Induction:
    """Repeated windows of sampled suffixes that come in order, block by block."""

    def __init__(self, length: int, memory: int, folder: str):
        self.length, self.memory, self.folder = length, memory, folder
        self.width = length - CORE
        self.queue = TupleQueue(_tuples(self.width), memory, folder)
        self.rows, self.last = 0, None

    def add(self, h: np.ndarray, s: np.ndarray, right: np.ndarray, given: np.ndarray, left: np.ndarray, shift: np.ndarray, count: np.ndarray, many: np.ndarray) -> None:
        """Suffixes in the order of core and bytes; right: the bytes from the anchor on, left: those before it, backwards."""
        n, length = len(h), self.length
        first = self.last or (h[0] - 1, right[0], given[0])
        before_h, before_n = np.concatenate([[first[0]], h[:-1]]), np.concatenate([[first[2]], given[:-1]])
        differ = np.empty((n, length), bool)
        differ[1:], differ[0] = right[1:] != right[:-1], right[0] != first[1]
        same = np.minimum(np.where(differ.any(1), differ.argmax(1), length), np.minimum(given, before_n))
        out = np.empty(n, self.queue.kind)
        for name, v in (("h", h), ("s", s), ("lcp", np.where(h == before_h, same, 0)), ("shift", shift), ("low", shift - count + 1), ("many", many), ("open", _CLOSED), ("left", left)):
            out[name] = v
        self.queue.push(np.zeros(n, np.uint8), out)
        self.last = h[-1], right[-1].copy(), given[-1]
        self.rows += n

    def run(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """(h, s, first, end): runs of repeated windows, numbered within their content."""
        queue, back = self.queue, 0
        while True:
            width = queue.kind["left"].shape[0]
            kind = _tuples(max(0, width - 1))
            following, induce, moved = TupleQueue(kind, self.memory, self.folder), _Induce(), False
            for block, after in _ahead(queue.take()):
                own = block["lcp"].astype(np.int64)
                near = np.append(own[1:], after) >= self.length
                hit = ((own >= self.length) | near | (block["many"] > 0)) & (block["low"] <= back)
                opened, ends = block["open"], block["shift"] == back
                was = opened != _CLOSED
                stop = was & ~hit  # the run ended a step before
                if stop.any():
                    x = block[stop]
                    yield x["h"], x["s"], x["shift"].astype(np.int32) - back + 1, x["shift"].astype(np.int32) - x["open"] + 1
                begun = np.where(hit, np.where(was, opened, back), _CLOSED).astype(np.uint8)
                stop = ends & hit
                if stop.any():
                    x = block[stop]
                    yield x["h"], x["s"], np.zeros(len(x), np.int32), x["shift"].astype(np.int32) - begun[stop] + 1
                if not width:
                    continue
                order, low = induce.some(block["left"][:, 0].astype(np.int64), own, ~ends)
                if len(order):
                    out = np.empty(len(order), kind)
                    for name in ("h", "s", "shift", "low", "many"):
                        out[name] = block[name][order]
                    out["lcp"], out["open"], out["left"] = np.minimum(low + 1, 255), begun[order], block["left"][order, 1:]
                    following.push(block["left"][order, 0], out)
                    moved = True
            if not moved:
                return
            queue, back = following, back + 1


def _ahead(blocks: Iterator[np.ndarray]) -> Iterator[tuple[np.ndarray, int]]:
    """Blocks with the common prefix that the tuple after their last one has with it."""
    held = None
    for block in blocks:
        if held is not None:
            yield held, int(block["lcp"][0])
        held = block
    if held is not None:
        yield held, 0


def _shard(batches: Iterator[pa.RecordBatch], length: int, memory: int, folder: str) -> Iterator[pa.RecordBatch]:
    """Rows (h, right, s, shift, count, left) sorted by h, right and s in; runs of repeated windows (h, s, a, b) out.

    At most a batch of rows, BLOCK tuples and the queue's bound are held, whatever the size of a core.
    """
    work, held = Induction(length, memory, folder), None

    def flush() -> Iterator[pa.RecordBatch]:
        for cols in work.run():
            yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in cols], names=["h", "s", "a", "b"])

    def feed(table: pa.Table, upto: int, many: np.ndarray, start: np.ndarray) -> Iterator[pa.RecordBatch]:
        """The contents that begin at start[:upto]; a core ends where h changes."""
        nonlocal work
        rows = table.take(pa.array(start[:upto])).combine_chunks()
        for a in range(0, upto, BLOCK):
            part = rows.slice(a, BLOCK).combine_chunks()
            column = lambda c, part=part: part.column(c).chunk(0)
            h, s, shift, count = (column(c).to_numpy() for c in ("h", "s", "shift", "count"))
            right, given = _matrix(column("right"), length)
            left = _matrix(column("left"), length - CORE)[0]
            cut = 0
            if work.rows and work.last[0] != h[0] and work.rows + len(h) > BLOCK:
                yield from flush()
                work = Induction(length, memory, folder)
            new = np.flatnonzero(h[1:] != h[:-1]) + 1
            if work.rows + len(h) > BLOCK and len(new):  # whole cores up to the bound, the rest starts anew
                cut = int(new[-1])
                work.add(h[:cut], s[:cut], right[:cut], given[:cut], left[:cut], shift[:cut], count[:cut], many[a : a + cut])
                yield from flush()
                work = Induction(length, memory, folder)
            work.add(h[cut:], s[cut:], right[cut:], given[cut:], left[cut:], shift[cut:], count[cut:], many[a + cut : a + len(h)])

    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        again = np.zeros(batch.num_rows, bool)
        if held is not None:
            table = pa.concat_tables([held[0], table])
            again = np.append([held[1]], again)
        h, s = table.column("h").to_numpy(), table.column("s").to_numpy()
        start = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (s[1:] != s[:-1])]))
        size = np.diff(np.append(start, len(h)))
        many = (size > 1) | again[start]
        if len(start) > 1:
            yield from feed(table, len(start) - 1, many, start)
        held = pa.Table.from_batches(table.slice(int(start[-1]), 1).to_batches()), bool(many[-1])
    if held is not None:
        yield from feed(held[0], 1, np.array([held[1]]), np.array([0]))
    if work.rows:
        yield from flush()


def _parts(shift: int, count: int, length: int) -> Iterator[tuple[int, int, int, int]]:
    """(first window, number of windows, bytes before the anchor, bytes from it on) of the pieces of a hot core's row:
    all windows of a piece hold those bytes."""
    for lo in range(0, length - CORE + 1, SPLIT):
        hi = min(lo + SPLIT, length - CORE + 1)
        a, b = max(0, shift - hi + 1), min(count - 1, shift - lo)
        if a <= b:
            yield a, b - a + 1, lo, length - hi + 1


def remove_repeats(docs: DataFrame, length: int = LENGTH, memory: int = QUEUE_BYTES, hot: int = HOT) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept (binary; null where nothing goes), kept_sha256 for every row.

    Each byte covered by a string of ``length`` bytes that also starts elsewhere, in the same text or another, goes;
    strings are judged on the input and never cross texts. Null text is empty. Rows that repeat are texts of their own,
    and so lose what they share. A null doc_id stays null. Other columns are ignored.
    """
    if length < 2 * CORE or length >= _CLOSED:
        raise ValueError(f"length must be from {2 * CORE} to {_CLOSED - 1}")
    spark = docs.sparkSession
    n_parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)).alias("k"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.select("k", F.xxhash64("text").alias("t"), "text")

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One row an anchor; p holds position, windows and distance of the anchor."""
        for whole in batches:
            for batch in C.pieces(whole):
                found = [anchors(t, length) for t in batch.column("text").cast(pa.large_binary()).to_pylist()]
                n = [len(x[0]) for x in found]
                h, i0, count, shift = (np.concatenate(x) for x in zip(*found, strict=True))
                k, t = (np.repeat(batch.column(c).to_numpy(), n) for c in ("k", "t"))
                yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(k), pa.array(t), pa.array(i0 << 16 | (count - 1) << 8 | shift)], names=["h", "k", "t", "p"])

    sampled = C.materialize(rows.mapInArrow(sample, "h long, k long, t long, p long"), "sampled-suffixes")
    counted = sampled.groupBy("h").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    shared = C.materialize(counted.select("h", (F.col("n") > hot).cast("long").alias("hot")), "shared-cores")
    lists = sampled.join(shared, "h").groupBy("k", "t").agg(F.collect_set(F.struct("h", (F.col("p") * 2 + F.col("hot")).alias("p"))).alias("own"))
    lists = C.materialize(lists, "suffixes-by-text")
    C.release(sampled, shared)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The bytes of every sampled suffix; again counts a content's rows in this task, up to 2, and only the first two
        have the bytes."""
        import xxhash

        seen: dict[tuple[int, int], int] = {}
        signed = lambda x: x - ((x >> 63) << 64)
        digest = xxhash.xxh3_64_intdigest
        kinds = [pa.int64()] * 4 + [pa.int32()] * 4 + [pa.binary()] * 2
        names = ["h", "s", "k", "t", "i", "count", "shift", "again", "right", "left"]

        def packed(out: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*out, strict=True), kinds, strict=True)], names=names)

        for whole in batches:
            for batch in C.pieces(whole):
                out: list[tuple] = []
                texts = batch.column("text").cast(pa.large_binary())
                own = batch.column("own")
                for j in range(batch.num_rows):
                    text, k, t = texts[j].as_py(), batch.column("k")[j].as_py(), batch.column("t")[j].as_py()
                    cores, places = (own[j].values.field(c).to_pylist() for c in ("h", "p"))
                    for h, p in zip(cores, places, strict=True):
                        i, n, shift = p >> 17, (p >> 9 & 255) + 1, p >> 1 & 255
                        at = i + shift
                        pieces = [(h, i, n, shift)]
                        if p & 1:
                            pieces = [(signed(digest(text[at - lo : at + right], lo)), i + a, m, shift - a) for a, m, lo, right in _parts(shift, n, length)]
                        for key, i, n, shift in pieces:  # noqa: B020, PLW2901
                            seg = text[i : i + n - 1 + length]
                            s = signed(digest(seg))
                            again = seen.get((key, s), 0)
                            if not again and len(seen) >= 200_000:
                                seen.clear()
                            seen[key, s] = min(again + 1, 2)
                            out.append((key, s, k, t, i, n, shift, again, seg[shift : shift + length] if again < 2 else None, seg[:shift][::-1] if again < 2 else None))
                    if len(out) >= BLOCK:
                        yield packed(out)
                        out = []
                if out:
                    yield packed(out)

    segments = C.materialize(rows.join(lists, ["k", "t"]).mapInArrow(cut, "h long, s long, k long, t long, i int, count int, shift int, again int, right binary, left binary"), "segments")
    C.release(lists)
    folder = C.scratch(spark, "tuples")
    # two rows of a task say that a content repeats; more would only crowd the shard of a common one
    dealt = segments.filter("again < 2").select("h", "right", "s", "shift", "count", "left").repartition(n_parts, "h").sortWithinPartitions("h", "right", "s")
    verdicts = C.materialize(dealt.mapInArrow(lambda b: _shard(b, length, memory, folder), "h long, s long, a int, b int"), "repeated-windows")
    C.delete(spark, folder)
    spans = segments.select("h", "s", "k", "t", "i").join(verdicts, ["h", "s"])
    spans = spans.groupBy("k", "t").agg(F.collect_set(F.struct((F.col("i") + F.col("a")).alias("a"), (F.col("i") + F.col("b") - 1 + length).alias("b"))).alias("spans"))
    spans = C.materialize(spans, "repeated-spans")
    C.release(segments, verdicts)

    def strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64()] * 4 + [pa.binary()]
        for whole in batches:
            for batch in C.pieces(whole):
                out = []
                texts, found = batch.column("text").cast(pa.large_binary()), batch.column("spans")
                for j, k in enumerate(batch.column("k").to_pylist()):
                    text = texts[j].as_py()
                    kept, at, removed, n, end = [], 0, 0, 0, -1
                    for a, b in sorted(zip(*(found[j].values.field(c).to_pylist() for c in ("a", "b")), strict=True)):
                        if a > end:
                            n += 1
                            kept.append(text[at:a])
                        removed += max(0, b - max(a, end))
                        end = max(end, b)
                        at = end
                    kept.append(text[at:])
                    out.append((k, len(text), removed, n, b"".join(kept)))
                yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*out, strict=True), kinds, strict=True)], names=["k", "n_bytes", "n_removed", "n_spans", "kept"])

    stripped = rows.join(spans, ["k", "t"]).select("k", "text", "spans").mapInArrow(strip, "k long, n_bytes long, n_removed long, n_spans long, kept binary")
    stripped = stripped.withColumn("sha", F.sha2("kept", 256))
    zero = F.lit(0).cast("long")
    whole = rows.join(spans.select("k", "t"), ["k", "t"], "left_anti").select("k", F.octet_length("text").cast("long").alias("n_bytes"), zero.alias("n_removed"), zero.alias("n_spans"), F.lit(None).cast("binary").alias("kept"), F.sha2(F.col("text").cast("binary"), 256).alias("sha"))
    out = stripped.unionByName(whole)
    return out.select(F.when(F.col("k") != _NO_ID, F.col("k")).alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept", F.col("sha").alias("kept_sha256"))


def digest(docs: DataFrame) -> DataFrame:
    return remove_repeats(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
