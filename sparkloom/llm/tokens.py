"""Token-ID output: length-delimited records with masked checksums, and a separate offset index.

A shard is a data file of frames ``u64 length, u32 masked CRC-32C of the length, payload, u32 masked CRC-32C of the
payload`` (all little-endian) and an index file of fixed-size entries, so that a reader can fetch records in any
order. A payload is ``i64 doc_id, u32 number of ids, u32 flags, ids`` with ids of 16 bits where the vocabulary allows.

Rows are range-partitioned by doc_id, so shards in order hold documents in ascending order. Every attempt of a task
writes files of its own name; only those named in the committed manifest are read.
"""

from __future__ import annotations

import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common as C
from .crc32c import crc32c, masked

INDEX = np.dtype([("doc_id", "<i8"), ("offset", "<u8"), ("length", "<u4"), ("n", "<u4"), ("flags", "<u4")])
NULL_ID, WIDE = 1, 2
SHARD_BYTES = 256 << 20
READ_BYTES = 4 << 20
#: Bytes of text that are encoded at a time.
LONG = 2 << 20
CACHED_WORDS = 300_000
MANIFEST = "part int, roll int, data string, index string, n_docs long, n_tokens long, n_bytes long"

_PLAIN = re.compile(r"[a-zß-öø-ÿ]+")


def _byte_alphabet() -> dict[int, int]:
    """How byte-level vocabularies write bytes: printable ones as themselves, the others from 256 on."""
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    return {b: 256 + k for k, b in enumerate(b for b in range(256) if b not in kept)}


class Encoder:
    """Ids of texts, equal to the library's encoding of each whole text.

    The vocabulary's pieces never span white space, nor a lower-case ASCII letter followed by one of the split-off
    marks, so texts are cut there, and every distinct cut is encoded once for as long as it is remembered. With other
    vocabularies than lower-case word ones, whole texts are encoded.
    """

    def __init__(self, path: str, end_id: int):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.end_id = end_id
        self.wide = max(self.tokenizer.get_vocab_size(with_added_tokens=True), end_id + 1) > 1 << 16
        self.dtype = np.dtype("<u4" if self.wide else "<u2")
        self.bytes = _byte_alphabet()
        self.cuts = self._is_word_vocabulary()
        self.forget()

    def _is_word_vocabulary(self) -> bool:
        import json

        spec = json.loads(self.tokenizer.to_str())
        norm, pre = json.dumps(spec.get("normalizer")), json.dumps(spec.get("pre_tokenizer"))
        return spec["model"].get("end_of_word_suffix") == "</w>" and "Lowercase" in norm and r"[^\\s\\p{L}\\p{N}]+" in pre and "Removed" in pre

    def forget(self) -> None:
        self.rows: dict[str, int] = {}
        self.store, self.used = np.zeros(1 << 16, self.dtype), 0
        self.begin, self.count = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64)

    def _learn(self, word: str) -> None:
        if _PLAIN.fullmatch(word):
            ids = [t.id for t in self.tokenizer.model.tokenize(word if word.isascii() else word.encode().decode("latin-1").translate(self.bytes))]
        else:
            ids = self.tokenizer.encode(word, add_special_tokens=False).ids if word else []
        k, n = len(self.rows), len(ids)
        if k == len(self.begin):
            self.begin, self.count = (np.concatenate([x, np.zeros_like(x)]) for x in (self.begin, self.count))
        while self.used + n > len(self.store):
            self.store = np.concatenate([self.store, np.zeros_like(self.store)])
        self.store[self.used : self.used + n] = ids
        self.begin[k], self.count[k] = self.used, n
        self.used += n
        self.rows[word] = k

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of each text, the end id included; null is empty. Long texts are encoded stretch by stretch where the
        vocabulary allows, so that memory follows the ids and not what leads to them."""
        texts = texts.fill_null("")
        if self.cuts and len(texts) == 1 and (text := texts.cast(pa.large_binary())[0].as_py()) and len(text) > LONG:
            parts = [self._encode(pa.array([part.decode()]))[0][:-1] for part in C.stretches(text, LONG)]
            return [np.concatenate([*parts, np.array([self.end_id], self.dtype)])]
        return self._encode(texts)

    def _encode(self, texts: pa.Array) -> list[np.ndarray]:
        if not self.cuts:
            found = self.tokenizer.encode_batch(texts.to_pylist(), add_special_tokens=False)
            return [np.array([*e.ids, self.end_id], self.dtype) for e in found]
        if len(self.rows) > CACHED_WORDS:
            self.forget()
        if texts.offset:  # kernels below misread slices
            texts = texts.take(pa.array(np.arange(len(texts))))
        t = pc.replace_substring(pc.ascii_lower(texts.cast(pa.large_string())), "\n", " ")
        words = pc.split_pattern(pc.replace_substring_regex(t, r"([a-z])([.,!?;:%&$#*])", r"\1 \2"), " ")
        flat = words.flatten().dictionary_encode()
        distinct = flat.dictionary.to_pylist()
        for w in distinct:
            if w not in self.rows:
                self._learn(w)
        row = np.fromiter(map(self.rows.__getitem__, distinct), np.int64, len(distinct))[flat.indices.to_numpy()]
        n = self.count[row]
        ends = np.cumsum(n)
        ids = self.store[np.arange(n.sum()) + np.repeat(self.begin[row] - ends + n, n)]
        offsets = words.offsets.to_numpy()
        cut = np.concatenate([[0], ends])[offsets - offsets[0]]
        last = np.array([self.end_id], self.dtype)
        return [np.concatenate([ids[a:b], last]) for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)]


_ENCODERS: dict[tuple[str, int], Encoder] = {}


def encoder(path: str, end_id: int) -> Encoder:
    key = (path, end_id)
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(path, end_id)
    return _ENCODERS[key]


def frames(doc_ids: list[int | None], ids: list[np.ndarray]) -> tuple[list[bytes], np.ndarray]:
    """The frames of some records, and their index entries with offsets from 0."""
    entries = np.zeros(len(ids), INDEX)
    payloads = []
    for k, (d, x) in enumerate(zip(doc_ids, ids, strict=True)):
        flags = (NULL_ID if d is None else 0) | (WIDE if x.dtype.itemsize == 4 else 0)
        head = (d or 0).to_bytes(8, "little", signed=True) + len(x).to_bytes(4, "little") + flags.to_bytes(4, "little")
        payloads.append(head + x.tobytes())
        entries[k] = (d or 0, 0, 0, len(x), flags)
    lengths = [len(p).to_bytes(8, "little") for p in payloads]
    of_length, of_data = (masked(crc32c(x)).astype("<u4") for x in (lengths, payloads))
    out = [n + a.tobytes() + p + b.tobytes() for n, a, p, b in zip(lengths, of_length, payloads, of_data, strict=True)]
    entries["length"] = [len(x) for x in out]
    entries["offset"] = np.cumsum(entries["length"], dtype=np.uint64) - entries["length"]
    return out, entries


def payloads(data: bytes, entries: np.ndarray, start: int) -> list[tuple[int | None, np.ndarray]]:
    """(doc_id, ids) of the records of some entries, from the bytes that begin at offset start; checks both sums."""
    views, lengths, sums = [], [], []
    for offset, size in zip(entries["offset"].tolist(), entries["length"].tolist(), strict=True):
        at = offset - start
        n = int.from_bytes(data[at : at + 8], "little")
        if n + 16 != size:
            raise ValueError(f"record at {offset}: length {n} is not what the index says")
        lengths.append(data[at : at + 8])
        views.append(data[at + 12 : at + 12 + n])
        sums.append((int.from_bytes(data[at + 8 : at + 12], "little"), int.from_bytes(data[at + 12 + n : at + 16 + n], "little")))
    want = np.array(sums, np.uint32).reshape(-1, 2)
    bad = (masked(crc32c(lengths)) != want[:, 0]) | (masked(crc32c(views)) != want[:, 1])
    if bad.any():
        raise ValueError(f"record at {int(entries['offset'][int(np.argmax(bad))])}: checksum does not match")
    out = []
    for v in views:
        n, flags = int.from_bytes(v[8:12], "little"), int.from_bytes(v[12:16], "little")
        ids = np.frombuffer(v, "<u4" if flags & WIDE else "<u2", n, 16)
        out.append((None if flags & NULL_ID else int.from_bytes(v[:8], "little", signed=True), ids))
    return out


class _Shard:
    def __init__(self, folder: str, part: int, roll: int):
        name = f"{part:06d}-{roll:04d}-{uuid.uuid4().hex[:8]}"
        self.part, self.roll = part, roll
        self.data, self.index = f"{folder}/{name}.rec", f"{folder}/{name}.idx"
        self.fs, path = C.filesystem(self.data)
        self.fs.create_dir(path.rpartition("/")[0], recursive=True)
        self.out, self.idx = (self.fs.open_output_stream(C.filesystem(p)[1], compression=None) for p in (self.data, self.index))
        self.docs = self.tokens = self.bytes = 0

    def add(self, doc_ids: list[int | None], ids: list[np.ndarray]) -> None:
        made, entries = frames(doc_ids, ids)
        entries["offset"] += self.bytes
        self.out.write(b"".join(made))
        self.idx.write(entries.tobytes())
        self.docs += len(entries)
        self.tokens += int(entries["n"].sum())
        self.bytes += int(entries["length"].sum())

    def close(self) -> tuple:
        self.out.close()
        self.idx.close()
        return self.part, self.roll, self.data, self.index, self.docs, self.tokens, self.bytes


def write_tokens(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 2, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Encode text, append end_id, write shards in ascending doc_id order below folder; returns the manifest.

    Null text is empty: its record holds the end id alone. A null doc_id comes first. Rows that share a doc_id each
    get a record, in the order of a hash of their texts. An empty table gives no shard. Other columns are ignored.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartitionByRange(n, "doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", "text")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, roll, shard, done = TaskContext.get().partitionId(), 0, None, []
        enc = encoder(tokenizer, end_id)
        for whole in batches:
            for batch in C.pieces(whole):
                shard = shard or _Shard(folder, part, roll)
                shard.add(batch.column("doc_id").to_pylist(), enc.encode(batch.column("text")))
                if shard.bytes >= shard_bytes:
                    done.append(shard.close())
                    shard, roll = None, roll + 1
        if shard:
            done.append(shard.close())
        for row in done:
            yield pa.RecordBatch.from_arrays(
                [pa.array([v], t) for v, t in zip(row, [pa.int32(), pa.int32(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64()], strict=True)],
                names=["part", "roll", "data", "index", "n_docs", "n_tokens", "n_bytes"],
            )

    return C.materialize(ordered.mapInArrow(write, MANIFEST), "token-manifest")


def read_tokens(manifest: DataFrame, with_ids: bool = False) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 (and ids) of every record, read back from the files and checked.

    start counts the ids of all documents before; the running sum over shards is over the manifest, one row a shard.
    """
    before = Window.orderBy("part", "roll").rowsBetween(Window.unboundedPreceding, -1)
    shards = manifest.select("data", "index", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("base"))
    shards = shards.repartition(int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions")), "data")
    names = ["doc_id", "start", "n_tokens", "ids_crc32"] + ["ids"] * with_ids
    kinds = [pa.int64()] * 4 + [pa.list_(pa.int32())] * with_ids

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                fs, path = C.filesystem(row["index"])
                with fs.open_input_stream(path, compression=None) as f:
                    entries = np.frombuffer(f.read(), INDEX)
                fs, path = C.filesystem(row["data"])
                start, a = row["base"], 0
                with fs.open_input_file(path) as f:
                    while a < len(entries):
                        begin = int(entries["offset"][a])
                        b = max(a + 1, int(np.searchsorted(entries["offset"], begin + READ_BYTES)))
                        part = entries[a:b]
                        f.seek(begin)
                        found = payloads(f.read(int(part["length"].sum())), part, begin)
                        n = part["n"].astype(np.int64)
                        starts = start + np.cumsum(n) - n
                        cols = [[d for d, _ in found], starts, n, [zlib.crc32(x.astype("<u4").tobytes()) for _, x in found]]
                        if with_ids:
                            cols.append([x.astype(np.int32) for _, x in found])
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names=names)
                        start, a = start + int(n.sum()), b

    return shards.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids)


def digest(docs: DataFrame, tokenizer: str, end_id: int = 2) -> DataFrame:
    return read_tokens(write_tokens(docs, C.scratch(docs.sparkSession, "tokens"), tokenizer, end_id))
