"""WARC archives with dictionary compression: a Zstandard dictionary built from the records of each archive stands in
a leading skippable frame, and every record is a frame of its own.

Records with equal payloads are decided on digests before any file is written; a payload travels to the writer
without a shuffle unless many payloads repeat.
"""

from __future__ import annotations

import hashlib
import re
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

SKIPPABLE = 0x184D2A5D
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: The dictionary is trained on an archive's first records, up to these bounds.
SAMPLE_RECORDS, SAMPLE_BYTES, DICT_BYTES = 600, 3 << 20, 64 << 10
ARCHIVE_BYTES = 512 << 20
#: Up to so many repeated digests (about 50 bytes each) are broadcast.
BROADCAST_DIGESTS = 250_000
MANIFEST = "path string, n_records long, n_bytes long"
FEED, READ_BYTES = 64 << 10, 8 << 20


def decide(pages: DataFrame, min_bytes: int = 100) -> DataFrame:
    """page_id, url, html, digest (hex SHA-256), refers_to and first_url (of the response; null for responses).

    Of equal payloads of at least min_bytes, the smallest page_id is the response and the others refer to it. Null
    html is an empty payload. Rows that repeat that smallest page_id are all responses; a null page_id refers to any
    other holder and is a response where there is none.
    """
    p = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html"), F.lit("")).alias("html"))
    p = p.withColumn("digest", F.sha2(F.col("html").cast("binary"), 256)).withColumn("n_bytes", F.octet_length("html").cast("long"))
    held = p.filter(F.col("n_bytes") >= min_bytes).groupBy("digest").agg(F.min(F.struct(F.col("page_id").isNull().alias("none"), "page_id", F.coalesce("url", F.lit("")).alias("url"))).alias("first"), F.count(F.lit(1)).alias("n"))
    repeated = C.materialize(held.filter("n > 1 and not first.none").select("digest", F.col("first.page_id").alias("first"), F.col("first.url").alias("first_url")), "repeated-payloads")
    joined = p.join(F.broadcast(repeated) if C.fits(repeated, BROADCAST_DIGESTS) else repeated, "digest", "left")
    other = ~F.col("page_id").eqNullSafe(F.col("first"))
    return joined.select("page_id", "url", "html", "digest", F.when(other, F.col("first")).alias("refers_to"), F.when(other, F.col("first_url")).alias("first_url"))


def record_id(page_id: int | None, url: str | None, digest: str) -> str:
    """The same for rows that agree in all three; rows without a page_id, which nothing refers to, get a new one each."""
    name = uuid.uuid4() if page_id is None else uuid.uuid5(uuid.NAMESPACE_OID, f"{page_id}:{digest}:{url or ''}")
    return f"<urn:uuid:{name}>"


def record(page_id: int | None, url: str | None, html: str, digest: str, refers_to: int | None, first_url: str | None = None, date: str = "") -> bytes:
    body = html.encode("utf-8", "surrogatepass")
    uri = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url) if url else f"urn:page:{page_id}"
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(body)
    block = http + body if refers_to is None else http
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Target-URI: {uri}",
        f"WARC-Date: {date}",
        f"WARC-Record-ID: {record_id(page_id, url, digest)}",
        f"WARC-Payload-Digest: sha256:{digest}",
        f"X-Payload-Length: {len(body)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if page_id is not None:
        head.append(f"X-Page-Id: {page_id}")
    if refers_to is not None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(refers_to, first_url, digest)}", f"X-Refers-To-Page: {refers_to}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes) -> dict:
    """Header fields (lower-case names), type and payload of a record; checks lengths and a response's digest."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    version, *lines = head.decode("utf-8").split("\r\n")
    fields = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines)}
    block = rest[: int(fields["content-length"])]
    if version != "WARC/1.1" or rest[len(block) :] != b"\r\n\r\n":
        raise ValueError("not a whole WARC record")
    out = {"fields": fields, "type": fields["warc-type"], "payload": None}
    if out["type"] == "response":
        out["payload"] = block.partition(b"\r\n\r\n")[2]
        if "sha256:" + hashlib.sha256(out["payload"]).hexdigest() != fields["warc-payload-digest"]:
            raise ValueError(f"payload digest of {fields['warc-record-id']} does not match")
    return out


def train(records: list[bytes], dict_bytes: int = DICT_BYTES):
    """A dictionary, or None where the records are too few or too short for one."""
    import zstandard

    if len(records) < 16 or sum(map(len, records)) < 8 * 1024:
        return None
    try:
        return zstandard.train_dictionary(min(dict_bytes, sum(map(len, records)) // 8), records, k=256, d=8)
    except zstandard.ZstdError:
        return None


class Archive:
    def __init__(self, folder: str, level: int):
        self.path, self.level = f"{folder}/{uuid.uuid4().hex}.warc.zst", level
        self.waiting: list[bytes] = []
        self.held = self.records = self.bytes = 0
        self.out = None

    def add(self, raw: bytes) -> None:
        self.records += 1
        if self.out:
            return self._put(self.frame.compress(raw))
        self.waiting.append(raw)
        self.held += len(raw)
        if len(self.waiting) >= SAMPLE_RECORDS or self.held >= SAMPLE_BYTES:
            self._open()

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.bytes += len(data)

    def _open(self) -> None:
        import zstandard

        fs, path = C.filesystem(self.path)
        fs.create_dir(path.rpartition("/")[0], recursive=True)
        self.out = fs.open_output_stream(path, compression=None)
        words = train(self.waiting)
        packed = zstandard.ZstdCompressor(level=19).compress(words.as_bytes()) if words else b""
        self._put(struct.pack("<II", SKIPPABLE, len(packed)) + packed)
        self.frame = zstandard.ZstdCompressor(level=self.level, dict_data=words, write_checksum=True)
        for raw in self.waiting:
            self._put(self.frame.compress(raw))
        self.waiting = []

    def close(self) -> tuple[str, int, int]:
        if not self.out:
            self._open()
        self.out.close()
        return self.path, self.records, self.bytes


def write_warc(pages: DataFrame, folder: str, min_bytes: int = 100, level: int = 6, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Write one record a row into archives below folder; returns the manifest (path, n_records, n_bytes).

    Attempts write files of their own names, and the manifest names those of committed tasks only. An empty table
    gives no archive. Other columns are ignored.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archive, done = None, []
        for whole in batches:
            for batch in C.pieces(whole, "html"):
                for row in batch.to_pylist():
                    archive = archive or Archive(folder, level)
                    archive.add(record(**row, date=date))
                    if archive.bytes >= ARCHIVE_BYTES:
                        done.append(archive.close())
                        archive = None
        if archive:
            done.append(archive.close())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done, strict=True)], names=["path", "n_records", "n_bytes"])

    return C.materialize(decide(pages, min_bytes).mapInArrow(write, MANIFEST), "warc-manifest")


def records(path: str) -> Iterator[bytes]:
    """The records of an archive, one frame after the other, in bounded memory."""
    import zstandard

    fs, local = C.filesystem(path)
    with fs.open_input_stream(local, compression=None) as f:
        magic, size = struct.unpack("<II", f.read(8))
        if magic != SKIPPABLE:
            raise ValueError("no leading dictionary frame")
        packed = f.read(size)
        if packed[:4] == b"\x28\xb5\x2f\xfd":
            packed = zstandard.ZstdDecompressor().decompress(packed)
        words = zstandard.ZstdCompressionDict(packed) if packed else None
        unzip = zstandard.ZstdDecompressor(dict_data=words)
        left = f.read(FEED)
        while left:
            frame, parts = unzip.decompressobj(), []
            while True:
                parts.append(frame.decompress(left))
                left = frame.unused_data
                if frame.eof:
                    break
                left = f.read(FEED)
                if not left:
                    raise ValueError("archive ends within a record")
            yield b"".join(parts)
            left = left or f.read(FEED)


def read_warc(manifest: DataFrame, with_payload: bool = False) -> DataFrame:
    """page_id, url, payload_bytes, payload_digest, record_type, refers_to (and payload) of every record."""
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"] + ["payload"] * with_payload
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64()] + [pa.binary()] * with_payload
    paths = manifest.select("path").repartition(int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions")), "path")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                rows: list[tuple] = []
                held = 0
                for raw in records(path):
                    x = parse(raw)
                    f = x["fields"]
                    number = lambda k, f=f: int(f[k]) if k in f else None
                    n = number("x-payload-length") if x["payload"] is None else len(x["payload"])
                    rows.append((number("x-page-id"), f["warc-target-uri"], n, f["warc-payload-digest"].removeprefix("sha256:"), x["type"], number("x-refers-to-page"), x["payload"])[: len(names)])
                    held += n or 0
                    if len(rows) == 500 or held >= READ_BYTES:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    schema = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long" + ", payload binary" * with_payload
    return paths.mapInArrow(read, schema)


def digest(pages: DataFrame) -> DataFrame:
    manifest = write_warc(pages, C.scratch(pages.sparkSession, "warc"))
    return read_warc(manifest).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha256(coalesce(html, '')) AS digest FROM pages),
f AS (SELECT digest, min(page_id) AS first FROM p WHERE n >= 100 GROUP BY digest)
SELECT p.page_id, p.n::BIGINT AS payload_bytes, p.digest AS payload_digest,
       CASE WHEN f.first IS NULL OR f.first = p.page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN f.first <> p.page_id THEN f.first END AS refers_to
FROM p LEFT JOIN f ON p.digest = f.digest
"""
