"""Scans: audio and latent folders, manifests, tar shards, sidecars, listings, tensor files."""

from __future__ import annotations

import io
import json
import struct
import tarfile
import wave
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..storage import filesystem

#: File endings of audio, and parts of names that are never data (fixed values).
AUDIO = ("wav", "mp3", "flac", "ogg", "aif", "opus")
BANNED = ("paxheader", "__macosx")


def files(spark: SparkSession, roots: str | list[str], exts: tuple[str, ...] = AUDIO, keywords: list[str] | None = None, content: bool = False) -> DataFrame:
    """path, name, dir, stem, ext, length (and content) of the files below roots: endings and keywords in any case, no
    dot files, no banned names. Only names are read unless content is asked for."""
    df = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(roots)
    df = df.select("path", "length", *(["content"] if content else []))
    df = df.withColumns({"name": F.regexp_extract("path", r"([^/]+)$", 1), "dir": F.regexp_replace("path", r"/[^/]+$", "")})
    df = df.withColumns({"ext": F.lower(F.regexp_extract("name", r"\.([^.]+)$", 1)), "stem": F.regexp_replace("name", r"\.[^.]+$", "")})
    low = F.lower("path")
    ok = F.col("ext").isin(*exts) & ~F.startswith("name", F.lit("."))
    for word in BANNED:
        ok = ok & ~F.contains(low, F.lit(word))
    if keywords:
        ok = ok & F.exists(F.array(*[F.lit(k.lower()) for k in keywords]), lambda k: F.contains(F.lower("name"), k))
    return df.filter(ok)


def file_list(spark: SparkSession, root: str, filelist: str | None = None, exts: tuple[str, ...] = AUDIO) -> DataFrame:
    """path: the lines of a file list below root where one is given (for this root only), else a scan."""
    if filelist:
        lines = spark.read.text(filelist).select(T.strip(F.col("value")).alias("p")).filter("p <> ''")
        return lines.select(F.concat(F.lit(root.rstrip("/") + "/"), F.col("p")).alias("path"))
    return files(spark, root, exts).select("path")


def latents(spark: SparkSession, root: str, ext: str = "npy", content: bool = False) -> DataFrame:
    """Latent files with the path of their JSON; the silence file is not one of them."""
    df = files(spark, root, (ext,), content=content).filter(F.col("name") != f"silence.{ext}")
    return df.withColumn("json_path", F.concat("dir", F.lit("/"), "stem", F.lit(".json")))


def captions(spark: SparkSession, root: str) -> DataFrame:
    """dir, stem, prompt of the text sidecars."""
    txt = files(spark, root, ("txt",), content=True)
    return txt.select("dir", "stem", T.strip(F.col("content").cast("string")).alias("prompt"))


def json_sidecars(spark: SparkSession, root: str, schema: str) -> DataFrame:
    """dir, stem, info (null where a file is not JSON of that schema)."""
    js = files(spark, root, ("json",), content=True)
    return js.select("dir", "stem", F.from_json(F.col("content").cast("string"), schema).alias("info"))


def manifest(spark: SparkSession, path: str, drop: tuple[str, ...] = ("primary_genre_hint_id",)) -> DataFrame:
    return spark.read.parquet(path).drop(*drop)


def _binary_map(df: DataFrame, fn: Callable[[bytes], object], name: str, kind: str, content: str = "content") -> DataFrame:
    """df without its content, with fn(content) as a column; what fn cannot read becomes a null and an error text."""
    from pyspark.sql.types import StructField, StructType, StringType, _parse_datatype_string

    fields = [f for f in df.schema.fields if f.name != content]
    out = StructType([*fields, StructField(name, _parse_datatype_string(kind)), StructField("error", StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(out)
        for b in batches:
            values, errors = [], []
            for raw in b.column(content).to_pylist():
                try:
                    values.append(None if raw is None else fn(raw))
                    errors.append(None)
                except Exception as e:  # a record that cannot be read is data here
                    values.append(None)
                    errors.append(f"{type(e).__name__}: {e}")
            cols = [b.column(f.name) for f in fields]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(values, arrow.field(len(fields)).type), pa.array(errors, pa.string())], schema=arrow)

    return df.mapInArrow(run, out)


def read_wav(raw: bytes) -> dict:
    """PCM of 8, 16, 24 or 32 bits to channel rows in [-1, 1]."""
    with wave.open(io.BytesIO(raw)) as w:
        n, width, rate, data = w.getnchannels(), w.getsampwidth(), w.getframerate(), w.readframes(w.getnframes())
    if width == 3:
        b = np.frombuffer(data, np.uint8).reshape(-1, 3).astype(np.int32)
        x = ((b[:, 0] << 8 | b[:, 1] << 16 | b[:, 2] << 24) >> 8) / 8388607
    elif width == 1:
        x = (np.frombuffer(data, np.uint8).astype(float) - 128) / 127
    else:
        x = np.frombuffer(data, f"<i{width}") / (32767 if width == 2 else 2147483647)
    return {"sample_rate": rate, "samples": np.clip(x, -1, 1).reshape(-1, n).T.astype(np.float32).tolist()}


def write_wav(samples: list[list[float]], rate: int) -> bytes:
    """16-bit PCM; values that are not finite are refused, others clipped."""
    x = np.asarray(samples, float)
    if not np.isfinite(x).all():
        raise ValueError("samples are not finite")
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(len(x))
        w.setsampwidth(2)
        w.setframerate(rate)
        w.writeframes((np.clip(x, -1, 1).T * 32767).astype("<i2").tobytes())
    return out.getvalue()


def read_npy(raw: bytes) -> list[list[float]]:
    x = np.load(io.BytesIO(raw), allow_pickle=False).astype(np.float32)
    return (x[None] if x.ndim == 1 else x.reshape(x.shape[0], -1)).tolist()


def write_npy(rows: list[list[float]]) -> bytes:
    out = io.BytesIO()
    np.save(out, np.asarray(rows, np.float32))
    return out.getvalue()


def wav(df: DataFrame) -> DataFrame:
    """Files with content to struct audio<sample_rate, samples>."""
    return _binary_map(df, read_wav, "audio", "struct<sample_rate:int, samples:array<array<float>>>")


def npy(df: DataFrame) -> DataFrame:
    return _binary_map(df, read_npy, "latent", "array<array<float>>")


DECODERS: dict[str, Callable[[bytes], object]] = {"wav": read_wav, "npy": read_npy}


def register_decoder(ext: str, fn: Callable[[bytes], object]) -> None:
    """A decoder by file ending; codecs beyond those here need a library of their own."""
    DECODERS[ext.lower()] = fn


def tar_members(df: DataFrame, errors: str = "skip") -> DataFrame:
    """Tar files (path, content) to members: url, key, ext, data. A damaged archive ends early or, unless skipped, fails."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for url, raw in zip(b.column("path").to_pylist(), b.column("content").to_pylist(), strict=True):
                rows = []
                try:
                    with tarfile.open(fileobj=io.BytesIO(raw)) as tar:
                        for m in tar:
                            base = m.name.rsplit("/", 1)[-1]
                            if m.isfile() and not base.startswith(".") and not any(x in m.name.lower() for x in BANNED):
                                stem, _, ext = base.partition(".")
                                rows.append((url, m.name[: len(m.name) - len(base)] + stem, ext.lower(), tar.extractfile(m).read()))
                except tarfile.TarError:
                    if errors != "skip":
                        raise
                for at in range(0, len(rows), 64):
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows[at : at + 64], strict=True)], names=["url", "key", "ext", "data"])

    return df.select("path", "content").mapInArrow(run, "url string, key string, ext string, data binary")


def webdataset(spark: SparkSession, root: str) -> DataFrame:
    """url, key, members: files of a key in a shard as a map by ending."""
    shards = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.tar").load(root)
    return tar_members(shards).groupBy("url", "key").agg(F.map_from_entries(F.collect_list(F.struct("ext", "data"))).alias("members"))


def untar_udtf(spark: SparkSession, name: str = "untar"):
    """Register a table function (content binary) -> (key, ext, data) for SQL."""
    from pyspark.sql.functions import udtf

    @udtf(returnType="key string, ext string, data binary")
    class Untar:
        def eval(self, content: bytes):
            with tarfile.open(fileobj=io.BytesIO(content)) as tar:
                for m in tar:
                    if m.isfile():
                        stem, _, ext = m.name.partition(".")
                        yield stem, ext.lower(), tar.extractfile(m).read()

    spark.udtf.register(name, Untar)
    return Untar


def read_tensors(raw: bytes) -> dict:
    """A safetensors file: metadata JSON and tensors (name, shape, values)."""
    size = struct.unpack("<Q", raw[:8])[0]
    head = json.loads(raw[8 : 8 + size])
    kinds = {"F32": "<f4", "F64": "<f8", "F16": "<f2", "I64": "<i8", "I32": "<i4"}
    out = []
    for name, t in head.items():
        if name != "__metadata__":
            a, b = t["data_offsets"]
            x = np.frombuffer(raw, kinds[t["dtype"]], (b - a) // np.dtype(kinds[t["dtype"]]).itemsize, 8 + size + a)
            out.append({"name": name, "shape": t["shape"], "values": x.astype(np.float32).tolist()})
    return {"metadata": head.get("__metadata__", {}), "tensors": out}


def write_tensors(tensors: dict[str, np.ndarray], metadata: dict[str, str] | None = None, half: bool = True) -> bytes:
    """Half-precision tensors with their configuration in the header."""
    head, data, at = {"__metadata__": metadata or {}}, [], 0
    for name, x in tensors.items():
        raw = np.asarray(x, "<f2" if half else "<f4").tobytes()
        head[name] = {"dtype": "F16" if half else "F32", "shape": list(np.shape(x)), "data_offsets": [at, at + len(raw)]}
        data.append(raw)
        at += len(raw)
    text = json.dumps(head).encode()
    return struct.pack("<Q", len(text)) + text + b"".join(data)


def tensors(df: DataFrame, prefix: str = "") -> DataFrame:
    """path, metadata, name, shape, values of tensor files, those under a name prefix only."""
    read = _binary_map(df.select("path", "content"), read_tensors, "t", "struct<metadata:map<string,string>, tensors:array<struct<name:string, shape:array<int>, values:array<float>>>>")
    return read.select("path", "t.metadata", F.explode("t.tensors").alias("x")).select("path", "metadata", "x.*").filter(F.startswith("name", F.lit(prefix)))


def tensor_ranges(files: DataFrame, prefix: str = "") -> DataFrame:
    """path, name, shape, values of tensor files (path) for names under a prefix: the header is read first, then only
    the byte ranges of wanted tensors."""
    kinds = {"F32": "<f4", "F64": "<f8", "F16": "<f2", "I64": "<i8", "I32": "<i4"}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path in b.column("path").to_pylist():
                system, local = filesystem(path)
                with system.open_input_file(local) as f:
                    size = struct.unpack("<Q", f.read(8))[0]
                    head = json.loads(f.read(size))
                    for name, t in head.items():
                        if name == "__metadata__" or not name.startswith(prefix):
                            continue
                        a, z = t["data_offsets"]
                        f.seek(8 + size + a)
                        x = np.frombuffer(f.read(z - a), kinds[t["dtype"]]).astype(np.float32)
                        yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([name]), pa.array([t["shape"]], pa.list_(pa.int32())), pa.array([x], pa.list_(pa.float32()))], names=["path", "name", "shape", "values"])

    return files.select("path").mapInArrow(run, "path string, name string, shape array<int>, values array<float>")


def wav_bytes(samples: Column, rate: int) -> Column:
    """A 16-bit PCM file of array<array<double>> (channel rows)."""

    @F.pandas_udf("binary")
    def run(x: pd.Series) -> pd.Series:
        return x.map(lambda v: None if v is None else write_wav([list(row) for row in v], rate))

    return run(samples)


def object_listing(spark: SparkSession, root: str, contains: str = "") -> DataFrame:
    """path, length, modified of the objects below a root whose names hold a text: a listing, nothing is opened."""
    df = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    df = df.select("path", "length", F.col("modificationTime").alias("modified"))
    return df.filter(F.contains(F.regexp_extract("path", r"([^/]+)$", 1), F.lit(contains))) if contains else df


def object_urls(names: DataFrame, subsets: list[str], listing: DataFrame, prefix: str, contains: str = "tar") -> DataFrame:
    """url: listed objects (name, line) for every name and subset, folders left out; a subset is not put in front of a
    path that begins with it."""
    rows = names.withColumn("subset", F.explode(F.array(*[F.lit(s) for s in subsets or [""]])))
    rows = rows.join(listing.withColumn("object", T.listing_name(F.col("line"))), "name").filter(F.col("object").isNotNull() & F.contains("object", F.lit(contains)))
    path = F.when((F.col("subset") == "") | F.startswith("object", F.concat("subset", F.lit("/"))), F.col("object")).otherwise(F.concat("subset", F.lit("/"), "object"))
    return rows.select(F.concat(F.lit(prefix.rstrip("/") + "/"), "name", F.lit("/"), path).alias("url")).distinct()


def pcm_frames(df: DataFrame, channels: int) -> DataFrame:
    """(…, content) of interleaved 32-bit floats to samples; a length that is not whole frames is an error."""

    def read(raw: bytes) -> list[list[float]]:
        if len(raw) % (4 * channels):
            raise ValueError(f"{len(raw)} bytes are not whole frames")
        return np.frombuffer(raw, "<f4").reshape(-1, channels).T.tolist()

    return _binary_map(df, read, "samples", "array<array<float>>")


def tokenized(x: Column, length: int) -> Column:
    """struct<ids, mask>: a byte tokenizer's ids, cut or zero-padded to length, with the attention mask."""
    raw = F.slice(F.transform(F.sequence(F.lit(1), F.greatest(F.octet_length(x), F.lit(1))), lambda k: F.conv(F.substring(F.hex(F.encode(x, "utf-8")), 2 * k - 1, F.lit(2)), 16, 10).cast("int")), 1, length)
    ids = F.when(F.coalesce(F.octet_length(x), F.lit(0)) > 0, raw).otherwise(F.array().cast("array<int>"))
    pad = F.lit(length) - F.size(ids)
    return F.struct(F.concat(ids, F.array_repeat(F.lit(0), pad)).alias("ids"), F.concat(F.array_repeat(F.lit(1), F.size(ids)), F.array_repeat(F.lit(0), pad)).alias("mask"))
