"""Shared helpers: the shared scratch folder, materialisation, raw file access and native hash draws."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ship
from ..storage import filesystem, scratch, shared_root

#: Whitespace of the text contracts: space and the ASCII controls 0x09 to 0x0D.
WS = "\t\n\x0b\x0c\r "
#: Options of a write: the shuffle files of the query are deleted when it ends; bytes of an Arrow batch.
_WRITING = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.execution.arrow.maxBytesPerBatch": "2m"}
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: cuts the lineage in a way that survives lost executors.

    Shuffles of the write are deleted when it is done, and Arrow batches of it are kept small; the options for that hold
    for the write alone.
    """
    ship(df.sparkSession)
    path = scratch(df.sparkSession, name)
    conf = df.sparkSession.conf
    before = {k: conf.get(k, None) for k in _WRITING}
    for k, v in _WRITING.items():
        conf.set(k, v)
    try:
        df.write.parquet(path)
    finally:
        for k, v in before.items():
            conf.set(k, v) if v is not None else conf.unset(k)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._sparkloom_path = path
    return out


def release(*frames: DataFrame) -> None:
    """Delete what materialize() wrote, once nothing reads it any more, and what a frame was marked to rest on."""
    for df in frames:
        release(*getattr(df, "_sparkloom_parts", ()))
        path = getattr(df, "_sparkloom_path", None)
        if path:
            delete(df.sparkSession, path)


def resting_on(df: DataFrame, *parts: DataFrame) -> DataFrame:
    """df, marked: release(df) deletes the materialised parts that it reads."""
    df._sparkloom_parts = parts
    return df


def delete(spark: SparkSession, path: str) -> None:
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jpath, True)


def pieces(batch: pa.RecordBatch, column: str | int = "text", limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """A batch in parts of up to ``limit`` bytes of one column; a longer value is a part of its own.

    Parts are copies, not slices: some of pyarrow's kernels (lower case of ASCII after a cast) misread slices.
    """

    def part(a: int, b: int) -> pa.RecordBatch:
        return batch if (a, b) == (0, batch.num_rows) else batch.take(pa.array(np.arange(a, b)))

    size = pc.binary_length(batch.column(column).cast(pa.large_binary())).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    a, held = 0, 0
    for k, n in enumerate(size.tolist()):
        if held and held + n > limit:
            yield part(a, k)
            a, held = k, 0
        held += n
    if a < batch.num_rows:
        yield part(a, batch.num_rows)


def stretches(text: bytes, limit: int = 1 << 20, at: bytes = b"\n ", hard: bool = False) -> Iterator[bytes]:
    """A text in stretches of about ``limit`` bytes, each but the last ending behind one of the bytes of ``at``; a run
    without any of them stays whole or, with ``hard``, is cut at twice the limit."""
    import re

    if len(text) <= limit:
        yield text
        return
    mark, a = re.compile(b"[" + re.escape(at) + b"]"), 0
    while len(text) - a > limit:
        hit = mark.search(text, a + limit, a + 2 * limit) if hard else mark.search(text, a + limit)
        if hit is None and (not hard or len(text) - a <= 2 * limit):
            break
        end = hit.end() if hit else a + 2 * limit
        yield text[a:end]
        a = end
    yield text[a:]


def ascii_lower(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def draw(*parts: Column | str | int) -> Column:
    """Uniform double in [0, 1) from the md5 of the parts joined by ':' (52 bits); a null part counts as empty."""
    cols = [p if isinstance(p, Column) else F.lit(str(p)) for p in parts]
    text = F.concat_ws(":", *[F.coalesce(c.cast("string"), F.lit("")) for c in cols])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long").cast("double") / F.lit(float(1 << 52))


def free(name: str, taken: list[str]) -> str:
    """name, with underscores behind it while a column has it already."""
    while name.lower() in {c.lower() for c in taken}:
        name += "_"
    return name


def fits(df: DataFrame, rows: int) -> bool:
    """Whether a materialised frame has at most so many rows; decides on an explicit broadcast."""
    return df.limit(rows + 1).count() <= rows


def cleanup(spark: SparkSession) -> None:
    """Delete everything these operators left in the shared folder; results not yet read are lost with it."""
    delete(spark, f"{shared_root(spark)}/sparkloom")
