"""Sinks: paired records, tar shards, state, error logs, audio and TSV files. All writes can be repeated safely."""

from __future__ import annotations

import io
import tarfile
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.windows import pack
from ..storage import filesystem as _open


def write_pairs(df: DataFrame, path: str, per_batch: int) -> None:
    """Latents and their metadata as Parquet by split, under ids of batch and place in it (``index`` numbers rows)."""
    i = F.col("index")
    named = df.withColumn("id", F.format_string("%06d%04d", F.floor(i / per_batch).cast("long"), (i % per_batch).cast("long")))
    named.write.mode("overwrite").partitionBy("split").parquet(path)


def write_shards(df: DataFrame, path: str, per_shard: int, prefix: str = "") -> DataFrame:
    """(split, key, grp, members map<ext, binary>) to tar shards of at most per_shard records, a group's records kept
    together where they fit: (split, shard, path, n). Shards are named by number, written aside and moved into place, so
    that a repeated task replaces its own file."""
    sizes = df.groupBy("split", "grp").agg(F.count(F.lit(1)).alias("size")).withColumn("order", F.col("grp"))
    shards = pack(sizes, ["split"], "order", "grp", "size", per_shard)
    rows = df.join(shards, ["split", "grp"]).select("split", "shard", "key", "members")
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def write(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, out, tar, count = None, None, None, 0

        def begin() -> tuple:
            split, shard = now
            target = f"{path}/{split}/{prefix}shard-{shard:06d}.tar"
            system, local = _open(target)
            system.create_dir(local.rpartition("/")[0], recursive=True)
            aside = f"{local}.{uuid.uuid4().hex}"
            stream = system.open_output_stream(aside, compression=None)
            return system, target, local, aside, stream

        def close() -> list[tuple]:
            tar.close()
            system, target, local, aside, stream = out
            stream.close()
            system.move(aside, local)
            return [(*now, target, count)]

        for pdf in frames:
            done: list[tuple] = []
            for split, shard, key, members in pdf.itertuples(index=False):
                if (split, shard) != now:
                    if tar:
                        done += close()
                    now, count = (split, shard), 0
                    out = begin()
                    tar = tarfile.open(fileobj=out[-1], mode="w|")  # written as it grows, not held
                for ext, data in sorted(dict(members).items()):
                    info = tarfile.TarInfo(f"{key}.{ext}")
                    info.size = len(data)
                    tar.addfile(info, io.BytesIO(data))
                count += 1
            yield pd.DataFrame(done, columns=["split", "shard", "path", "n"])
        if tar:
            yield pd.DataFrame(close(), columns=["split", "shard", "path", "n"])

    dealt = rows.repartition(n, "split", "shard").sortWithinPartitions("split", "shard", "key")
    return dealt.mapInPandas(write, "split string, shard long, path string, n long")


def save_state(state: DataFrame, path: str) -> None:
    """Every save is a new numbered folder; the newest whole one counts."""
    number = (max((k for k, _ in _states(state.sparkSession, path)), default=-1)) + 1
    state.write.parquet(f"{path}/state={number:08d}")


def _states(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = jpath.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(jpath):
        return []
    found = []
    for s in system.listStatus(jpath):
        name = s.getPath().getName()
        if name.startswith("state=") and system.exists(spark._jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS")):
            found.append((int(name[6:]), s.getPath().toString()))
    return sorted(found)


def load_state(spark: SparkSession, path: str) -> DataFrame:
    """(split, next_idx, completed); empty where nothing whole was saved."""
    found = _states(spark, path)
    if not found:
        return spark.createDataFrame([], "split string, next_idx long, completed array<string>")
    return spark.read.parquet(found[-1][1])


def mark_done(df: DataFrame, path: str, status: str = "done") -> None:
    df.select("key", F.lit(status).alias("status")).write.mode("append").parquet(path)


def dead_letters(df: DataFrame, path: str) -> DataFrame:
    """Rows with an error go to JSON lines; the others are returned."""
    df.filter("error is not null").write.mode("append").json(path)
    return df.filter("error is null").drop("error")


def output_name(base, ext, index, batch):
    """A file name column: numbered only in batches, .wav without an ending."""
    ext = F.when(F.coalesce(ext, F.lit("")) == "", F.lit(".wav")).otherwise(ext)
    return F.when(batch > 1, F.concat(base, F.lit("_"), index.cast("string"), ext)).otherwise(F.concat(base, ext))


def write_tsv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("sep", "\t").option("header", "true").csv(path)


def log_metrics(df: DataFrame, path: str, run: str) -> None:
    """(step, name, value) appended to a table of runs."""
    df.select("step", "name", "value", F.lit(run).alias("run")).write.mode("append").partitionBy("run").parquet(path)


def run_details(spark: SparkSession, path: str, **details: object) -> None:
    import json

    spark.createDataFrame([(json.dumps(details, sort_keys=True, default=str),)], "value string").coalesce(1).write.mode("overwrite").text(path)
