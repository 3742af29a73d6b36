"""Filters, projections and joins of the record pipeline."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import draws as D
from ..functions import text as T


def duration_ok(seconds: Column, low: float | None = None, high: float | None = None) -> Column:
    """Within inclusive bounds; unknown passes."""
    ok = F.lit(True)
    if low is not None:
        ok = ok & (seconds >= low)
    if high is not None:
        ok = ok & (seconds <= high)
    return seconds.isNull() | ok


def record_ok(has_json: Column, has_audio: Column, prompt: Column, silent: Column, reject: Column, encoded: Column, require_prompt: bool = True) -> Column:
    """The stream's selection; silence is not looked at for encoded records."""
    ok = has_json & has_audio & ~F.coalesce(reject, F.lit(False)) & (encoded | ~silent)
    return ok & T.valid_prompt(prompt) if require_prompt else ok


def apply_custom(df: DataFrame, fn: Column, payload: str) -> DataFrame:
    """A user function's struct<reject, replacement, extra> taken into account: rejected rows drop, replacements win."""
    out = df.withColumn("__u", fn)
    return out.filter(~F.coalesce(F.col("__u.reject"), F.lit(False))).withColumn(payload, F.coalesce(F.col("__u.replacement"), F.col(payload))).withColumn("extra", F.col("__u.extra")).drop("__u")


def on_reject(df: DataFrame, key: str, rejected: Column, how: str = "drop", seed: int = 0) -> DataFrame:
    """'drop' rejected rows, or 'resample' them from the others."""
    if how == "drop":
        return df.filter(~rejected)
    if how == "resample":
        return D.replace_rejected(df, key, rejected, seed)
    raise ValueError(f"on_reject must be drop or resample, not {how}")


def row_shard(df: DataFrame, index: str, n: int, k: int, start: int = 0, limit: int | None = None) -> DataFrame:
    """Rows of a shard by index modulo n; the first ``limit`` by index."""
    out = df.filter((F.col(index) >= start) & (F.col(index) % n == k))
    return out.orderBy(index).limit(limit) if limit is not None else out


def clean_row(df: DataFrame, drop: list[str]) -> Column:
    """A JSON object of a row: columns dropped, NaN to null, nulls kept."""
    cols = [F.nanvl(F.col(c), F.lit(None).cast(t)).alias(c) if t in ("double", "float") else F.col(c) for c, t in df.dtypes if c not in drop]
    return F.to_json(F.struct(*cols), {"ignoreNullFields": "false"})


def replace_if_equal(df: DataFrame, column: str, old: object, new: object) -> DataFrame:
    return df.withColumn(column, F.when(F.col(column) == F.lit(old), F.lit(new)).otherwise(F.col(column)))


def row_context(df: DataFrame, uri: str, chunk_seconds: float) -> DataFrame:
    """df with seconds: duration_sec, else duration_ms / 1000, else 0, at least a chunk; a missing URI is an error."""
    s = F.coalesce(F.nanvl("duration_sec", F.lit(None).cast("double")), F.nanvl("duration_ms", F.lit(None).cast("double")) / 1000, F.lit(0.0))
    checked = F.when(F.col(uri).isNull(), F.raise_error(F.lit("a row has no URI")).cast("string")).otherwise(F.col(uri))
    return df.withColumns({uri: checked, "seconds": F.greatest(s, F.lit(float(chunk_seconds)))})


def base_conditioning(one_line: Column, dense: Column, vivid: Column, bpm: Column) -> Column:
    """struct<prompt, tempo>: the first caption that is not blank."""
    given = lambda c: F.nullif(T.strip(c), F.lit(""))
    return F.struct(F.coalesce(given(one_line), given(dense), given(vivid)).alias("prompt"), T.tempo(bpm).alias("tempo"))


def chunk_metadata(df: DataFrame) -> DataFrame:
    """Start, end and position of chunks: seconds_start, seconds_total, chunk_idx, num_chunks and chunk_seconds given."""
    total = F.greatest("seconds_total", F.lit(1e-6))
    t0 = F.col("seconds_start") / total
    t1 = F.least(F.lit(1.0), (F.col("seconds_start") + F.col("chunk_seconds")) / total)
    return df.withColumns({"timestamps": F.array(t0, t1), "normalized_track_position": t0})


def caption_condition(df: DataFrame, key: str, seed: str = "0") -> DataFrame:
    """df with bucket, policy, prompt, tempo: seeded choice of the caption and how its heading and tempo are used.

    Columns: dense_caption, vivid_caption, one_line_caption, genre, subgenres (comma list), bpm, bpm_valid.
    """
    bucket = D.choice(D.uniform(key, f"{seed}.bucket"), D.CAPTION_CHANCES)
    policy = D.choice(D.uniform(key, f"{seed}.policy"), D.POLICY_CHANCES)
    out = df.withColumns({"bucket": bucket, "policy": policy})
    prose = T.strip_heading(F.col("dense_caption"))
    prefix = T.genre_prefix(F.col("genre"), T.subgenres(F.col("subgenres")))
    dense = F.when(F.col("policy") == "keep", F.col("dense_caption")).when(F.col("policy") == "omit", prose).otherwise(F.when(prefix != "", T.strip(F.concat(prefix, F.lit(" "), prose))).otherwise(prose))
    body = F.when(F.col("bucket") == "dense", dense).when(F.col("bucket") == "vivid", F.col("vivid_caption")).otherwise(F.col("one_line_caption"))
    bpm = F.when(T.truthy(F.col("bpm_valid").cast("string")), T.tempo(F.col("bpm")))
    out = out.withColumn("prompt", T.tempo_text(F.col("bucket"), bpm, body))
    return out.withColumn("tempo", F.when(D.chance(key, D.TEMPO_CHANCE, f"{seed}.tempo"), bpm))


def sidecar(df: DataFrame, side: DataFrame, on: list[str], required: bool = True) -> DataFrame:
    """Rows with their sidecar's columns; without one they go (required) or keep nulls."""
    return df.join(side, on, "inner" if required else "left")


def group_members(df: DataFrame, key: str, ext: str, value: str) -> DataFrame:
    """key, members: files of one key as a map by extension (the last path wins)."""
    return df.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct(ext, value))).alias("members"))


#: Roots that are looked up in the row: a literal of about 100 bytes each.
FEW_ROOTS = 200


def root_match(df: DataFrame, path: str, roots: DataFrame, first: bool = True) -> DataFrame:
    """df with the columns of the roots (root, priority, ...) that are folders of its path.

    With ``first`` only the root of the least priority (then name) is kept, and rows without one keep nulls. Up to
    FEW_ROOTS roots are looked up in a map, a row at a time; more are joined on a path's own folder prefixes, so no pair
    is compared that does not match.
    """
    parts = F.split(path, "/")
    prefixes = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda k: F.array_join(F.slice(parts, 1, k), "/"))
    if not first:
        return df.withColumn("root", F.explode(prefixes)).join(roots, "root")
    extra = [c for c in roots.columns if c != "root"]
    few = roots.select("root", *extra).limit(FEW_ROOTS + 1).collect()
    if few and len(few) <= FEW_ROOTS:
        kinds = roots.select(F.struct("root", *extra).alias("s")).schema["s"].dataType
        order = sorted({r["root"]: r for r in sorted(few, key=lambda r: (r["priority"], r["root"]), reverse=True)}.values(), key=lambda r: (r["priority"], r["root"]))
        known = F.array(*[F.struct(*[F.lit(r[f.name]).cast(f.dataType).alias(f.name) for f in kinds.fields]) for r in order])
        own = F.filter(known, lambda r: F.array_contains(prefixes, r["root"]))  # in the order of priority
        return df.withColumn("__r", F.get(own, F.lit(0))).select(*df.columns, "__r.root", *[f"__r.{c}" for c in extra])
    rows = df
    met = df.select(F.col(path).alias("__path")).distinct().withColumn("root", F.explode(F.transform(F.sequence(F.lit(1), F.size(F.split("__path", "/"))), lambda k: F.array_join(F.slice(F.split("__path", "/"), 1, k), "/")))).join(roots, "root")
    best = met.groupBy("__path").agg(F.min_by(F.struct("root", *extra), F.struct("priority", "root")).alias("__r"))
    return rows.join(best, rows[path] == best["__path"], "left").select(*df.columns, "__r.root", *[f"__r.{c}" for c in extra])


def resume(df: DataFrame, done: DataFrame, key: str, retry_failed: bool = False) -> DataFrame:
    """Rows not done yet; done: (key, status)."""
    return df.join(done.filter(F.col("status") == "done") if retry_failed else done, key, "left_anti")


def barrier(df: DataFrame, key: str, expected: Column) -> DataFrame:
    """key, n: keys all of whose chunks are there."""
    return df.groupBy(key).agg(F.count_distinct("chunk_idx").alias("n"), F.max(expected).alias("expected")).filter("n = expected").select(key, "n")


def merge_state(a: DataFrame, b: DataFrame) -> DataFrame:
    """(split, next_idx, completed): key-wise maximum and sorted union of two states."""
    j = a.alias("a").join(b.alias("b"), "split", "full_outer")
    both = F.array_sort(F.array_union(F.coalesce("a.completed", F.array().cast("array<string>")), F.coalesce("b.completed", F.array().cast("array<string>"))))
    return j.select("split", F.greatest("a.next_idx", "b.next_idx").alias("next_idx"), both.alias("completed"))


def lookup(bag: Column, key: str, default: str | None = None, required: bool = False) -> Column:
    """A map's value by key or, failing that, by its default key; null or an error where neither is there."""
    v = F.try_element_at(bag, F.lit(key))
    v = F.coalesce(v, F.try_element_at(bag, F.lit(default))) if default else v
    return F.coalesce(v, F.raise_error(F.lit(f"no value for {key}")).cast("string")) if required else v


def match_tensors(model: DataFrame, saved: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(loaded, missed): tensors that agree in name and shape, and the model's others."""
    hit = saved.select("name", "shape", F.col("values").alias("loaded"))
    return model.join(hit, ["name", "shape"]), model.join(hit, ["name", "shape"], "left_anti")


def remap_names(model: DataFrame, saved: DataFrame) -> DataFrame:
    """(name, source): saved tensors under the model's names, as they are or with one dotted part left out."""
    parts = F.split("name", r"\.")
    short = F.transform(F.sequence(F.lit(0), F.size(parts) - 1), lambda k: F.array_join(F.filter(parts, lambda p, i: i != k), "."))
    named = saved.select(F.col("name").alias("source"), F.posexplode(F.concat(F.array("name"), short)).alias("rank", "name"))
    met = named.join(model.select("name"), "name")
    return met.groupBy("name").agg(F.min_by("source", F.struct("rank", "source")).alias("source"))


def reconcile(online: DataFrame, averaged: DataFrame) -> DataFrame:
    """(name, values): averaged tensors for the online names, seeded from the online ones; others are dropped."""
    return online.select("name", F.col("values").alias("o")).join(averaged.select("name", F.col("values").alias("e")), "name", "left").select("name", F.coalesce("e", "o").alias("values"))


def missing_remote(local: DataFrame, remote: DataFrame) -> DataFrame:
    """Files to copy: no remote file of that name and size."""
    return local.join(remote.select("name", "size"), ["name", "size"], "left_anti")


def keep_newest(df: DataFrame, keys: list[str], order: list[Column], n: int) -> DataFrame:
    """The first n rows in order, of each key or, without keys, of all; with their rank."""
    if not keys:  # n rows: sorted a partition at a time, then merged
        return df.orderBy(*order).limit(n).withColumn("rank", F.row_number().over(Window.orderBy(*order)))
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col("rank") <= n)


def version_step(name: Column) -> Column:
    """The step number of a checkpoint's name."""
    return F.regexp_extract(name, r"step=(\d+)", 1).try_cast("long")


def first_existing(candidates: DataFrame, key: str, existing: DataFrame) -> DataFrame:
    """key, path: the candidate of the least priority that exists."""
    return candidates.join(existing, "path", "left_semi").groupBy(key).agg(F.min_by("path", F.struct("priority", "path")).alias("path"))


def branches(df: DataFrame) -> DataFrame:
    """Every row for 'cond' and 'uncond'."""
    return df.withColumn("branch", F.explode(F.array(F.lit("cond"), F.lit("uncond"))))


def broadcast_to_batch(prompts: list, durations: list | float) -> list[tuple]:
    """Pairs of prompts and durations; one duration serves all, else the lengths must agree."""
    if not isinstance(durations, (list, tuple)):
        durations = [durations] * len(prompts)
    if len(durations) != len(prompts):
        raise ValueError(f"{len(prompts)} prompts but {len(durations)} durations")
    return list(zip(prompts, durations, strict=True))
