"""Conditioning and generation planning: assembly by role, latent lengths, feature splits, request preparation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import arrays as A


def assemble(bag: Column, cross: list[str] = (), glob: list[str] = (), local: list[str] = (), prepend: list[str] = (), negative: bool = False) -> Column:
    """struct of conditioning by role, from a map of name to struct<emb, mask>.

    cross and prepend: embeddings and masks one after the other; global: embeddings one after the other; local: a struct
    by name. With ``negative`` a name's 'negative_' entry is taken where there is one.
    """

    def get(name: str) -> Column:
        own = F.try_element_at(bag, F.lit(name))
        return F.coalesce(F.try_element_at(bag, F.lit(f"negative_{name}")), own) if negative else own

    empty = F.array().cast("array<double>")
    joined = lambda names, part: F.flatten(F.array(*[F.coalesce(get(n)[part].cast("array<double>"), empty) for n in names])) if names else empty
    parts = [joined(cross, "emb").alias("cross"), joined(cross, "mask").alias("cross_mask"), joined(glob, "emb").alias("global"), joined(prepend, "emb").alias("prepend"), joined(prepend, "mask").alias("prepend_mask")]
    if local:
        parts.append(F.struct(*[get(n)["emb"].alias(n) for n in local]).alias("local"))
    return F.struct(*parts)


def latent_lengths(df: DataFrame, batch: str, seconds: str, rate: int, ratio: int) -> DataFrame:
    """df with latent: lengths of a batch, null for the whole batch where one row has no seconds."""
    known = F.every(F.col(seconds).isNotNull()).over(Window.partitionBy(batch))
    return df.withColumn("latent", F.when(known, A.latent_length(F.col(seconds), rate, ratio)))


def longest(df: DataFrame, batch: str, seconds: str) -> DataFrame:
    return df.groupBy(batch).agg(F.coalesce(F.max(seconds), F.lit(0.0)).alias("max_seconds"))


def feature_split(df: DataFrame, keys: list[str], value: Column, valid: Column) -> DataFrame:
    """df with dc, the mean of valid values of a key, and hf, what is left of each valid value (0 elsewhere)."""
    dc = F.coalesce(F.avg(F.when(valid, value)).over(Window.partitionBy(*keys)), F.lit(0.0))
    return df.withColumn("dc", dc).withColumn("hf", F.when(valid, value - F.col("dc")).otherwise(0.0))


def embedding_table(df: DataFrame, key: str, x: str, label: str) -> DataFrame:
    """One row a frame: key, frame, label and dim_0, dim_1, ... of array<array> (dimension by frame)."""
    d = df.select(F.size(x).alias("d")).agg(F.max("d")).first()[0] or 0
    rows = df.select(key, F.col(label).alias("label"), x, F.explode(A.positions(F.size(F.get(F.col(x), F.lit(0))))).alias("frame"))
    return rows.select(key, "frame", "label", *[F.get(F.get(F.col(x), F.lit(i)), F.col("frame")).alias(f"dim_{i}") for i in range(d)])


def soft_norm(x: Column, scale: Column, bias: Column, running_std: Column) -> Column:
    """(x scale + bias) / running deviation, by channel."""
    return F.transform(F.arrays_zip(x.alias("x"), scale.alias("s"), bias.alias("b")), lambda v: (v["x"] * v["s"] + v["b"]) / running_std)


def size_plan(seconds: Column, rate: int, step: int, most: int) -> Column:
    """Samples of a request: whole seconds' worth, rounded up to the model's step, at most ``most``."""
    return F.least(A.align_up(F.floor(seconds * rate), step), F.lit(most)).cast("int")


def inpaint_regions(starts: Column, ends: Column, rate: int, mode: str = "truncate", ratio: int = 1) -> Column:
    """array<struct<s, e>> in samples (truncate) or, rounded, in latent frames (round)."""
    pairs = F.arrays_zip(starts.alias("a"), ends.alias("b"))
    if mode == "truncate":
        return F.transform(pairs, lambda p: F.struct(F.floor(p["a"] * rate).cast("int").alias("s"), F.floor(p["b"] * rate).cast("int").alias("e")))
    if mode == "round":
        return F.transform(pairs, lambda p: F.struct(F.rint(p["a"] * rate / ratio).cast("int").alias("s"), F.rint(p["b"] * rate / ratio).cast("int").alias("e")))
    raise ValueError(f"mode must be truncate or round, not {mode}")


def requests(df: DataFrame, rate: int = 44_100, ratio: int = 4_096, most: int = 44_100 * 380) -> DataFrame:
    """One row a prompt of requests (id, prompt array, negative_prompt array, duration array, inpaint_starts,
    inpaint_ends): batch place, prompts, seconds_total, sizes and kept share of the latent mask.

    A single duration serves all prompts; other lengths must agree."""
    n = F.size("prompt")
    fits = (F.size("duration") == n) | (F.size("duration") == 1)
    rows = df.withColumn("prompt", F.when(fits, F.col("prompt")).otherwise(F.raise_error(F.lit("prompts and durations differ in number")).cast("array<string>")))
    rows = rows.select("*", F.posexplode("prompt").alias("place", "text"))
    seconds = F.coalesce(F.get("duration", F.col("place")), F.get("duration", F.lit(0)))
    rows = rows.withColumn("seconds_total", seconds).withColumn("samples", size_plan(F.max("seconds_total").over(Window.partitionBy("id")), rate, ratio, most))
    empty = F.array().cast("array<double>")
    regions = inpaint_regions(F.coalesce("inpaint_starts", empty), F.coalesce("inpaint_ends", empty), rate, "round", ratio)
    mask = A.interval_mask(F.ceil(F.col("samples") / ratio).cast("int"), regions, A.latent_length(F.col("seconds_total"), rate, ratio))
    rows = rows.withColumns({"latents": F.ceil(F.col("samples") / ratio).cast("int"), "mask": mask})
    return rows.select("id", "place", F.col("text").alias("prompt"), F.get("negative_prompt", F.col("place")).alias("negative_prompt"), "seconds_total", "samples", "latents", "mask")


def mix_init(init: Column, noise: Column, sigma: float) -> Column:
    """Start of a variation: init and noise by the first noise level."""
    return F.zip_with(init, noise, lambda a, z: a * (1 - sigma) + z * sigma)


def paste_back(x: Column, original: Column, mask: Column) -> Column:
    """Kept places come from the original."""
    return F.transform(F.arrays_zip(x.alias("x"), original.alias("o"), mask.alias("m")), lambda v: F.when(v["m"] > 0, v["o"]).otherwise(v["x"]))


def in_interval(sigma: Column, low: float, high: float) -> Column:
    """Whether guidance or an adapter is on at a noise level."""
    return sigma.between(low, high)


def profile_range(df: DataFrame, length: Column, low: int, high: int) -> tuple[DataFrame, DataFrame]:
    """(kept, skipped): rows whose length an engine's profile covers, both ends included, and the others; a null length
    is skipped."""
    ok = F.coalesce(length.between(low, high), F.lit(False))
    return df.filter(ok), df.filter(~ok)
