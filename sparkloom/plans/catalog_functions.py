"""Registered queries of column functions: text, metadata, signals, schedules, draws and samplers."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from ..functions import arrays as A
from ..functions import draws as D
from ..functions import schedules as S
from ..functions import text as T
from ..operators import conditioning as K
from .registry import VEC, query
from .registry import rounded as _r
from .registry import table as _t
from .registry import uniform_sql as _u
from .registry import weighed as _w
from .registry import weighed_sql as _ws

_SAFE = "substr(regexp_replace(coalesce(nullif(trim({0}), ''), 'item'), '[^A-Za-z0-9_.-]+', '_', 'g'), 1, 200)"


@query(f"""
WITH p AS (SELECT page_id, url, CASE page_id % 3 WHEN 0 THEN NULL WHEN 1 THEN '  ' ELSE ' id/' || page_id || ' x ' END AS given,
                  regexp_extract(url, '([^/]+?)(\\.[^./]*)?$', 1) AS stem FROM pages)
SELECT page_id, CASE WHEN trim(coalesce(given, '')) <> '' THEN {_SAFE.format('given')} ELSE {_SAFE.format('stem')} END AS base,
       regexp_replace(stem || '_' || page_id, '_[0-9]+$', '') AS row_base FROM p""")
def output_names(spark, d):
    """Output base of an id or a URI, and the record a chunk's name belongs to."""
    k = F.col("page_id")
    given = F.when(k % 3 == 1, "  ").when(k % 3 == 2, F.concat(F.lit(" id/"), k.cast("string"), F.lit(" x ")))
    made = F.concat_ws("_", T.stem(F.col("url")), k.cast("string"))
    return _t(spark, d, "pages").select("page_id", T.output_base(given, F.col("url")).alias("base"), T.row_base(made).alias("row_base"))


@query("""
WITH c AS (SELECT conv_id, turn, role, regexp_replace(text, '\\s+', ' ', 'g') AS x FROM conversations),
t AS (SELECT *, trim('idea</think> - ' || x) AS raw FROM c)
SELECT conv_id, turn, array_to_string(list_transform(string_split(trim(x), '. '), lambda p: upper(substr(p, 1, 1)) || substr(p, 2)), '. ') AS tidy,
       trim(x) || '|' || role AS examples, turn * 7 AS seconds, substr(regexp_replace(x, '[\\\\/:*?"<>|]', '-', 'g'), 1, 150) AS file_name,
       substr(regexp_replace(regexp_replace(lower(x), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g'), 1, 48) AS slug FROM t""")
def prompt_processing(spark, d):
    """Generated prompts made tidy, listed examples, stated lengths, file names and slugs."""
    c = _t(spark, d, "conversations").withColumn("x", F.regexp_replace("text", r"\s+", " "))
    listed = F.concat(F.lit("intro\n- "), F.col("x"), F.lit("\nskipped\n- "), F.col("role"))
    stated = F.concat(F.col("role"), F.lit(". Length: "), (F.col("turn") * 7).cast("string"), F.lit(" seconds"))
    tidy = T.tidy_prompt(F.concat(F.lit("idea</think> - "), F.col("x")))
    return c.select("conv_id", "turn", tidy.alias("tidy"), F.array_join(T.examples(listed), "|").alias("examples"), T.stated_seconds(stated).cast("long").alias("seconds"), T.condense(F.col("x")).alias("file_name"), T.slug(F.col("x")).alias("slug"))


@query("""
SELECT doc_id, CASE WHEN n_chars >= 3600 THEN format('{}h{:02d}m{:02d}s', n_chars // 3600, n_chars % 3600 // 60, n_chars % 60)
                    WHEN n_chars >= 60 THEN format('{}m{:02d}s', n_chars // 60, n_chars % 60) ELSE format('{}s', n_chars) END AS length,
       CASE WHEN doc_id % 4 <> 0 THEN source || '/' || lang || '.tar' END AS object, n_chars::DOUBLE AS factor,
       CASE doc_id % 4 WHEN 0 THEN 'music' WHEN 1 THEN 'instrument' WHEN 2 THEN 'sfx' ELSE 'unknown' END AS kind,
       strftime(make_timestamp((doc_id * 86399) * 1000000), '%Y-%m-%d') AS day, strftime(make_timestamp((doc_id * 86399) * 1000000), '%Y-%m-%dT%H:%M:%SZ') AS stamp FROM documents""")
def stated_values(spark, d):
    """Durations, listing lines, numbers in coloured logs, routing by stated type, dates."""
    n, k = F.col("n_chars"), F.col("doc_id")
    line = F.concat(F.lit("2024-01-02 03:04:05   "), n.cast("string"), F.lit(" "), F.col("source"), F.lit("/"), F.when(k % 4 == 0, F.lit("")).otherwise(F.concat(F.col("lang"), F.lit(".tar"))))
    log = F.concat(F.lit("step 3 \x1b[32mRTF = "), n.cast("string"), F.lit("\x1b[0m x"))
    said = F.element_at(F.array(*[F.lit(x) for x in ("TrackType: Music, VocalType: Instrumental", "TrackType: Instrument", "tracktype: sfx", "TrackType: Music")]), (k % 4 + 1).cast("int"))
    return _t(spark, d, "documents").select(
        "doc_id", T.duration(n).alias("length"), T.listing_name(line).alias("object"), T.named_number(log, "rtf").alias("factor"), T.track_kind(said).alias("kind"),
        T.iso_date(k * 86_399).alias("day"), T.utc_stamp(k * 86_399).alias("stamp"),
    )


@query(f"""
WITH c AS (SELECT conv_id, turn, role, text || CASE WHEN turn % 3 = 0 THEN '. Length: 30 seconds' ELSE '. Length: 9 seconds. ' END AS x FROM conversations)
SELECT conv_id, turn, regexp_matches(x, '[\\[\\]*#]') OR regexp_matches(x, '(?i){T.VOCAL}') OR NOT regexp_matches(x, '\\. Length: \\d+ seconds\\.?\\s*$')
       OR len(regexp_extract_all(x, '\\S+')) > 45 AS artifacts FROM c""")
def artifact_flags(spark, d):
    said = F.concat("text", F.when(F.col("turn") % 3 == 0, ". Length: 30 seconds").otherwise(". Length: 9 seconds. "))
    return _t(spark, d, "conversations").select("conv_id", "turn", T.has_artifacts(said).alias("artifacts"))


@query("""
WITH d AS (SELECT doc_id, lang, source, [' Yes ', 'no', NULL, 'TRUE', '', 'nan', ' None', '1', 't', '0'][doc_id % 10 + 1] AS v FROM documents)
SELECT doc_id, v IS NOT NULL AND trim(v) <> '' AND lang IS NOT NULL AS all_valid, doc_id % 10 <> 2 OR lang = 'en' AS some_present,
       coalesce(lower(trim(v)) IN ('1', 'true', 't', 'yes', 'y'), false) AS truthy, v IS NULL OR lower(trim(v)) IN ('', 'none', 'null', 'nan') AS no_condition FROM d""")
def metadata_flags(spark, d):
    """All fields valid, some key present, true-like words, values that stand for nothing."""
    words = F.array(*[F.lit(x) for x in (" Yes ", "no", None, "TRUE", "", "nan", " None", "1", "t", "0")])
    df = _t(spark, d, "documents").withColumn("v", F.get(words, (F.col("doc_id") % 10).cast("int")))
    bag = F.map_filter(F.create_map(F.lit("caption"), F.col("v"), F.lit("english"), F.when(F.col("lang") == "en", F.lit("x"))), lambda k, v: v.isNotNull())
    return df.select("doc_id", T.all_valid([F.col("v"), F.col("lang")]).alias("all_valid"), T.any_present(bag, ["caption", "english"]).alias("some_present"), T.truthy(F.col("v")).alias("truthy"), T.null_condition(F.col("v")).alias("no_condition"))


@query("""
WITH p AS (SELECT p_partkey, 'Blocks.' || (p_size % 12) || '.' || ['attn', 'ff'][p_partkey % 2 + 1] || '.' || ['lora_A', 'weight', 'bias'][p_partkey % 3 + 1] AS name FROM part)
SELECT p_partkey, name, NOT (contains(lower(name), 'blocks.1.') OR contains(lower(name), 'ff.bias')) AS is_on, starts_with(string_split(name, '.')[-1], 'lora_') AS adapter,
       string_split(name, '.')[-1] = 'bias' AS bias, string_split(name, '.')[-2] AS part FROM p""")
def tensor_names(spark, d):
    """Layer toggles and predicates on dotted names."""
    pick = lambda xs, k: F.get(F.array(*[F.lit(x) for x in xs]), k.cast("int"))
    k = F.col("p_partkey")
    name = F.concat_ws(".", F.lit("Blocks"), (F.col("p_size") % 12).cast("string"), pick(["attn", "ff"], k % 2), pick(["lora_A", "weight", "bias"], k % 3))
    df = _t(spark, d, "part").select("p_partkey", name.alias("name"))
    n = F.col("name")
    return df.select("p_partkey", "name", T.layer_toggle(n, " Blocks.1., ff.bias,").alias("is_on"), T.is_adapter(n).alias("adapter"), T.is_bias(n).alias("bias"), T.name_part(n, 2).alias("part"))


@query(f"""
WITH e AS (SELECT vec_id, label, {VEC} AS x FROM embeddings),
u AS (SELECT vec_id, label, x, list_transform(x, lambda v: v * pow(10.0, (vec_id % 25 - 4) / 20.0)) AS u FROM e),
p AS (SELECT *, list_max(list_transform(u, lambda v: abs(v))) AS p FROM u)
SELECT vec_id, round({_ws('u')} * CASE WHEN p > 0.95 THEN 0.95 / p ELSE 1 END, 5) AS louder, round({_ws('list_transform(x, lambda v: greatest(least(v, 0.1), -0.05))')}, 5) AS clamped,
       round({_ws('list_transform(x, lambda v: (greatest(least(v, 0.2), -0.2) + 0.2) / 0.4)')}, 5) AS scaled, round(CASE WHEN vec_id % 2 = 0 THEN -1 ELSE 1 END * {_ws('x')}, 5) AS flipped,
       {_ws('list_transform(x, lambda v: trunc(greatest(least(v, 1.0), -1.0) * 32767)::INTEGER)')}::DOUBLE AS pcm,
       round(list_sum(list_transform(range(1, 33), lambda i: i * (x[i] + x[i + 32]) / 2)), 5) AS mono, round(list_sum(list_transform(range(1, 65), lambda i: i * CASE WHEN i % 4 = 0 THEN x[i] ELSE 0.25 END)), 5) AS filled FROM p""")
def signal_levels(spark, d):
    """Gain with clipping guard, clamp, scale to [0, 1], phase flip, 16-bit samples, channel mean, learned padding."""
    x, k = F.col("x"), F.col("vec_id")
    e = _t(spark, d, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("x"))
    mask = F.transform(F.sequence(F.lit(1), F.lit(64)), lambda i: (i % 4 == 0).cast("int"))
    mono = F.get(A.to_channels(F.array(F.slice(x, 1, 32), F.slice(x, 33, 32)), 1), F.lit(0))
    return e.select(
        "vec_id", _r(_w(A.gain(x, k % 25 - 4)), "louder", 5), _r(_w(F.transform(x, lambda v: A.clamp(v, -0.05, 0.1))), "clamped", 5), _r(_w(F.transform(x, lambda v: A.min_max(v, -0.2, 0.2))), "scaled", 5),
        _r(_w(A.flip(x, k % 2 == 0)), "flipped", 5), _w(A.pcm16(x)).alias("pcm"), _r(_w(mono), "mono", 5), _r(_w(A.fill_padding(x, mask, "learned", 0.25)), "filled", 5),
    )


@query(f"""
WITH e AS (SELECT vec_id, {VEC} AS x, vec_id % 90 AS n FROM embeddings)
SELECT vec_id, round(list_sum(list_transform(range(1, 129), lambda i: i * x[(i + 1) // 2])), 5) AS repeated, round(list_sum(list_transform(range(1, 81), lambda i: CASE WHEN i > 16 THEN i * x[i - 16] ELSE 0 END)), 5) AS wide,
       round(list_sum(list_transform(range(1, 11), lambda i: i * x[54 + i])), 5) AS narrow, n::INTEGER AS valid, (CASE WHEN n < 64 THEN n ELSE 64 END)::INTEGER AS masked FROM e""")
def frame_alignment(spark, d):
    """Mask upsampling, alignment to the right end, prefix masks."""
    x, n = F.col("x"), (F.col("vec_id") % 90).cast("int")
    e = _t(spark, d, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("x"))
    return e.select("vec_id", _r(_w(A.repeat_each(x, 2)), "repeated", 5), _r(_w(A.align_left(x, 80)), "wide", 5), _r(_w(A.align_left(x, 10)), "narrow", 5), n.alias("valid"), A.total(A.prefix_mask(n, 64)).cast("int").alias("masked"))


@query("""
WITH d AS (SELECT doc_id, n_chars AS n FROM documents WHERE n_chars >= 500),
s AS (SELECT doc_id, n, list_distinct(list_concat(range(0, n - 500 + 1, 375), [n - 500])) AS s FROM d),
r AS (SELECT doc_id, n, unnest(list_sort(s)) AS start, unnest(range(0, len(s))) AS k, len(s) - 1 AS top FROM s)
SELECT doc_id, k::INTEGER AS k, start::INTEGER AS start, (CASE WHEN k = 0 THEN 0 ELSE 62 END)::INTEGER AS lo, (CASE WHEN k = top THEN 500 ELSE 438 END)::INTEGER AS hi FROM r""")
def decode_plan(spark, d):
    """Chunks of one size for a uniform decode, and the part of each that is written."""
    docs = _t(spark, d, "documents").filter("n_chars >= 500")
    plan = docs.select("doc_id", F.posexplode(A.stitch_plan(F.col("n_chars"), 500, 125)).alias("k", "p"))
    return plan.select("doc_id", "k", "p.start", "p.lo", "p.hi")


_F = f"exp({math.log(0.5)!r}::DOUBLE + k * {(math.log(50.0) - math.log(0.5)) / 7!r}::DOUBLE) * {2 * math.pi!r}::DOUBLE"


@query(f"""
WITH d AS (SELECT doc_id, (n_chars % 1000) / 1000.0::DOUBLE AS x FROM documents)
SELECT doc_id, round(list_sum(list_transform(range(0, 8), lambda k: cos(x * {_F}) * (k + 1) + sin(x * {_F}) * (k + 9))), 5) AS fourier FROM d""")
def fourier_features(spark, d):
    x = (F.col("n_chars") % 1000) / 1000
    return _t(spark, d, "documents").select("doc_id", _r(_w(A.fourier(x, 8, 0.5, 50.0)), "fourier", 5))


@query(f"""
WITH e AS (SELECT vec_id, {VEC} AS x, vec_id % 50 AS p FROM embeddings)
SELECT vec_id, round(list_sum(list_transform(range(0, 32), lambda k: (k + 1) * (x[k + 1] * cos(p * pow(10000.0, -k / 32.0)) - x[k + 33] * sin(p * pow(10000.0, -k / 32.0)))
       + (k + 33) * (x[k + 33] * cos(p * pow(10000.0, -k / 32.0)) + x[k + 1] * sin(p * pow(10000.0, -k / 32.0))))), 4) AS turned FROM e""")
def rotary_embedding(spark, d):
    return _t(spark, d, "embeddings").select("vec_id", _r(_w(A.rotary(F.col("embedding").cast("array<double>"), F.col("vec_id") % 50)), "turned", 4))


@query(f"""
SELECT vec_id, round(list_sum(list_transform(range(1, 65), lambda i: i * ({VEC}[i] * (0.5 + i / 64.0) + (i % 3) / 10.0) / 1.5)), 5) AS normed FROM embeddings""")
def soft_normalisation(spark, d):
    """Affine by channel over a running deviation."""
    scale = F.transform(F.sequence(F.lit(1), F.lit(64)), lambda i: 0.5 + i / 64.0)
    bias = F.transform(F.sequence(F.lit(1), F.lit(64)), lambda i: (i % 3) / 10.0)
    return _t(spark, d, "embeddings").select("vec_id", _r(_w(K.soft_norm(F.col("embedding").cast("array<double>"), scale, bias, F.lit(1.5))), "normed", 5))


@query(f"""
WITH e AS (SELECT vec_id, {_u('t', 'vec_id')} AS u, {_u('t.1', 'vec_id')} AS u1, {_u('t.2', 'vec_id')} AS u2, {_u('exp', 'vec_id')} AS w, {_u('drop', 'vec_id')} AS b FROM embeddings),
z AS (SELECT *, sqrt(-2.0 * ln(1 - u1)) * cos({2 * math.pi!r}::DOUBLE * u2) AS z FROM e)
SELECT vec_id, round(u, 9) AS uniform, round(1 / (1 + exp(-z)), 6) AS logit_normal, round(greatest(least(1 / (1 + exp(z * 2.0 - 1.2)), 0.9999), 1e-4), 6) AS log_snr,
       round(greatest(least(1 / (1 + exp(u * 11.0 - 6.0)), 0.9999), 1e-4), 6) AS log_snr_uniform, round(-ln(1 - w) * 3.0, 6) AS silence, round(z, 6) AS noise, b < 0.1 AS dropped,
       list_sum(list_transform(range(0, 20), lambda k: ((vec_id >> k) & 1) / pow(2.0, k + 1))) AS low_discrepancy FROM z""")
def timestep_draws(spark, d):
    """Training timesteps of every kind that has a closed form, exponential lengths, Gaussian noise, dropout."""
    k = F.col("vec_id")
    return _t(spark, d, "embeddings").select(
        "vec_id", _r(D.timestep(k, "uniform"), "uniform", 9), _r(D.timestep(k, "logit_normal"), "logit_normal"), _r(D.timestep(k, "log_snr"), "log_snr"), _r(D.timestep(k, "log_snr_uniform"), "log_snr_uniform"),
        _r(D.exponential(k, 3.0), "silence"), _r(D.normal(k, "t"), "noise"), D.chance(k, 0.1, "drop").alias("dropped"), D.radical_inverse(k, 20).alias("low_discrepancy"),
    )


@query("""
SELECT doc_id, k::INTEGER AS k, round(CASE WHEN k = 0 THEN 0.9 WHEN k = 6 THEN 0.0 ELSE 1 / (1 + exp(2.0 - 0.9 * (1 - k / 6.0) * 8.2)) END, 6) AS t,
       round((1 - pow(0.9, k + 1)) * greatest(0.05, 0.5 * pow(1 + k / 2.0, -0.75)), 9) AS rate FROM documents, range(0, 7) r(k)""")
def default_schedule(spark, d):
    """The schedule where no shift is named, from a noise level below 1, and a warm inverse learning rate."""
    docs = _t(spark, d, "documents").select("doc_id", F.posexplode(S.schedule(6, F.col("n_chars"), S.shift(), sigma_max=0.9)).alias("k", "t"))
    return docs.select("doc_id", "k", _r("t", "t"), _r(S.warm_inverse(F.col("k"), 2.0, 0.75, 0.9, 0.05, 0.5), "rate", 9))


@query(f"SELECT doc_id, n_chars / 3000.0 BETWEEN 0.2 AND 0.8 AS guided, round(CASE WHEN n_chars >= 3000 THEN 0.0 ELSE ln((1 - n_chars / 3000.0) / greatest(n_chars / 3000.0, 1e-9)) END, 6) AS snr FROM documents")
def interval_guidance(spark, d):
    """Whether guidance is on at a noise level; the level's log-SNR."""
    s = F.col("n_chars") / 3000
    return _t(spark, d, "documents").select("doc_id", K.in_interval(s, 0.2, 0.8).alias("guided"), _r(F.when(s >= 1, 0.0).otherwise(F.ln((1 - s) / F.greatest(s, F.lit(1e-9)))), "snr"))


_T = "CASE WHEN k = 0 THEN 1.0 WHEN k = 8 THEN 0.0 ELSE 1 / (1 + exp(2.0 - (1 - k / 8.0) * 8.2)) END"
_STEPS = f"t AS (SELECT k, ({_T})::DOUBLE AS t FROM range(0, 9) r(k)), s AS (SELECT a.k, a.t AS a, b.t AS b, (a.t + b.t) / 2 AS m, b.t - a.t AS h FROM t a JOIN t b ON b.k = a.k + 1)"


def _sampled(spark, d, how):
    from ..operators.samplers import sample

    e = _t(spark, d, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("x"))
    return sample(e.withColumn("t", S.schedule(8, F.lit(2000), S.log_snr)), how=how).select("id", _r(_w(F.col("x")), "x", 5))


@query(f"""
WITH {_STEPS}, f AS (SELECT exp(sum(ln(1 + h / (1 + a)))) AS f FROM s)
SELECT vec_id AS id, round({_ws(VEC)} * f, 5) AS x FROM embeddings, f""")
def euler_sampler(spark, d):
    """Under the model x / (1 + t) every step is a factor."""
    return _sampled(spark, d, "euler")


@query(f"""
WITH {_STEPS}, k1 AS (SELECT *, 1 / (1 + a) AS k1 FROM s), k2 AS (SELECT *, (1 + h / 2 * k1) / (1 + m) AS k2 FROM k1), k3 AS (SELECT *, (1 + h / 2 * k2) / (1 + m) AS k3 FROM k2),
k4 AS (SELECT *, (1 + h * k3) / (1 + greatest(b, 1e-5)) AS k4 FROM k3), f AS (SELECT exp(sum(ln(1 + h / 6 * (k1 + 2 * (k2 + k3) + k4)))) AS f FROM k4)
SELECT vec_id AS id, round({_ws(VEC)} * f, 5) AS x FROM embeddings, f""")
def rk4_sampler(spark, d):
    return _sampled(spark, d, "rk4")


_LEN = "ceil(floor((vec_id % 30) / 10.0 * 16) / 1.0)"


@query(f"""
WITH e AS (SELECT vec_id, {VEC} AS x, CASE WHEN vec_id % 4 = 0 THEN 64 ELSE {_LEN} END AS n, CASE WHEN vec_id % 4 = 0 THEN 64 ELSE least({_LEN} + 8, 64) END AS valid FROM embeddings),
t AS (SELECT vec_id, k, CASE WHEN vec_id % 3 = 0 THEN 0.8 ELSE 1.0 END AS m, 2.0 - (-6.2 - log2(greatest(n, 1) / 2000.0)) AS span FROM e, range(0, 9) r(k)),
u AS (SELECT vec_id, k, CASE WHEN k = 0 THEN m WHEN k = 8 THEN 0.0 ELSE CASE WHEN m * (1 - k / 8.0) >= 1 THEN 1.0 ELSE 1 / (1 + exp(2.0 - m * (1 - k / 8.0) * span)) END END AS t FROM t),
f AS (SELECT a.vec_id, exp(sum(ln(1 + (b.t - a.t) / (1 + a.t)))) AS f FROM u a JOIN u b ON b.vec_id = a.vec_id AND b.k = a.k + 1 GROUP BY a.vec_id)
SELECT vec_id AS id, valid::INTEGER AS valid, round(f * list_sum(list_transform(range(1, 65), lambda i: CASE WHEN i <= valid THEN i * CASE WHEN vec_id % 3 = 0 THEN 0.2 * x[65 - i] + 0.8 * x[i] ELSE x[i] END ELSE 0 END)), 4) AS x
FROM e JOIN f USING (vec_id)""")
def generation_run(spark, d):
    """From noise, with or without an init, over a schedule of the effective length to a signal that ends in zeros."""
    from ..operators.samplers import generate

    x, k = F.col("embedding").cast("array<double>"), F.col("vec_id")
    rows = _t(spark, d, "embeddings").select(k.alias("id"), x.alias("noise"), F.when(k % 3 == 0, F.reverse(x)).alias("init"), F.when(k % 4 != 0, k % 30 / 10).alias("seconds_total"))
    return generate(rows, 8, 64, 16, 1, headroom=0.5, sigma_max=0.8).select("id", "valid", _r(_w(F.col("x")), "x", 4))


@query("""
SELECT doc_id, n_chars BETWEEN 500 AND 4000 AS covered, CASE WHEN doc_id % 3 = 2 THEN NULL WHEN doc_id % 3 = 0 THEN 'dora-cols' ELSE 'dora-rows' END AS variant, CASE WHEN doc_id % 3 = 2 THEN 2 ELSE 1 END::INTEGER AS rank FROM documents""")
def engine_profiles(spark, d):
    """Lengths that a profile covers, and magnitude tensors by shape."""
    from ..operators import lowrank as L

    k = F.col("doc_id")
    docs = _t(spark, d, "documents").withColumn("shape", F.when(k % 3 == 0, F.array(F.lit(1), F.lit(8))).when(k % 3 == 1, F.array(F.lit(8), F.lit(1))).otherwise(F.array(F.lit(8), F.lit(8))))
    kept, skipped = K.profile_range(docs, F.col("n_chars"), 500, 4000)
    both = kept.withColumn("covered", F.lit(True)).unionByName(skipped.withColumn("covered", F.lit(False)))
    return both.select("doc_id", "covered", L.magnitude_variant(F.lit("blocks.0.magnitude"), F.col("shape")).alias("variant"), F.size(L.squeezed(F.col("shape"))).alias("rank"))


_SNR = "ln(greatest(1 - {0}, 1e-10) / greatest({0}, 1e-10))"


@query(f"""
WITH RECURSIVE {_STEPS}, w AS (SELECT k, a, b, lag(a) OVER (ORDER BY k) AS p FROM s),
g AS (SELECT k, a, b, CASE WHEN k > 0 AND b > 0 THEN ({_SNR.format('a')} - {_SNR.format('p')}) / ({_SNR.format('b')} - {_SNR.format('a')}) END AS r FROM w),
x AS (SELECT 0::BIGINT AS k, 1.0::DOUBLE AS x, 0.0::DOUBLE AS old
      UNION ALL
      SELECT g.k + 1, b / greatest(a, 1e-10) * x - (1 - b) * (b - a) / (greatest(1 - b, 1e-10) * greatest(a, 1e-10)) * (x / (1 + a) + CASE WHEN r IS NULL THEN 0 ELSE (x / (1 + a) - old) / (2 * r) END), x / (1 + a)
      FROM x JOIN g ON g.k = x.k)
SELECT vec_id AS id, round({_ws(VEC)} * x, 5) AS x FROM embeddings, x WHERE k = 8""")
def dpmpp_sampler(spark, d):
    return _sampled(spark, d, "dpmpp")
