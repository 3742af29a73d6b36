"""Registered queries of the engine's own operators: name -> callable (spark, sf_dir), name -> DuckDB SQL.

A document stands for a clip (n_chars samples), an embedding for a latent vector, an event for a metric of a step, a
conversation for a record of several chunks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import arrays as A
from ..functions import draws as D
from ..functions import schedules as S
from ..functions import text as T
from ..operators import aggregates as G
from ..operators import conditioning as K
from ..operators import records as R
from ..operators import windows as W
from .registry import ORACLES, QUERIES, query
from .registry import VEC as _VEC
from .registry import rounded as _r
from .registry import table as _t
from .registry import uniform_sql as _u
from .registry import weighed as _w
from .registry import weighed_sql as _ws

__all__ = ["ORACLES", "QUERIES"]

@query(f"""
WITH d AS (SELECT doc_id, n_chars, CASE WHEN {_u('0', 'doc_id')} < 0.1 THEN 'val' ELSE 'train' END AS split FROM documents),
c AS (SELECT doc_id, split, n_chars, unnest(range(0, ((n_chars + 499) // 500)::BIGINT)) AS k FROM d)
SELECT split, count(DISTINCT doc_id)::BIGINT AS n_docs, count(*)::BIGINT AS n_chunks, sum(least(500, n_chars - k * 500))::BIGINT AS n_valid
FROM c GROUP BY split""")
def split_chunks_summary(spark, d):
    docs = _t(spark, d, "documents").select("doc_id", "n_chars").withColumn("split", D.split("doc_id", 0.1))
    out = W.chunks(docs, F.col("n_chars"), 500)
    return out.groupBy("split").agg(F.count_distinct("doc_id").alias("n_docs"), F.count(F.lit(1)).alias("n_chunks"), F.sum("valid").cast("long").alias("n_valid"))


@query(f"SELECT doc_id, {_u('7', 'doc_id')} AS u FROM documents")
def hash_uniform(spark, d):
    return _t(spark, d, "documents").select("doc_id", D.uniform("doc_id", "7").alias("u"))


@query(f"""
WITH b AS (SELECT {_u('0.bucket', 'doc_id')} AS u, {_u('0.policy', 'doc_id')} AS v FROM documents)
SELECT CASE WHEN u < 0.30 THEN 'dense' WHEN u < 0.30 + 0.375 THEN 'vivid' ELSE 'one_line' END AS bucket,
       CASE WHEN v < 0.40 THEN 'keep' WHEN v < 0.40 + 0.30 THEN 'omit' ELSE 'prefix' END AS policy, count(*)::BIGINT AS n
FROM b GROUP BY ALL""")
def caption_bucket_choice(spark, d):
    docs = _t(spark, d, "documents")
    return docs.groupBy(D.choice(D.uniform("doc_id", "0.bucket"), D.CAPTION_CHANCES).alias("bucket"), D.choice(D.uniform("doc_id", "0.policy"), D.POLICY_CHANCES).alias("policy")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT doc_id, source FROM documents d WHERE doc_id >= 10 AND doc_id % 4 = 1 AND NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)")
def row_shard_resume(spark, d):
    done = _t(spark, d, "labels").select("doc_id", F.lit("done").alias("status"))
    return R.resume(R.row_shard(_t(spark, d, "documents"), "doc_id", 4, 1, start=10), done, "doc_id").select("doc_id", "source")


@query("""
WITH d AS (SELECT doc_id, n_chars AS n FROM documents WHERE n_chars >= 500),
s AS (SELECT doc_id, unnest(list_distinct(list_concat(range(0, n - 500 + 1, 375), [n - 500]))) AS start FROM d)
SELECT doc_id, start::INTEGER AS start FROM s""")
def overlap_chunk_starts(spark, d):
    docs = _t(spark, d, "documents").filter("n_chars >= 500")
    return docs.select("doc_id", F.explode(A.overlap_starts(F.col("n_chars"), 500, 125)).alias("start"))


@query("SELECT doc_id, true AS same, length(text)::INTEGER AS n FROM documents")
def overlap_stitch_identity(spark, d):
    docs = _t(spark, d, "documents").select("doc_id", "text")
    out = W.stitch(docs, "doc_id", "text", 200, 50)
    return out.join(docs, "doc_id").select("doc_id", (F.col("stitched") == F.col("text")).alias("same"), F.char_length("stitched").alias("n"))


@query("SELECT conv_id, count(DISTINCT turn)::BIGINT AS n FROM conversations GROUP BY conv_id HAVING count(DISTINCT turn) = max(turn) + 1")
def completion_barrier(spark, d):
    return R.barrier(_t(spark, d, "conversations").withColumnRenamed("turn", "chunk_idx"), "conv_id", F.col("chunk_idx") + 1)


@query("""
WITH m AS (SELECT user_id, coalesce(sum(value) FILTER (WHERE event_type <> 'error'), 0.0) / (count(*) FILTER (WHERE event_type <> 'error') + 1e-8) AS m FROM events GROUP BY user_id)
SELECT round(avg(m), 6) AS masked_mean FROM m""")
def masked_mean_two_level(spark, d):
    return G.masked_mean(_t(spark, d, "events"), "user_id", F.col("value"), F.col("event_type") != "error").select(_r("masked_mean", "masked_mean"))


@query("SELECT user_id, round(sum(CASE WHEN value > 50 THEN value ELSE 0 END), 4) AS masked_sum FROM events GROUP BY user_id")
def masked_sums(spark, d):
    return G.masked_sum(_t(spark, d, "events"), ["user_id"], F.col("value"), F.col("value") > 50).select("user_id", _r("masked_sum", "masked_sum", 4))


@query("""
WITH b AS (SELECT floor(value / 500 * 10)::INTEGER AS bucket, avg(value) FILTER (WHERE event_type <> 'error') AS mean, count(*) FILTER (WHERE event_type <> 'error') AS n
           FROM events WHERE value / 500 >= 0 AND value / 500 < 1 GROUP BY 1)
SELECT k::INTEGER AS bucket, round(mean, 6) AS mean, coalesce(n, 0)::BIGINT AS n FROM range(0, 10) t(k) LEFT JOIN b ON b.bucket = k""")
def bucketed_mean(spark, d):
    return G.bucketed_mean(_t(spark, d, "events"), F.col("value") / 500, F.col("value"), F.col("event_type") != "error").select("bucket", _r("mean", "mean"), "n")


@query("""
WITH p AS (SELECT user_id, coalesce(sum(value) FILTER (WHERE event_type <> 'click'), 0) AS s, count(*) FILTER (WHERE event_type <> 'click') AS ns,
                  coalesce(sum(value) FILTER (WHERE event_type = 'click'), 0) AS p, count(*) FILTER (WHERE event_type = 'click') AS np FROM events GROUP BY user_id)
SELECT round(avg((s + 0.25 * p) / (ns + 0.25 * np + 1e-8)), 6) AS loss, round(sum(s) / (sum(ns) + 1e-8), 6) AS signal_mean, round(sum(p) / (sum(np) + 1e-8), 6) AS padding_mean FROM p""")
def masked_loss(spark, d):
    out = G.masked_loss(_t(spark, d, "events"), "user_id", F.col("value"), F.col("event_type") != "click", 0.25)
    return out.select(*[_r(c, c) for c in out.columns])


def _frames(spark, d) -> DataFrame:
    return _t(spark, d, "embeddings").select("vec_id", "label", F.posexplode("embedding").alias("ch", "v")).withColumn("v", F.col("v").cast("double"))


def _nmse(how: str, keys: str | None) -> str:
    return f"""
WITH f AS (SELECT vec_id, label, unnest({_VEC}) AS v, unnest(range(0, 64)) AS ch FROM embeddings),
n AS (SELECT *, {'1.0' if keys is None else f'coalesce(var_pop(CASE WHEN ch < 48 THEN v END) OVER (PARTITION BY {keys}) + 1e-6, 1.0)'} AS var FROM f)
SELECT label, round(avg(CASE WHEN ch < 48 THEN (v - 0.01) * (v - 0.01) / var ELSE (v - 0.01) * (v - 0.01) END), 6) AS nmse FROM n GROUP BY label"""


@query(_nmse("sample", "vec_id"))
def normalized_mse_sample(spark, d):
    out = G.normalized_mse(_frames(spark, d), F.lit(0.01), F.col("v"), F.col("ch") < 48, ["vec_id"])
    return out.groupBy("label").agg(_r(F.avg("nmse"), "nmse"))


@query(_nmse("sample_channel", "label, ch"))
def normalized_mse_channel(spark, d):
    out = G.normalized_mse(_frames(spark, d), F.lit(0.01), F.col("v"), F.col("ch") < 48, ["label", "ch"])
    return out.groupBy("label").agg(_r(F.avg("nmse"), "nmse"))


@query("""
WITH w AS (SELECT user_id, value, (row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1) // 10 AS w FROM events)
SELECT user_id, w::INTEGER AS "window", count(*)::BIGINT AS n, round(avg(value), 6) AS avg FROM w GROUP BY user_id, w""")
def tumbling_metric_flush(spark, d):
    return G.tumbling_flush(_t(spark, d, "events"), ["user_id"], ["ts", "event_id"], "value", 10).select("user_id", "window", "n", _r("avg", "avg"))


@query("""
WITH RECURSIVE o AS (SELECT user_id, value AS x, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS k FROM events),
e AS (SELECT user_id, k, x AS e FROM o WHERE k = 0
      UNION ALL
      SELECT o.user_id, o.k, e.e + (o.x - e.e) * (1 - least(0.9995, 1 - pow(1 + o.k, -0.75))) FROM e JOIN o ON o.user_id = e.user_id AND o.k = e.k + 1)
SELECT user_id, (max(k) + 1)::BIGINT AS n, round(arg_max(e, k), 6) AS ema FROM e GROUP BY user_id""")
def ema_per_user(spark, d):
    return W.ema(_t(spark, d, "events"), ["user_id"], ["ts", "event_id"], "value").select("user_id", "n", _r("ema", "ema"))


@query("SELECT event_id, round(avg(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 3 PRECEDING AND 2 FOLLOWING), 6) AS near FROM events")
def band_window_avg(spark, d):
    return _t(spark, d, "events").select("event_id", _r(F.avg("value").over(W.band(["user_id"], ["ts", "event_id"], 3, 2)), "near"))


@query("SELECT a.conv_id, count(*)::BIGINT AS n_pairs FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND b.turn - a.turn BETWEEN -2 AND 1 GROUP BY a.conv_id")
def band_join(spark, d):
    return W.band_pairs(_t(spark, d, "conversations"), "conv_id", "turn", 2, 1).groupBy("conv_id").agg(F.count(F.lit(1)).alias("n_pairs"))


@query("""
WITH o AS (SELECT user_id, event_id, event_type = 'click' AS hit, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rn FROM events),
g AS (SELECT user_id, event_id, rn - row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS g FROM o WHERE hit)
SELECT user_id, min(event_id) AS first, max(event_id) AS last, count(*)::BIGINT AS n FROM g GROUP BY user_id, g""")
def contiguous_spans(spark, d):
    return W.spans(_t(spark, d, "events"), ["user_id"], "event_id", F.col("event_type") == "click")


@query('SELECT doc_id, (sum(n_chars) OVER w - n_chars)::BIGINT AS start, (sum(n_chars) OVER w)::BIGINT AS "end" FROM documents WINDOW w AS (ORDER BY doc_id ROWS UNBOUNDED PRECEDING)')
def cum_lengths(spark, d):
    return W.cumulative(_t(spark, d, "documents"), "doc_id", F.col("n_chars"))


@query("SELECT event_id, round(lead(value) OVER w - value, 6) AS dt FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id) QUALIFY dt IS NOT NULL")
def consecutive_differences(spark, d):
    return W.differences(_t(spark, d, "events"), ["user_id"], "event_id", "value").select("event_id", _r("dt", "dt"))


@query("SELECT vec_id, k::INTEGER AS i, embedding[floor(k * 64 / 10.0)::INTEGER + 1]::DOUBLE AS v FROM embeddings, range(0, 10) t(k)")
def nearest_resize(spark, d):
    return _t(spark, d, "embeddings").select("vec_id", F.posexplode(A.nearest(F.col("embedding"), 10)).alias("i", "v")).withColumn("v", F.col("v").cast("double"))


@query("SELECT doc_id, ceil((n_chars % 1000) * 64 / 1000.0)::INTEGER AS latent_valid FROM documents")
def ceil_mask_resize(spark, d):
    return _t(spark, d, "documents").select("doc_id", A.resized_length(F.col("n_chars") % 1000, F.lit(1000), 64).alias("latent_valid"))


@query("""
SELECT doc_id, (SELECT count(*) FROM range(0, n_chars) t(i) WHERE NOT (i >= 10 AND i < 20) AND NOT (i >= 50 AND i < 80) AND i < 150)::INTEGER AS kept FROM documents""")
def interval_mask(spark, d):
    regions = F.array(F.struct(F.lit(10).alias("s"), F.lit(20).alias("e")), F.struct(F.lit(50).alias("s"), F.lit(80).alias("e")))
    mask = A.interval_mask(F.coalesce("n_chars", F.lit(200)), regions, F.lit(150))
    return _t(spark, d, "documents").select("doc_id", F.aggregate(mask, F.lit(0), lambda a, v: a + v).alias("kept"))


@query(f"""
WITH o AS (SELECT vec_id, {_VEC} AS x, least(floor({_u('crop', 'vec_id')} * 17), 16)::INTEGER AS o FROM embeddings)
SELECT vec_id, o AS crop_start, round({_ws('x[o + 1:o + 48]')}, 5) AS cropped, round({_ws('x[o + 1:]')}, 5) AS padded, 80 AS n FROM o""")
def pad_crop(spark, d):
    e = _t(spark, d, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("x")).withColumn("o", D.offset("vec_id", F.lit(16)))
    wide = A.crop_or_pad(F.col("x"), F.col("o"), 80)
    return e.select("vec_id", F.col("o").alias("crop_start"), _r(_w(A.crop_or_pad(F.col("x"), F.col("o"), 48)), "cropped", 5), _r(_w(wide), "padded", 5), F.size(wide).alias("n"))


@query(f"""
WITH e AS (SELECT vec_id, {_VEC} AS x FROM embeddings)
SELECT vec_id, round({_ws('x')} + list_sum(list_transform(range(0, 16), lambda i: x[(i % 5) + 1] * (65 + i))), 5) AS tiled, 80 AS n FROM e""")
def latent_crop_pad(spark, d):
    x = F.col("embedding").cast("array<double>")
    out = A.tile_pad(x, 80, F.slice(x, 1, 5))
    return _t(spark, d, "embeddings").select("vec_id", _r(_w(out), "tiled", 5), F.size(out).alias("n"))


@query(f"SELECT vec_id, true AS same, round(list_sum(list_transform(range(0, 8), lambda i: ({_VEC})[i * 8 + 3] * (i + 1))), 5) AS third_row FROM embeddings")
def patch_unpatch(spark, d):
    e = _t(spark, d, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("x")).withColumn("p", A.patch(F.col("x"), 8))
    return e.select("vec_id", (A.unpatch(F.col("p")) == F.col("x")).alias("same"), _r(_w(F.get(F.col("p"), F.lit(2))), "third_row", 5))


@query(f"SELECT vec_id, round(sqrt(list_sum(list_transform({_VEC}, lambda x: x * x))), 6) AS norm, round(list_sum(list_transform({_VEC}, lambda x: x * x)) / 64, 6) AS energy FROM embeddings")
def vector_norm(spark, d):
    x = F.col("embedding").cast("array<double>")
    return _t(spark, d, "embeddings").select("vec_id", _r(A.norm(x), "norm"), _r(A.energy(x), "energy"))


def _pairs(spark, d) -> DataFrame:
    e = _t(spark, d, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("a"))
    return e.join(e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("a").alias("b")), "vec_id")


_PAIRS = f"p AS (SELECT x.vec_id, {_VEC.replace('embedding', 'x.embedding')} AS a, {_VEC.replace('embedding', 'y.embedding')} AS b FROM embeddings x JOIN embeddings y ON y.vec_id = x.vec_id + 1)"
_DOT = "list_sum(list_transform(range(1, 65), lambda i: {0}[i] * {1}[i]))"


@query(f"""
WITH {_PAIRS}, q AS (SELECT vec_id, a, b, {_DOT.format('a', 'b')} AS ab, {_DOT.format('b', 'b')} AS bb, {_DOT.format('a', 'a')} AS aa FROM p)
SELECT vec_id, round(abs(ab) / sqrt(bb), 5) AS along, round(sqrt(greatest(aa - ab * ab / bb, 0)), 5) AS across FROM q""")
def apg_projection(spark, d):
    p = _pairs(spark, d).withColumn("p", A.project(F.col("a"), F.col("b")))
    return p.select("vec_id", _r(A.norm(F.col("p.parallel")), "along", 5), _r(A.norm(F.col("p.orthogonal")), "across", 5))


@query(f"""
WITH {_PAIRS},
q AS (SELECT vec_id, a, b, list_transform(range(1, 65), lambda i: a[i] - b[i]) AS d FROM p),
n AS (SELECT vec_id, a, b, d, least(1.0, 0.8 / sqrt({_DOT.format('d', 'd')})) AS f FROM q),
o AS (SELECT vec_id, a, b, f, d, {_DOT.format('d', 'b')} / {_DOT.format('b', 'b')} AS along FROM n)
SELECT vec_id, round(list_sum(list_transform(range(1, 65), lambda i: (a[i] + 3.0 * (b[i] - a[i])) * i)), 4) AS guided,
       round(list_sum(list_transform(range(1, 65), lambda i: (b[i] - 2.0 * (0.6 * f * (d[i] - along * b[i]) + 0.4 * f * d[i])) * i)), 4) AS projected FROM o""")
def cfg_combine(spark, d):
    """x = 0 and sigma = 1: the output is uncond + scale * (cond - uncond), by branch rows brought together; then the
    same with the difference bounded by a norm and 0.6 of it projected off the conditional output."""
    both = R.branches(_pairs(spark, d)).withColumn("out", F.when(F.col("branch") == "cond", F.col("b")).otherwise(F.col("a")))
    p = both.groupBy("vec_id").pivot("branch", ["cond", "uncond"]).agg(F.first("out"))
    zero = F.transform(F.col("cond"), lambda v: F.lit(0.0))
    how = lambda **k: _w(A.guide(zero, F.col("cond"), F.col("uncond"), F.lit(1.0), 3.0, **k))
    return p.select("vec_id", _r(how(), "guided", 4), _r(how(apg=0.6, threshold=0.8), "projected", 4))


@query("""
SELECT doc_id, k::INTEGER AS k, round(CASE WHEN k = 0 THEN 1.0 WHEN k = 8 THEN 0.0 ELSE
  1 / (1 + exp(2.0 - (1 - k / 8.0) * (2.0 - (-6.2 - log2(greatest(n_chars, 1)::DOUBLE / 2000))))) END, 6) AS t FROM documents, range(0, 9) r(k)""")
def schedule_logsnr(spark, d):
    docs = _t(spark, d, "documents")
    return docs.select("doc_id", F.posexplode(S.schedule(8, F.col("n_chars"), S.log_snr)).alias("k", "t")).withColumn("t", F.round("t", 6))


@query("""
WITH d AS (SELECT doc_id, greatest(least(n_chars::DOUBLE, 4096.0), 256.0) AS n FROM documents),
s AS (SELECT doc_id, k, 1 - k / 8.0 AS t, exp(ln(3.0) * (ln(n) - ln(256.0)) / (ln(4096.0) - ln(256.0))) AS a, -(0.5 + 0.65 * (n - 256) / 3840) AS mu FROM d, range(1, 9) r(k))
SELECT doc_id, k::INTEGER AS k, round(a * t / (1 + (a - 1) * t), 6) AS flux, round(CASE WHEN t >= 1 THEN 1 ELSE 1 - exp(mu) / (exp(mu) + (1 / (1 - t) - 1)) END, 6) AS full_shift FROM s""")
def schedule_flux_full(spark, d):
    docs = _t(spark, d, "documents").select("doc_id", "n_chars", F.explode(F.sequence(F.lit(1), F.lit(8))).alias("k"))
    t = F.lit(1.0) - F.col("k") / 8
    return docs.select("doc_id", "k", _r(S.flux(t, F.col("n_chars"), alpha_high=3.0), "flux"), _r(S.full(t, F.col("n_chars")), "full_shift"))


@query("SELECT doc_id, ceil(floor(n_chars / 100.0 * 441) / 16.0)::INTEGER AS latent, (ceil(n_chars / 64.0) * 64)::INTEGER AS aligned FROM documents")
def effective_length(spark, d):
    return _t(spark, d, "documents").select("doc_id", A.latent_length(F.col("n_chars") / 100, 441, 16).alias("latent"), A.align_up(F.col("n_chars"), 64).alias("aligned"))


@query(f"""
WITH e AS (SELECT vec_id, list_max(list_transform({_VEC}, lambda x: abs(x))) AS p FROM embeddings)
SELECT vec_id, round(20 * log10(p + 1e-10), 5) AS peak_db, (20 * log10(p) < -12.0) AS silent FROM e""")
def peak_db_silence(spark, d):
    x = F.col("embedding").cast("array<double>")
    return _t(spark, d, "embeddings").select("vec_id", _r(A.decibel(A.peak(x)), "peak_db", 5), A.is_silent(x, -12.0).alias("silent"))


@query(f"""
WITH f AS (SELECT vec_id, k, list_max(list_transform(({_VEC})[k * 8 + 1:k * 8 + 8], lambda x: abs(x))) AS p FROM embeddings, range(0, 8) t(k)),
l AS (SELECT vec_id, max(k) FILTER (WHERE 20 * log10(p + 1e-10) > -10.0) AS k FROM f GROUP BY vec_id)
SELECT vec_id, coalesce((k + 1) * 8, 0)::INTEGER AS active FROM l""")
def trailing_silence_strip(spark, d):
    return _t(spark, d, "embeddings").select("vec_id", A.active_length(F.col("embedding").cast("array<double>"), 8, -10.0).alias("active"))


@query("""SELECT role, count(*) FILTER (WHERE text IS NOT NULL AND regexp_replace(text, '^\\s+|\\s+$', '', 'g') <> '')::BIGINT AS valid, count(*)::BIGINT AS n FROM conversations GROUP BY role""")
def prompt_validity(spark, d):
    return _t(spark, d, "conversations").groupBy("role").agg(F.count(F.when(T.valid_prompt(F.col("text")), 1)).alias("valid"), F.count(F.lit(1)).alias("n"))


@query("SELECT page_id, substr(regexp_replace(url, '[^A-Za-z0-9_.-]+', '_', 'g'), 1, 200) AS part, format('{:06d}{:04d}', page_id // 100, page_id % 100) AS shard_id FROM pages")
def sanitize_ids(spark, d):
    k = F.col("page_id")
    return _t(spark, d, "pages").select("page_id", T.safe_part(F.col("url")).alias("part"), F.format_string("%06d%04d", F.floor(k / 100), k % 100).alias("shard_id"))


@query("SELECT doc_id, sha256(regexp_replace(text, '^[\\s]+|[\\s]+$', '', 'g')) AS body FROM documents")
def heading_strip(spark, d):
    made = F.concat(F.lit("\n Genre: House\nSub-genres: Deep, Acid\n\n"), F.col("text"))
    return _t(spark, d, "documents").select("doc_id", F.sha2(T.strip_heading(made), 256).alias("body"))


@query("""
WITH p AS (SELECT p_partkey, string_split(p_type, ' ') AS w FROM part),
q AS (SELECT p_partkey, w[1] AS main, list_filter(w, lambda x: lower(x) <> lower(w[1]))[1:3] AS s FROM p)
SELECT p_partkey, CASE WHEN len(s) > 0 THEN main || ': ' || array_to_string(s, ', ') || '.' ELSE main || '.' END AS prefix FROM q""")
def subgenre_prefix(spark, d):
    words = F.split("p_type", " ")
    return _t(spark, d, "part").select("p_partkey", T.genre_prefix(F.get(words, F.lit(0)), T.subgenres(F.array_join(words, " , "))).alias("prefix"))


_ROOTS = [("en", 2), ("fr", 1), ("de", 3)]


@query("""
WITH p AS (SELECT page_id, regexp_extract(url, '^https?://[^/]+/([^?#]*)', 1) AS path FROM pages)
SELECT page_id, CASE WHEN path LIKE 'fr/%' OR path = 'fr' THEN 'fr' WHEN path LIKE 'en/%' OR path = 'en' THEN 'en' WHEN path LIKE 'de/%' OR path = 'de' THEN 'de' END AS root FROM p""")
def root_match_first(spark, d):
    roots = spark.createDataFrame(_ROOTS, "root string, priority int")
    pages = _t(spark, d, "pages").select("page_id", F.regexp_extract("url", r"^https?://[^/]+/([^?#]*)", 1).alias("path"))
    return R.root_match(pages, "path", roots).select("page_id", "root")


@query("SELECT d.doc_id, d.source, l.quality FROM documents d JOIN labels l USING (doc_id)")
def sidecar_join(spark, d):
    return R.sidecar(_t(spark, d, "documents").select("doc_id", "source"), _t(spark, d, "labels"), ["doc_id"]).select("doc_id", "source", "quality")


@query("""
SELECT conv_id, turn, CASE WHEN role = 'user' THEN text ELSE role END AS condition FROM conversations""")
def multi_key_condition(spark, d):
    c = _t(spark, d, "conversations")
    bag = F.map_filter(F.create_map(F.lit("prompt"), F.when(F.col("role") == "user", F.col("text")), F.lit("fallback"), F.col("role")), lambda k, v: v.isNotNull())
    return c.select("conv_id", "turn", R.lookup(bag, "prompt", "fallback").alias("condition"))


@query("""
WITH a AS (SELECT source AS split, max(doc_id) AS m, list(doc_id::VARCHAR) AS c FROM documents WHERE doc_id % 3 = 0 GROUP BY 1),
b AS (SELECT source AS split, max(doc_id) AS m, list(doc_id::VARCHAR) AS c FROM documents WHERE doc_id % 2 = 0 GROUP BY 1)
SELECT coalesce(a.split, b.split) AS split, greatest(a.m, b.m) AS next_idx, len(list_distinct(list_concat(coalesce(a.c, []), coalesce(b.c, []))))::INTEGER AS n FROM a FULL JOIN b ON a.split = b.split""")
def state_merge(spark, d):
    docs = _t(spark, d, "documents")
    part = lambda k: docs.filter(F.col("doc_id") % k == 0).groupBy(F.col("source").alias("split")).agg(F.max("doc_id").alias("next_idx"), F.collect_list(F.col("doc_id").cast("string")).alias("completed"))
    return R.merge_state(part(3), part(2)).select("split", "next_idx", F.size("completed").alias("n"))


@query("SELECT o_custkey, o_orderkey, rn::INTEGER AS rank FROM (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn <= 2")
def topk_retention(spark, d):
    return R.keep_newest(_t(spark, d, "orders"), ["o_custkey"], [F.desc("o_orderdate"), F.desc("o_orderkey")], 2).select("o_custkey", "o_orderkey", "rank")


@query("""
SELECT (user_id % 10)::BIGINT AS bucket, round(median(value) FILTER (WHERE event_type = 'click'), 6) AS click, round(median(value) FILTER (WHERE event_type = 'view'), 6) AS "view" FROM events GROUP BY 1""")
def pivot_timing(spark, d):
    e = _t(spark, d, "events").withColumn("bucket", F.col("user_id") % 10)
    return G.timing_pivot(e, "bucket", "event_type", "value", ["click", "view"]).select("bucket", _r("click", "click"), _r("view", "view"))


@query("SELECT event_type, round(median(value), 6) AS median, round(avg(value), 6) AS mean, min(value) AS min, max(value) AS max FROM events GROUP BY event_type")
def timing_statistics(spark, d):
    return G.timing_stats(_t(spark, d, "events"), ["event_type"], "value").select("event_type", _r("median", "median"), _r("mean", "mean"), "min", "max")


@query("""SELECT p_partkey, p_brand FROM part WHERE (p_brand LIKE '%#1%' OR p_brand LIKE '%#2%' OR p_brand LIKE '%#3%') AND p_brand NOT LIKE '%#22%' AND p_brand NOT LIKE '%#21%'""")
def name_filter_brackets(spark, d):
    return _t(spark, d, "part").filter(T.name_matches(F.col("p_brand"), ["#[1-3]"], ["#2[2-1]"])).select("p_partkey", "p_brand")


@query("""
WITH f AS (SELECT vec_id, label, unnest(range(0, 64)) AS ch, unnest(list_transform(embedding, lambda x: x::DOUBLE)) AS v FROM embeddings),
a AS (SELECT vec_id AS r, ch AS k, v FROM f WHERE ch < 8), b AS (SELECT label AS c, ch - 8 AS k, avg(v) AS v FROM f WHERE ch >= 8 AND ch < 16 GROUP BY 1, 2)
SELECT r, c, round(sum(a.v * b.v) * 0.5, 6) + 0.0::DOUBLE AS delta FROM a JOIN b ON a.k = b.k GROUP BY r, c""")
def low_rank_update(spark, d):
    """Every vector's first 8 channels by a factor of 8 x 10, the means of labels: linear in the number of vectors."""
    from ..operators.lowrank import long_product

    f = _frames(spark, d)
    up = f.filter("ch < 8").select(F.col("vec_id").alias("r"), F.col("ch").alias("k"), "v")
    down = f.filter("ch between 8 and 15").groupBy((F.col("ch") - 8).alias("k"), F.col("label").alias("c")).agg(F.avg("v").alias("v"))
    return long_product(up, down, 0.5).select("r", "c", (F.round("v", 6) + F.lit(0.0)).alias("delta"))


@query("SELECT label, round(avg(v), 6) AS mean, round(stddev_pop(v), 6) AS std, round(avg(v) * avg(v) + var_pop(v) - ln(var_pop(v) + 1e-8) - 1, 6) AS penalty FROM (SELECT label, unnest(list_transform(embedding, lambda x: x::DOUBLE)) AS v FROM embeddings) GROUP BY label")
def bottleneck_statistics(spark, d):
    return G.bottleneck_stats(_frames(spark, d), ["label"], "v").select("label", _r("mean", "mean"), _r("std", "std"), _r("penalty", "penalty"))


@query("SELECT round(avg(m), 6) AS validation_mean FROM (SELECT event_type, avg(value) AS m FROM events GROUP BY event_type)")
def validation_means(spark, d):
    return G.validation_means(_t(spark, d, "events"), "event_type", "value").select(_r("validation_mean", "validation_mean"))


@query("SELECT doc_id FROM documents WHERE n_chars IS NULL OR n_chars BETWEEN 500 AND 2500")
def duration_range(spark, d):
    return _t(spark, d, "documents").filter(R.duration_ok(F.col("n_chars"), 500, 2500)).select("doc_id")


@query(f"""
WITH w AS (SELECT doc_id, 'good' AS dataset_id, 1.0 AS weight FROM documents JOIN labels USING (doc_id) WHERE quality = 1
UNION ALL SELECT doc_id, 'poor', 0.5 FROM documents JOIN labels USING (doc_id) WHERE quality = 0 AND {_u('0.poor', 'doc_id')} < 0.5)
SELECT doc_id, dataset_id, weight::DOUBLE AS weight FROM w""")
def weighted_sources(spark, d):
    both = R.sidecar(_t(spark, d, "documents").select("doc_id"), _t(spark, d, "labels").select("doc_id", "quality"), ["doc_id"])
    out = D.weighted_union({"good": (both.filter("quality = 1"), 1.0), "poor": (both.filter("quality = 0"), 0.5)}, "doc_id")
    return out.select("doc_id", "dataset_id", "weight")


@query("SELECT conv_id, count(*)::INTEGER AS n, string_agg(role, ',' ORDER BY turn) AS roles FROM conversations GROUP BY conv_id")
def collate_batches(spark, d):
    out = G.collate(_t(spark, d, "conversations"), F.col("conv_id"), "turn", ["turn", "role"])
    return out.select(F.col("batch_id").alias("conv_id"), F.size("rows").alias("n"), F.array_join(F.transform("rows", lambda r: r["role"]), ",").alias("roles"))


@query("""
WITH d AS (SELECT *, row_number() OVER (ORDER BY doc_id) - 1 AS i FROM documents), n AS (SELECT count(*) AS n FROM documents),
k AS (SELECT k AS draw, least(floor((('0x' || substr(sha1('0.draw:' || k), 1, 16))::UBIGINT::DOUBLE / 18446744073709551616.0::DOUBLE) * n), n - 1)::BIGINT AS i FROM range(0, 300) t(k), n)
SELECT draw, doc_id, text, lang, source, n_chars FROM k JOIN d USING (i)""")
def epoch_resample(spark, d):
    return D.resample(_t(spark, d, "documents"), "doc_id", 300).select("draw", "doc_id", "text", "lang", "source", "n_chars")


@query(f"""
WITH g AS (SELECT *, row_number() OVER (ORDER BY doc_id) - 1 AS i, count(*) OVER () AS n FROM documents WHERE n_chars <= 3000),
b AS (SELECT doc_id AS key, least(floor({_u('0.again', 'doc_id')} * (SELECT max(n) FROM g)), (SELECT max(n) FROM g) - 1)::BIGINT AS i FROM documents WHERE n_chars > 3000)
SELECT doc_id, text, lang, source, n_chars, doc_id AS source_key FROM g
UNION ALL SELECT b.key, g.text, g.lang, g.source, g.n_chars, g.doc_id FROM b JOIN g USING (i)""")
def reject_resample(spark, d):
    """Rejected records give way to a drawn other one, with its whole row."""
    return R.on_reject(_t(spark, d, "documents"), "doc_id", F.col("n_chars") > 3000, "resample")


@query("SELECT doc_id, lang, n_chars // 100 AS seconds, greatest(n_chars / 1000.0, 5.0) AS duration FROM documents")
def row_context(spark, d):
    docs = _t(spark, d, "documents").withColumns({"duration_sec": F.lit(None).cast("double"), "duration_ms": F.col("n_chars").cast("double"), "uri": F.concat(F.lit("s3://b/"), F.col("doc_id").cast("string"))})
    return R.row_context(docs, "uri", 5.0).select("doc_id", "lang", F.floor(F.col("n_chars") / 100).alias("seconds"), F.col("seconds").alias("duration"))


@query("""SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS sum_qty, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue, count(*)::BIGINT AS n
FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY ALL""")
def pricing_summary(spark, d):
    li = _t(spark, d, "lineitem").filter(F.col("l_shipdate") <= F.lit("1998-09-02").cast("timestamp_ntz"))
    return li.groupBy("l_returnflag", "l_linestatus").agg(_r(F.sum("l_quantity"), "sum_qty", 2), _r(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), "revenue", 2), F.count(F.lit(1)).alias("n"))


@query("""SELECT r_name, c_mktsegment, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ALL""")
def region_revenue(spark, d):
    t = lambda n: _t(spark, d, n)
    j = t("lineitem").join(t("orders"), F.col("l_orderkey") == F.col("o_orderkey")).join(t("customer"), F.col("o_custkey") == F.col("c_custkey"))
    j = j.join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return j.groupBy("r_name", "c_mktsegment").agg(_r(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), "revenue", 2))


@query("SELECT event_type, (user_id % 4)::VARCHAR AS g, count(*)::BIGINT AS n, round(sum(value), 4) AS total FROM events GROUP BY CUBE (event_type, user_id % 4)")
def event_cube(spark, d):
    return _t(spark, d, "events").withColumn("g", (F.col("user_id") % 4).cast("string")).cube("event_type", "g").agg(F.count(F.lit(1)).alias("n"), _r(F.sum("value"), "total", 4))


@query("SELECT date_trunc('day', ts) AS day, event_type, count(*)::BIGINT AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL")
def daily_rollup(spark, d):
    return _t(spark, d, "events").groupBy(F.date_trunc("day", F.col("ts")).cast("timestamp_ntz").alias("day"), "event_type").agg(F.count(F.lit(1)).alias("n"), _r(F.sum("value"), "total", 4))


@query("""
WITH f AS (SELECT vec_id, unnest(range(0, 64)) AS ch, unnest(list_transform(embedding, lambda x: x::DOUBLE)) AS v FROM embeddings),
s AS (SELECT *, avg(v) FILTER (WHERE ch < 40) OVER (PARTITION BY vec_id) AS dc FROM f)
SELECT vec_id, round(max(dc), 6) AS dc, round(sum(CASE WHEN ch < 40 THEN (v - dc) * (v - dc) ELSE 0 END), 6) AS hf_energy FROM s GROUP BY vec_id""")
def feature_split(spark, d):
    out = K.feature_split(_frames(spark, d), ["vec_id"], F.col("v"), F.col("ch") < 40)
    return out.groupBy("vec_id").agg(_r(F.max("dc"), "dc"), _r(F.sum(F.col("hf") * F.col("hf")), "hf_energy"))


@query("""
WITH b AS (SELECT doc_id, source, CASE WHEN n_chars > 12000 THEN NULL ELSE n_chars / 100.0 END AS s FROM documents),
k AS (SELECT source, lang, bool_and(CASE WHEN n_chars > 12000 THEN NULL ELSE n_chars END IS NOT NULL) AS ok FROM documents GROUP BY 1, 2)
SELECT d.doc_id, CASE WHEN k.ok THEN ceil(floor(b.s * 50) / 8.0)::INTEGER::VARCHAR ELSE 'none' END AS latent
FROM documents d JOIN b USING (doc_id) JOIN k ON d.source = k.source AND d.lang = k.lang""")
def batch_latent_lengths(spark, d):
    docs = _t(spark, d, "documents").select("doc_id", F.concat_ws("/", "source", "lang").alias("batch"), F.when(F.col("n_chars") <= 12000, F.col("n_chars") / 100).alias("s"))
    return K.latent_lengths(docs, "batch", "s", 50, 8).select("doc_id", F.coalesce(F.col("latent").cast("string"), F.lit("none")).alias("latent"))


@query("""
WITH c AS (SELECT conv_id, turn, role, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS rn FROM conversations)
SELECT conv_id, turn, (rn // 3)::INTEGER AS batch FROM c""")
def micro_batching(spark, d):
    from ..streaming.etl import micro_batches

    return micro_batches(_t(spark, d, "conversations"), ["conv_id"], "turn", 3).select("conv_id", "turn", F.col("batch.k").alias("batch"))


@query("""
SELECT vec_id, round(list_sum(list_transform(range(1, 65), lambda i: i * CASE WHEN i % 3 = 0 THEN embedding[i]::DOUBLE ELSE embedding[65 - i]::DOUBLE END)), 5) AS pasted FROM embeddings""")
def paste_back(spark, d):
    e = F.col("embedding").cast("array<double>")
    mask = F.transform(F.sequence(F.lit(1), F.lit(64)), lambda i: (i % 3 == 0).cast("int"))
    return _t(spark, d, "embeddings").select("vec_id", _r(_w(K.paste_back(F.reverse(e), e, mask)), "pasted", 5))


from . import catalog_functions, catalog_records  # noqa: E402, F401  they register their queries
