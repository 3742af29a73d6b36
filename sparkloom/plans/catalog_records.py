"""Registered queries of record operators, sources, sinks and streams."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from ..functions import arrays as A
from ..functions import draws as D
from ..functions import text as T
from ..operators import aggregates as G
from ..operators import conditioning as K
from ..operators import lowrank as L
from ..operators import records as R
from ..operators import windows as W
from ..storage import scratch
from .registry import VEC, query
from .registry import rounded as _r
from .registry import table as _t
from .registry import uniform_sql as _u
from .registry import weighed as _w
from .registry import weighed_sql as _ws


@query("""
WITH d AS (SELECT d.doc_id, d.text, d.lang, d.n_chars, coalesce(l.quality = 0, false) AS silent, l.toxic = 1 AS reject FROM documents d LEFT JOIN labels l USING (doc_id))
SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN 'other ' || lang ELSE text END AS payload, n_chars % 7 AS extra FROM d
WHERE doc_id % 11 <> 0 AND n_chars IS NOT NULL AND NOT coalesce(reject, false) AND (lang = 'en' OR NOT silent) AND regexp_matches(coalesce(text, ''), '\\S') AND n_chars % 13 <> 0""")
def record_selection(spark, d):
    """The stream's selection, then a user function that rejects, replaces and adds."""
    df = R.sidecar(_t(spark, d, "documents"), _t(spark, d, "labels"), ["doc_id"], required=False)
    ok = R.record_ok(F.col("doc_id") % 11 != 0, F.col("n_chars").isNotNull(), F.col("text"), F.coalesce(F.col("quality") == 0, F.lit(False)), F.col("toxic") == 1, F.col("lang") == "en")
    fn = F.struct((F.col("n_chars") % 13 == 0).alias("reject"), F.when(F.col("doc_id") % 5 == 0, F.concat(F.lit("other "), F.col("lang"))).alias("replacement"), (F.col("n_chars") % 7).alias("extra"))
    return R.apply_custom(df.filter(ok).withColumn("payload", F.col("text")), fn, "payload").select("doc_id", "payload", "extra")


@query("""
SELECT doc_id, CASE WHEN lang = 'en' THEN 'english' ELSE lang END AS lang, json_object('doc_id', doc_id, 'source', source, 'n_chars', n_chars)::VARCHAR AS cleaned,
       round(least(n_chars % 50 / greatest(n_chars / 10.0, 1e-6), 1e9), 6) AS position, round(least(1.0, (n_chars % 50 + 5) / greatest(n_chars / 10.0, 1e-6)), 6) AS until FROM documents""")
def field_projection(spark, d):
    """Conditional replacement, a cleaned JSON row, chunk metadata."""
    df = _t(spark, d, "documents")
    df = R.replace_if_equal(df, "lang", "en", "english").withColumn("cleaned", R.clean_row(df.select("doc_id", "source", "n_chars", "text"), ["text"]))
    df = df.withColumns({"seconds_start": F.col("n_chars") % 50, "seconds_total": F.col("n_chars") / 10, "chunk_seconds": F.lit(5)})
    return R.chunk_metadata(df).select("doc_id", "lang", "cleaned", _r("normalized_track_position", "position"), _r(F.get("timestamps", F.lit(1)), "until"))


@query("""
SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN source WHEN doc_id % 3 = 1 THEN lang END AS prompt, CASE WHEN doc_id % 4 <> 0 THEN round_even(n_chars / 2.0, 0)::INTEGER ELSE -1 END AS tempo FROM documents""")
def base_conditioning(spark, d):
    """The first caption that is not blank; tempo rounded half to even, null where it is no number."""
    k = F.col("doc_id")
    bpm = F.when(k % 4 == 0, "fast").otherwise((F.col("n_chars") / 2).cast("string"))
    c = R.base_conditioning(F.when(k % 3 == 0, F.col("source")).otherwise("  "), F.when(k % 3 == 1, F.col("lang")), F.lit(None).cast("string"), bpm)
    return _t(spark, d, "documents").select("doc_id", c["prompt"].alias("prompt"), F.coalesce(c["tempo"], F.lit(-1)).alias("tempo"))


@query("SELECT conv_id, count(*)::INTEGER AS n, max(role) FILTER (WHERE turn = 0) AS first, max(text) FILTER (WHERE turn = 1) AS second FROM conversations GROUP BY conv_id")
def members_by_key(spark, d):
    """Files of one key, by ending."""
    c = _t(spark, d, "conversations").withColumn("ext", F.concat(F.lit("t"), F.col("turn").cast("string")))
    files = c.withColumn("value", F.when(F.col("turn") == 0, F.col("role")).otherwise(F.col("text")))
    m = R.group_members(files, "conv_id", "ext", "value")
    return m.select("conv_id", F.size("members").alias("n"), F.try_element_at("members", F.lit("t0")).alias("first"), F.try_element_at("members", F.lit("t1")).alias("second"))


def _tensors(spark, d):
    e = _t(spark, d, "embeddings")
    model = e.select(F.concat(F.lit("blocks."), F.col("vec_id").cast("string"), F.lit(".weight")).alias("name"), F.array(F.lit(64)).alias("shape"), F.col("embedding").cast("array<double>").alias("values"))
    short = F.col("vec_id") % 5 == 0
    named = F.when(F.col("vec_id") % 3 == 0, F.concat(F.lit("blocks.model."), F.col("vec_id").cast("string"), F.lit(".weight"))).otherwise(F.concat(F.lit("blocks."), F.col("vec_id").cast("string"), F.lit(".weight")))
    x = F.col("embedding").cast("array<double>")
    saved = e.filter("vec_id % 7 <> 0").select(named.alias("name"), F.when(short, F.array(F.lit(32))).otherwise(F.array(F.lit(64))).alias("shape"), F.when(short, F.slice(x, 1, 32)).otherwise(F.reverse(x)).alias("values"))
    return model, saved


@query(f"""
WITH e AS (SELECT vec_id, 'blocks.' || vec_id || '.weight' AS name, {VEC} AS x FROM embeddings),
s AS (SELECT *, vec_id % 7 <> 0 AS saved, vec_id % 3 <> 0 AS same, vec_id % 5 <> 0 AS fits FROM e)
SELECT name, saved AND same AND fits AS loaded, CASE WHEN saved THEN CASE WHEN same THEN name ELSE 'blocks.model.' || vec_id || '.weight' END END AS source,
       round(CASE WHEN saved AND same AND fits THEN {_ws('list_reverse(x)')} WHEN saved AND same THEN {_ws('x[1:32]')} ELSE {_ws('x')} END, 5) AS averaged FROM s""")
def tensor_matching(spark, d):
    """Checkpoint and model by name and shape, names with one part left out, averages seeded from online weights."""
    model, saved = _tensors(spark, d)
    hit, missed = R.match_tensors(model, saved)
    both = hit.select("name", F.lit(True).alias("loaded")).unionByName(missed.select("name", F.lit(False).alias("loaded")))
    ema = R.reconcile(model, saved).select("name", _r(_w(F.col("values")), "averaged", 5))
    return both.join(R.remap_names(model, saved), "name", "left").join(ema, "name").select("name", "loaded", "source", "averaged")


@query("""
WITH l AS (SELECT 'step=' || o_orderkey || '.ckpt' AS name, o_custkey % 50 AS size FROM orders)
SELECT name, size FROM l WHERE NOT EXISTS (SELECT 1 FROM orders r WHERE r.o_orderkey % 3 = 0 AND 'step=' || r.o_orderkey || '.ckpt' = l.name AND (r.o_custkey + r.o_orderkey % 2) % 50 = l.size)""")
def remote_difference(spark, d):
    """Local files without a remote one of that name and size."""
    o = _t(spark, d, "orders")
    name = F.concat(F.lit("step="), F.col("o_orderkey").cast("string"), F.lit(".ckpt")).alias("name")
    remote = o.filter("o_orderkey % 3 = 0").select(name, ((F.col("o_custkey") + F.col("o_orderkey") % 2) % 50).alias("size"))
    return R.missing_remote(o.select(name, (F.col("o_custkey") % 50).alias("size")), remote).select("name", "size")


@query("""
WITH f AS (SELECT doc_id, 'epoch=1-step=' || (doc_id * 37 % 1009) || '.ckpt' AS name, n_chars AS mtime FROM documents),
v AS (SELECT *, row_number() OVER (ORDER BY doc_id * 37 % 1009 DESC, doc_id DESC) AS r, row_number() OVER (ORDER BY mtime DESC, doc_id) AS m FROM f),
h AS (SELECT doc_id FROM documents WHERE doc_id % 4 = 1 ORDER BY doc_id LIMIT 7)
SELECT 'version' AS kind, name, r::INTEGER AS place FROM v WHERE r <= 5 UNION ALL SELECT 'latest', name, m::INTEGER FROM v WHERE m = 1
UNION ALL SELECT 'shard', doc_id::VARCHAR, 0 FROM h""")
def newest_files(spark, d):
    """The newest by version and by time, and the first rows of a shard."""
    docs = _t(spark, d, "documents")
    f = docs.select("doc_id", F.concat(F.lit("epoch=1-step="), (F.col("doc_id") * 37 % 1009).cast("string"), F.lit(".ckpt")).alias("name"), F.col("n_chars").alias("mtime"))
    by_version = R.keep_newest(f, [], [T_desc(R.version_step(F.col("name"))), F.desc("doc_id")], 5).select(F.lit("version").alias("kind"), "name", F.col("rank").alias("place"))
    latest = R.keep_newest(f, [], [F.desc("mtime"), F.asc("doc_id")], 1).select(F.lit("latest").alias("kind"), "name", F.col("rank").alias("place"))
    shard = R.row_shard(docs, "doc_id", 4, 1, limit=7).select(F.lit("shard").alias("kind"), F.col("doc_id").cast("string").alias("name"), F.lit(0).alias("place"))
    return by_version.unionByName(latest).unionByName(shard)


def T_desc(c):
    return c.desc()


@query(f"SELECT doc_id, (row_number() OVER (ORDER BY {_u('3.order', 'doc_id')}, doc_id) - 1)::BIGINT AS place FROM documents")
def seeded_order(spark, d):
    """A seeded order of rows (shuffling of records and of shards); the place of each."""
    made = _t(spark, d, "documents").select("doc_id", D.uniform("doc_id", "3.order").alias("u"))
    return D.numbered(made, "u", "place").select("doc_id", "place")


@query("""
WITH e AS (SELECT event_id, event_type, user_id, value, event_type <> 'error' AS ok FROM events)
SELECT user_id, round(avg((value - 50) * (value - 50)), 4) AS loss, round(stddev_samp(value) FILTER (WHERE ok), 5) AS std FROM e GROUP BY user_id""")
def element_losses(spark, d):
    """Squared errors of elements without a variance, and the deviation of valid values."""
    e = _t(spark, d, "events").withColumn("ok", F.col("event_type") != "error")
    loss = G.normalized_mse(e, F.col("value"), F.lit(50.0), F.col("ok"), None).groupBy("user_id").agg(_r(F.avg("nmse"), "loss", 4))
    return loss.join(G.valid_std(e, ["user_id"], F.col("value"), F.col("ok")).select("user_id", _r("std", "std", 5)), "user_id")


@query("""
WITH e AS (SELECT count(*) AS n, count(*) FILTER (WHERE event_type = 'purchase') AS k, max(value) AS s, min(user_id) AS r, count(DISTINCT user_id) AS u FROM events)
SELECT n::BIGINT AS total, k::BIGINT AS finished, round(100.0 * k / n, 6) AS percent, round(60.0 * k / s, 6) AS rows_per_minute, round((n - k) * s / k, 4) AS eta_seconds, r AS rank, u = 1 AS agreed FROM e""")
def job_progress(spark, d):
    """Counts and remaining time of a job; the rank that workers agree on."""
    e = _t(spark, d, "events")
    p = G.progress(e, F.col("event_type") == "purchase", F.col("value"))
    both = p.select("total", "finished", _r("percent", "percent"), _r("rows_per_minute", "rows_per_minute"), _r("eta_seconds", "eta_seconds", 4), F.lit(1).alias("one"))
    return both.join(G.agreed_rank(e, "user_id").withColumn("one", F.lit(1)), "one").drop("one")


@query("SELECT source || '/' || lang AS batch, coalesce(max(n_chars) FILTER (WHERE n_chars < 9000), 0)::DOUBLE / 100 AS max_seconds FROM documents GROUP BY ALL")
def batch_longest(spark, d):
    df = _t(spark, d, "documents").select(F.concat_ws("/", "source", "lang").alias("batch"), F.when(F.col("n_chars") < 9000, F.col("n_chars") / 100).alias("s"))
    return K.longest(df, "batch", "s").select("batch", F.round("max_seconds", 6).alias("max_seconds"))


def _adapters(spark, d):
    x = _t(spark, d, "embeddings").select("vec_id", "label", F.posexplode("embedding").alias("i", "v"))
    return x.select(F.concat(F.lit("a"), (F.col("vec_id") % 4).cast("string")).alias("adapter"), F.concat(F.lit("w"), F.col("label").cast("string")).alias("name"), F.lit(0.5).alias("weight"), F.floor(F.col("i") / 8).cast("int").alias("r"), (F.col("i") % 8).alias("c"), F.col("v").cast("double").alias("v"))


@query(f"""
WITH f AS (SELECT vec_id % 4 AS a, label, unnest({VEC}) AS v, unnest(range(0, 64)) AS i FROM embeddings),
m AS (SELECT 'w' || label AS name, (i // 8)::INTEGER AS r, (i % 8)::INTEGER AS c, sum(v * CASE a WHEN 1 THEN 2.0 ELSE 0.5 END) AS v FROM f WHERE a <> 3 GROUP BY ALL)
SELECT name, r, c, round(v, 6) AS v, 3::BIGINT AS n_adapters FROM m""")
def adapter_merge(spark, d):
    """Adapters selected, one's strength set, the rest merged by weight."""
    some = L.set_strength(L.select_adapters(_adapters(spark, d), remove=["a3"]), {"a1": 2.0})
    n = L.adapter_count(some)
    return L.merge(some).join(F.broadcast(n)).select("name", "r", "c", _r("v", "v"), "n_adapters")


@query(f"""
WITH f AS (SELECT label AS r, vec_id % 8 AS k, unnest({VEC}) AS v, unnest(range(0, 64)) AS c FROM embeddings),
w AS (SELECT r, c, avg(v) AS v FROM f GROUP BY ALL), x AS (SELECT r, c, avg(v) FILTER (WHERE k = 3) AS v FROM f GROUP BY ALL),
s AS (SELECT w.r, w.c, w.v + coalesce(x.v, 0) AS v FROM w JOIN x USING (r, c)), n AS (SELECT r, sqrt(sum(v * v)) AS n FROM s GROUP BY r),
y AS (SELECT r, c, v * (1 + r / 10.0) / n AS v FROM s JOIN n USING (r)), m AS (SELECT c, sqrt(sum(v * v)) AS n FROM y GROUP BY c)
SELECT r, c::INTEGER AS c, round(y.v, 6) AS dora, round(y.v * 0.5 / m.n, 6) AS bora FROM y JOIN m USING (c)""")
def magnitude_updates(spark, d):
    """Weights plus an update, scaled to row magnitudes, and then to column magnitudes."""
    f = _t(spark, d, "embeddings").select(F.col("label").alias("r"), (F.col("vec_id") % 8).alias("k"), F.posexplode("embedding").alias("c", "v")).withColumn("v", F.col("v").cast("double"))
    w = f.groupBy("r", "c").agg(F.avg("v").alias("v"))
    delta = f.groupBy("r", "c").agg(F.coalesce(F.avg(F.when(F.col("k") == 3, F.col("v"))), F.lit(0.0)).alias("v"))
    rows = f.select("r").distinct().withColumn("norm", 1 + F.col("r") / 10)
    cols = f.select("c").distinct().withColumn("norm", F.lit(0.5))
    return L.dora(w, delta, rows, "r").select("r", "c", _r("v", "dora")).join(L.bora(w, delta, rows, cols).select("r", "c", _r("v", "bora")), ["r", "c"])


@query(f"""
WITH e AS (SELECT vec_id, label, {VEC} AS x FROM embeddings)
SELECT vec_id, round({_ws('list_concat(x[1:8], x[33:40])')}, 5) AS crossed, 16::INTEGER AS tokens, round({_ws('x[1:8]')}, 5) AS negative_kept,
       round({_ws('list_concat(x[33:40], x[1:8])')}, 5) AS prepended, round({_ws('x[33:40]')}, 5) AS localised FROM e""")
def conditioning_assembly(spark, d):
    """Conditioning by role: tokens one after the other, masks, local and prepended entries, negatives."""
    x = F.col("embedding").cast("array<double>")
    ones = F.array_repeat(F.lit(1), 8)
    entry = lambda v: F.struct(v.alias("emb"), ones.alias("mask"))
    bag = F.create_map(F.lit("text"), entry(F.slice(x, 1, 8)), F.lit("style"), entry(F.slice(x, 33, 8)), F.lit("negative_style"), entry(F.slice(x, 1, 8)))
    plain = K.assemble(bag, cross=["text", "style"], glob=["style"], local=["style"], prepend=["style", "text"])
    other = K.assemble(bag, cross=["style"], negative=True)
    return _t(spark, d, "embeddings").select("vec_id", _r(_w(plain["cross"]), "crossed", 5), F.size(plain["cross_mask"]).alias("tokens"), _r(_w(other["cross"]), "negative_kept", 5), _r(_w(plain["prepend"]), "prepended", 5), _r(_w(plain["local"]["style"]), "localised", 5))


@query(f"""
WITH e AS (SELECT vec_id, label, {VEC} AS x FROM embeddings)
SELECT vec_id, f::INTEGER AS frame, 'g' || label AS label, x[f + 1] AS dim_0, x[f + 17] AS dim_1, x[f + 33] AS dim_2, x[f + 49] AS dim_3 FROM e, range(0, 16) t(f)""")
def embedding_rows(spark, d):
    """One row a frame, one column a dimension."""
    x = F.col("embedding").cast("array<double>")
    e = _t(spark, d, "embeddings").select("vec_id", F.concat(F.lit("g"), F.col("label").cast("string")).alias("label"), F.array(*[F.slice(x, 16 * k + 1, 16) for k in range(4)]).alias("x"))
    return K.embedding_table(e, "vec_id", "x", "label")


@query("""
WITH l AS (SELECT DISTINCT source AS name, lang || CASE WHEN doc_id % 5 = 0 THEN '/' ELSE '/part-' || (doc_id % 3) || '.tar' END AS object FROM documents),
u AS (SELECT DISTINCT 's3://b/' || name || '/' || CASE WHEN starts_with(object, s || '/') THEN object ELSE s || '/' || object END AS url FROM l, (VALUES ('en'), ('full')) v(s) WHERE object NOT LIKE '%/')
SELECT url FROM u""")
def object_urls(spark, d):
    """Listed objects for every name and subset."""
    from ..sources.scan import object_urls as urls

    k = F.col("doc_id")
    tail = F.when(k % 5 == 0, "/").otherwise(F.concat(F.lit("/part-"), (k % 3).cast("string"), F.lit(".tar")))
    listing = _t(spark, d, "documents").select(F.col("source").alias("name"), F.concat(F.lit("2024-01-01 00:00:00 12 "), F.col("lang"), tail).alias("line"))
    return urls(listing.select("name").distinct(), ["en", "full"], listing, "s3://b/")


@query(f"""
WITH e AS (SELECT vec_id, {VEC} AS x FROM embeddings), q AS (SELECT vec_id, list_transform(x, lambda v: trunc(greatest(least(v, 1.0), -1.0) * 32767) / 32767) AS x FROM e)
SELECT vec_id, 16000::INTEGER AS rate, 2::INTEGER AS channels, round({_ws('x[1:32]')}, 3) AS first, round({_ws('x[33:64]')}, 3) AS second, NULL::VARCHAR AS error FROM q""")
def wav_round_trip(spark, d):
    """Two channels written as 16-bit PCM and decoded again."""
    from ..sources import scan

    x = F.col("embedding").cast("array<double>")
    files = _t(spark, d, "embeddings").select("vec_id", scan.wav_bytes(F.array(F.slice(x, 1, 32), F.slice(x, 33, 32)), 16_000).alias("content"))
    rows = F.col("audio.samples")
    return scan.wav(files).select("vec_id", F.col("audio.sample_rate").alias("rate"), F.size(rows).alias("channels"), _r(_w(F.get(rows, F.lit(0))), "first", 3), _r(_w(F.get(rows, F.lit(1))), "second", 3), "error")


@query("SELECT doc_id, sha256(coalesce(text, '')) AS body, lang FROM documents")
def tar_round_trip(spark, d):
    """Records written to tar shards, and read again by key and ending."""
    from ..sources import scan, sinks

    docs = _t(spark, d, "documents")
    members = F.map_from_arrays(F.array(F.lit("txt"), F.lit("lang")), F.array(F.coalesce("text", F.lit("")).cast("binary"), F.col("lang").cast("binary")))
    rows = docs.select("doc_id", D.split("doc_id", 0.1).alias("split"), F.format_string("%08d", "doc_id").alias("key"), F.floor(F.col("doc_id") / 4).alias("grp"), members.alias("members"))
    path = scratch(spark, "shards")
    sinks.write_shards(rows.drop("doc_id"), path, 40).write.format("noop").mode("overwrite").save()
    back = scan.webdataset(spark, path)
    return back.select(F.regexp_extract("key", r"(\d+)$", 1).cast("long").alias("doc_id"), F.sha2(F.element_at("members", "txt"), 256).alias("body"), F.element_at("members", "lang").cast("string").alias("lang"))


@query(f"""
WITH e AS (SELECT label, 'up.' || vec_id AS name, {VEC} AS x FROM embeddings WHERE vec_id % 2 = 0)
SELECT name, 2::INTEGER AS rank, round({_ws('x')}, 4) AS x FROM e""")
def tensor_prefix_scan(spark, d):
    """Tensor files of one label each; only the byte ranges of names under a prefix are read."""
    from ..sources import scan
    from ..storage import filesystem

    folder = scratch(spark, "tensors")

    def write(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        path = f"{folder}/{key[0]}-{pdf['vec_id'].min()}.safetensors"
        system, local = filesystem(path)
        system.create_dir(local.rpartition("/")[0], recursive=True)
        raw = scan.write_tensors({f"{'up' if k % 2 == 0 else 'down'}.{k}": np.asarray(x, float).reshape(8, 8) for k, x in zip(pdf["vec_id"], pdf["embedding"], strict=True)}, half=False)
        with system.open_output_stream(local, compression=None) as f:
            f.write(raw)
        return pd.DataFrame({"path": [path]})

    # a file holds up to 1,000 vectors, so no task holds more
    e = _t(spark, d, "embeddings").withColumn("file", F.floor(F.col("vec_id") / 1000))
    files = e.groupBy("label", "file").applyInPandas(write, "path string")
    listed = scratch(spark, "tensor-files")
    files.write.parquet(listed)
    found = scan.tensor_ranges(spark.read.parquet(listed), "up.")
    return found.select("name", F.size("shape").alias("rank"), _r(_w(F.col("values")), "x", 4))


@query("""
WITH c AS (SELECT conv_id, turn, hex(encode(role || turn)) AS h FROM conversations)
SELECT conv_id, turn, least(len(h) // 2, 6)::INTEGER AS n, list_sum(list_transform(range(1, least(len(h) // 2, 6)::BIGINT + 1), lambda i: i * ('0x' || substr(h, (2 * i - 1)::BIGINT, 2))::INTEGER))::DOUBLE AS ids FROM c""")
def byte_tokens(spark, d):
    """Token ids cut or padded to a length, with their mask."""
    from ..sources.scan import tokenized

    t = tokenized(F.concat("role", F.col("turn").cast("string")), 6)
    return _t(spark, d, "conversations").select("conv_id", "turn", A.total(t["mask"]).cast("int").alias("n"), _w(t["ids"]).alias("ids"))


@query(f"SELECT vec_id, 4::INTEGER AS channels, round({_ws('list_transform(range(0, 16), lambda k: (' + VEC + ')[4 * k + 2])')}, 4) AS second FROM embeddings")
def interleaved_frames(spark, d):
    """Streamed 32-bit frames to channel rows."""
    from ..sources.scan import pcm_frames

    @F.pandas_udf("binary")
    def packed(x: pd.Series) -> pd.Series:
        return x.map(lambda v: v.astype("<f4").tobytes())

    e = _t(spark, d, "embeddings").select("vec_id", packed("embedding").alias("content"))
    return pcm_frames(e, 4).select("vec_id", F.size("samples").alias("channels"), _r(_w(F.get("samples", F.lit(1))), "second", 4))


@query("""
SELECT 'done' AS kind, count(*)::BIGINT AS n FROM documents WHERE doc_id % 9 <> 0 UNION ALL SELECT 'failed', count(*) FROM documents WHERE doc_id % 9 = 0
UNION ALL SELECT 'state', max(doc_id) FROM documents WHERE doc_id % 2 = 0 UNION ALL SELECT 'metrics', count(*) FROM documents UNION ALL SELECT 'tsv', sum(n_chars)::BIGINT FROM documents
UNION ALL SELECT 'names', count(*) FROM documents WHERE doc_id % 2 = 1""")
def sink_round_trip(spark, d):
    """Dead letters, completion marks, numbered state, metrics and TSV, written and read again."""
    from ..sources import sinks

    path, docs = scratch(spark, "sinks"), _t(spark, d, "documents")
    rows = docs.select(F.col("doc_id").cast("string").alias("key"), F.when(F.col("doc_id") % 9 == 0, "unreadable").alias("error"))
    sinks.mark_done(sinks.dead_letters(rows, f"{path}/errors"), f"{path}/done")
    part = lambda k: docs.filter(F.col("doc_id") % k == 0).agg(F.lit("train").alias("split"), F.max("doc_id").alias("next_idx"), F.array(F.lit("x")).alias("completed"))
    sinks.save_state(part(3), f"{path}/state")
    sinks.save_state(part(2), f"{path}/state")
    sinks.log_metrics(docs.select(F.col("doc_id").alias("step"), F.lit("loss").alias("name"), F.col("n_chars").cast("double").alias("value")), f"{path}/metrics", "r1")
    sinks.write_tsv(docs.select("doc_id", "n_chars"), f"{path}/tsv")
    count = lambda df, kind: df.agg(F.lit(kind).alias("kind"), F.count(F.lit(1)).alias("n"))
    out = count(spark.read.schema("key string, status string").parquet(f"{path}/done"), "done")
    out = out.unionByName(count(spark.read.schema("key string, error string").json(f"{path}/errors"), "failed"))
    out = out.unionByName(sinks.load_state(spark, f"{path}/state").select(F.lit("state").alias("kind"), F.col("next_idx").alias("n")))
    out = out.unionByName(count(spark.read.schema("step long, name string, value double, run string").parquet(f"{path}/metrics"), "metrics"))
    out = out.unionByName(spark.read.option("sep", "\t").option("header", "true").schema("doc_id long, n_chars long").csv(f"{path}/tsv").agg(F.lit("tsv").alias("kind"), F.sum("n_chars").alias("n")))
    named = docs.select(sinks.output_name(F.lit("out"), F.lit(None).cast("string"), F.col("doc_id"), F.col("doc_id") % 2 + 1).alias("name"))
    return out.unionByName(count(named.filter(F.col("name").rlike(r"^out_\d+\.wav$")), "names"))


@query("""
WITH c AS (SELECT user_id, ts, value FROM events), p AS (SELECT user_id % 20 AS u, p AS path, p % 3 AS priority FROM (SELECT DISTINCT user_id, user_id % 7 AS p FROM events))
SELECT u AS user, (arg_min(path, priority * 1000 + path))::BIGINT AS path FROM p WHERE path <> 2 GROUP BY u""")
def cached_first(spark, d):
    """The first candidate path that exists."""
    e = _t(spark, d, "events").select("user_id").distinct().select((F.col("user_id") % 20).alias("user"), (F.col("user_id") % 7).alias("path")).withColumn("priority", F.col("path") % 3)
    return R.first_existing(e, "user", e.select("path").distinct().filter("path <> 2"))


@query("""
WITH o AS (SELECT doc_id, source, turn FROM (SELECT doc_id, source, n_chars % 20 AS turn FROM documents))
SELECT source, list_sum(list_transform(list(turn ORDER BY doc_id), lambda x: x))::BIGINT AS total, count(*)::INTEGER AS n FROM o GROUP BY source""")
def trimmed_concat(spark, d):
    """Arrays cut to their own lengths, one after the other by key."""
    docs = _t(spark, d, "documents").select("source", "doc_id", (F.col("n_chars") % 20).cast("int").alias("keep"), F.array_repeat(F.lit(1), 30).alias("x"))
    joined = W.trim_concat(docs, "source", "doc_id", "x", F.greatest("keep", F.lit(0)))
    return joined.select("source", F.size("joined").cast("long").alias("total")).join(docs.groupBy("source").agg(F.count(F.lit(1)).cast("int").alias("n")), "source")


@query("""
WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER w >= INTERVAL 6 HOUR OR lag(ts) OVER w IS NULL THEN 1 ELSE 0 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
s AS (SELECT user_id, sum(new) OVER (PARTITION BY user_id ORDER BY ts) AS s FROM g), n AS (SELECT user_id, s, count(*) AS n FROM s GROUP BY ALL)
SELECT user_id, count(*)::BIGINT AS sessions, max(n)::BIGINT AS longest FROM n GROUP BY user_id""")
def session_windows(spark, d):
    from ..streaming.etl import sessions

    e = _t(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return sessions(e, "user_id", "6 hours").groupBy("user_id").agg(F.count(F.lit(1)).alias("sessions"), F.max("n").alias("longest"))


@query("""
WITH m AS (SELECT conv_id, turn, max(turn) OVER (PARTITION BY conv_id) AS top FROM conversations), k AS (SELECT * FROM m WHERE NOT (conv_id % 3 = 0 AND turn = 0))
SELECT conv_id::VARCHAR AS key, (max(top) + 1)::INTEGER AS expected, count(DISTINCT turn)::BIGINT AS n FROM k WHERE conv_id % 3 = 0 GROUP BY conv_id""")
def unresolved_keys(spark, d):
    """Keys that are not complete when a stream ends."""
    from ..streaming.etl import round_robin, unresolved

    c = _t(spark, d, "conversations")
    top = c.groupBy("conv_id").agg((F.max("turn") + 1).cast("int").alias("expected"))
    rows = c.join(top, "conv_id").filter(~((F.col("conv_id") % 3 == 0) & (F.col("turn") == 0)))
    return unresolved(round_robin(rows.select(F.col("conv_id").cast("string").alias("key"), F.col("turn").alias("chunk_idx"), "expected"), 4))


@query("""
WITH c AS (SELECT conv_id AS id, text, row_number() OVER (PARTITION BY conv_id ORDER BY text) - 1 AS place FROM conversations)
SELECT id, place::INTEGER AS place, 2.0::DOUBLE AS seconds_total, 90112::INTEGER AS samples, 22::INTEGER AS latents, 16::INTEGER AS kept, sha256(text) AS prompt FROM c""")
def generation_requests(spark, d):
    """Requests of many prompts to rows: sizes in steps of the model, and the kept part of the latent mask: frames from 5
    to 11 are to be generated anew, and none lies beyond the 22 of two seconds."""
    rows = _t(spark, d, "conversations").groupBy(F.col("conv_id").alias("id")).agg(F.array_sort(F.collect_list("text")).alias("prompt"))
    rows = rows.select("id", "prompt", F.lit(None).cast("array<string>").alias("negative_prompt"), F.array(F.lit(2.0)).alias("duration"), F.array(F.lit(0.5)).alias("inpaint_starts"), F.array(F.lit(1.0)).alias("inpaint_ends"))
    return K.requests(rows).select("id", "place", "seconds_total", "samples", "latents", F.aggregate("mask", F.lit(0), lambda a, v: a + v).alias("kept"), F.sha2("prompt", 256).alias("prompt"))


@query()
def pca_points(spark, d):
    return G.pca(_t(spark, d, "embeddings"), "embedding").select("vec_id", F.transform("pca", lambda v: F.round(v, 5)).alias("pca"))


@query(f"""
WITH RECURSIVE o AS (SELECT CASE WHEN {_u('0', 'doc_id')} < 0.1 THEN 'val' ELSE 'train' END AS split, doc_id AS grp, (n_chars + 499) // 500 AS n FROM documents),
r AS (SELECT *, row_number() OVER (PARTITION BY split ORDER BY grp) AS k FROM o),
p AS (SELECT split, grp, k, 0::BIGINT AS shard, (n // 40)::BIGINT AS next, (n % 40)::BIGINT AS held FROM r WHERE k = 1
      UNION ALL
      SELECT r.split, r.grp, r.k, p.next + CASE WHEN p.held > 0 AND p.held + r.n > 40 THEN 1 ELSE 0 END,
             p.next + CASE WHEN p.held > 0 AND p.held + r.n > 40 THEN 1 + r.n // 40 ELSE (p.held + r.n) // 40 END,
             CASE WHEN p.held > 0 AND p.held + r.n > 40 THEN r.n % 40 ELSE (p.held + r.n) % 40 END FROM p JOIN r ON r.split = p.split AND r.k = p.k + 1)
SELECT split, grp, shard FROM p""")
def shard_packing(spark, d):
    """Groups to shards in order, as long as there is room."""
    docs = _t(spark, d, "documents").select(D.split("doc_id", 0.1).alias("split"), "doc_id", F.col("doc_id").alias("grp"), A.chunk_count(F.col("n_chars"), 500).alias("size"))
    return W.pack(docs, ["split"], "doc_id", "grp", "size", 40)


_STRIPPED = "regexp_replace(text, '^[\\s]+|[\\s]+$', '', 'g')"


@query(f"""
WITH d AS (SELECT doc_id, text, n_chars, {_u('0.bucket', 'doc_id')} AS u, {_u('0.policy', 'doc_id')} AS v, {_u('0.tempo', 'doc_id')} AS w,
                  CASE WHEN doc_id % 2 = 0 THEN round_even(n_chars % 90 + 60.5, 0)::INTEGER END AS bpm FROM documents),
b AS (SELECT *, CASE WHEN u < 0.30 THEN 'dense' WHEN u < 0.30 + 0.375 THEN 'vivid' ELSE 'one_line' END AS bucket, CASE WHEN v < 0.40 THEN 'keep' WHEN v < 0.40 + 0.30 THEN 'omit' ELSE 'prefix' END AS policy FROM d),
c AS (SELECT *, CASE WHEN bucket <> 'dense' THEN text WHEN policy = 'keep' THEN 'Genre: Folk' || chr(10) || chr(10) || text WHEN policy = 'omit' THEN {_STRIPPED} ELSE regexp_replace('Folk: Indie, Ballad. ' || {_STRIPPED}, '[\\s]+$', '') END AS body FROM b)
SELECT doc_id, bucket, policy, CASE WHEN bpm IS NULL THEN body WHEN bucket = 'one_line' THEN bpm || ' BPM ' || body ELSE bpm || ' BPM. ' || body END AS prompt, coalesce(CASE WHEN w < 0.70 THEN bpm END, -1)::INTEGER AS tempo FROM c""")
def caption_conditions(spark, d):
    """The caption of a record's seeded kind, with its heading kept, left out or put as a prefix, and a tempo."""
    docs = _t(spark, d, "documents").select(
        "doc_id", F.concat(F.lit("Genre: Folk\n\n"), F.col("text")).alias("dense_caption"), F.col("text").alias("vivid_caption"), F.col("text").alias("one_line_caption"),
        F.lit("Folk").alias("genre"), F.lit("Indie, Folk, Ballad").alias("subgenres"), (F.col("n_chars") % 90 + 60.5).alias("bpm"), F.when(F.col("doc_id") % 2 == 0, "yes").otherwise("no").alias("bpm_valid"),
    )
    return R.caption_condition(docs, "doc_id").select("doc_id", "bucket", "policy", "prompt", F.coalesce("tempo", F.lit(-1)).alias("tempo"))


@query("SELECT conv_id::VARCHAR AS key, count(DISTINCT turn)::BIGINT AS n FROM conversations GROUP BY conv_id HAVING count(DISTINCT turn) >= max(turn) + 1")
def stream_barrier(spark, d):
    from ..streaming.etl import barrier_over_table

    return barrier_over_table(spark, f"{d}/conversations.parquet")


@query("SELECT date_trunc('day', ts) AS day, event_type, count(*)::BIGINT AS n FROM events GROUP BY ALL")
def stream_file_source(spark, d):
    from ..streaming.etl import daily_counts_over_table

    out = daily_counts_over_table(spark, f"{d}/events.parquet")
    return out.withColumn("day", F.col("day").cast("timestamp_ntz"))


@query()
def inpaint_masks(spark, d):
    from ..operators.inpaint import random_masks

    return random_masks(_t(spark, d, "documents").select(F.col("doc_id").alias("id"), F.coalesce("n_chars", F.lit(256)).cast("int").alias("n")))


@query("SELECT doc_id AS id, true AS known_kind, coalesce(n_chars, 256)::INTEGER AS length, true AS only_bits, true AS some_hidden, true AS shape FROM documents")
def inpaint_properties(spark, d):
    """What holds for every mask: a known kind, the row's length, bits only, something to generate; a full mask keeps
    nothing, a causal one hides all from its first hidden place on. An empty mask has no hidden place to look at."""
    from ..operators.inpaint import KINDS

    m = inpaint_masks(spark, d)
    kept = F.aggregate("mask", F.lit(0), lambda a, v: a + v)
    first = F.array_position("mask", 0)
    shape = F.when(F.col("kind") == "full", kept == 0).when((F.col("kind") == "causal") & (F.size("mask") > 0), kept == first - 1).otherwise(F.lit(True))
    return m.select("id", F.col("kind").isin(*KINDS).alias("known_kind"), F.size("mask").alias("length"), F.forall("mask", lambda v: v.isin(0, 1)).alias("only_bits"), ((first > 0) | (F.size("mask") == 0)).alias("some_hidden"), shape.alias("shape"))


def _folder(spark, d) -> str:
    """A folder of small files by conversation: clip (PCM), text and JSON sidecars, and names that are never data."""
    from ..sources import scan
    from ..storage import filesystem

    root = scratch(spark, "folder")

    def write(frames):
        for pdf in frames:
            for conv, n, text in zip(pdf["conv_id"], pdf["n"], pdf["text"], strict=True):
                base = f"{root}/set{conv % 2}/clip{conv:05d}"
                files = {f"{base}.WAV": scan.write_wav([[0.5] * int(n)], 8_000), f"{base}.json": b'{"turns": %d}' % n, f"{root}/set{conv % 2}/.clip{conv}.wav": b"", f"{root}/__MACOSX/clip{conv}.wav": b""}
                if conv % 4:
                    files[f"{base}.txt"] = f" {text or ''}\n".encode()
                for path, data in files.items():
                    system, local = filesystem(path)
                    system.create_dir(local.rpartition("/")[0], recursive=True)
                    with system.open_output_stream(local, compression=None) as f:
                        f.write(data)
            yield pd.DataFrame({"conv_id": pdf["conv_id"]})

    first = _t(spark, d, "conversations").groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"), F.min_by("text", "turn").alias("text"))
    first.mapInPandas(write, "conv_id long").write.format("noop").mode("overwrite").save()
    return root


@query("""
WITH c AS (SELECT conv_id, count(*) AS n, arg_min(text, turn) AS text FROM conversations GROUP BY conv_id)
SELECT 'clip' || lpad(conv_id::VARCHAR, 5, '0') AS stem, n::INTEGER AS turns, n::INTEGER AS samples, regexp_replace(text, '^\\s+|\\s+$', '', 'g') AS prompt FROM c WHERE conv_id % 4 <> 0""")
def folder_scan(spark, d):
    """Clips with their text and JSON sidecars; clips without a text are rejected, hidden and foreign files never seen."""
    from ..sources import scan

    root = _folder(spark, d)
    clips = scan.wav(scan.files(spark, root, content=True))
    both = R.sidecar(R.sidecar(clips, scan.captions(spark, root), ["dir", "stem"]), scan.json_sidecars(spark, root, "turns int"), ["dir", "stem"], required=False)
    return both.select("stem", F.col("info.turns").alias("turns"), F.size(F.get("audio.samples", F.lit(0))).alias("samples"), "prompt")


@query("""
SELECT 'even' AS dataset_id, 2.0::DOUBLE AS weight, count(DISTINCT conv_id) FILTER (WHERE conv_id % 2 = 0)::BIGINT AS n FROM conversations
UNION ALL SELECT 'keyed', 1.0, count(DISTINCT conv_id) FILTER (WHERE conv_id % 2 = 1 AND conv_id::VARCHAR LIKE '%7%') FROM conversations""")
def dataset_roots(spark, d):
    """A dataset configuration of two roots, one with keywords, as a union with ids and weights."""
    from ..sources.config import DatasetConfig

    root = _folder(spark, d)
    config = DatasetConfig.parse({"dataset_type": "audio_dir", "datasets": [{"id": "even", "path": f"{root}/set0", "weight": 2.0}, {"id": "keyed", "path": f"{root}/set1", "keywords": ["7"]}], "min_length_sec": 1, "s3_streaming": {"max_attempts": 3}})
    counted = config.frame(spark).groupBy("dataset_id").agg(F.max("weight").alias("weight"), F.count(F.lit(1)).alias("n"))
    ids = spark.createDataFrame([("even", 2.0), ("keyed", 1.0)], "dataset_id string, weight double")
    return ids.join(counted.drop("weight"), "dataset_id", "left").select("dataset_id", "weight", F.coalesce("n", F.lit(0)).alias("n"))


@query(f"""
SELECT format('{{:06d}}{{:04d}}', doc_id // 50, doc_id % 50) AS id, CASE WHEN {_u('0', 'doc_id')} < 0.1 THEN 'val' ELSE 'train' END AS split, n_chars FROM documents""")
def pair_sink(spark, d):
    """Records under ids of batch and place, by split, written and read again; a column that is never kept is dropped."""
    from ..sources import scan, sinks

    path = scratch(spark, "pairs")
    docs = _t(spark, d, "documents").select(F.col("doc_id").alias("index"), D.split("doc_id", 0.1).alias("split"), "n_chars", F.lit(1).alias("primary_genre_hint_id"))
    sinks.write_pairs(docs, path, 50)
    return scan.manifest(spark, path).select("id", "split", "n_chars")


@query("""
WITH x AS (SELECT doc_id, n_chars % 40 + 1 AS n FROM documents)
SELECT doc_id, (1 + n // 8)::INTEGER AS frames, 4::INTEGER AS bands, true AS bounded FROM x""")
def mel_frames(spark, d):
    """Frames and bands of a spectrum with padded ends, and its range of 80 dB."""
    from ..functions.spectral import mel

    n = (F.col("n_chars") % 40 + 1).cast("int")
    wave = F.transform(F.sequence(F.lit(1), n), lambda i: F.sin(i * 0.7))
    m = _t(spark, d, "documents").select("doc_id", mel(wave, 8_000, 16, 4).alias("m"))
    flat = F.flatten("m")
    return m.select("doc_id", F.size(F.get("m", F.lit(0))).alias("frames"), F.size("m").alias("bands"), (F.array_max(flat) - F.array_min(flat) <= 80.0001).alias("bounded"))
