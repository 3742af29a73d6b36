import hashlib
import math
import random
import re
import time

import numpy as np
import pandas as pd
import pytest
from conftest import DATA
from pyspark.sql import functions as F
from sparkloom.functions import arrays as A
from sparkloom.functions import draws as D
from sparkloom.functions import schedules as S
from sparkloom.functions import spectral
from sparkloom.functions import text as T
from sparkloom.operators import aggregates as G
from sparkloom.operators import inpaint, lowrank, samplers
from sparkloom.operators import records as R
from sparkloom.operators import windows as W


def one(spark, expr):
    return spark.range(1).select(expr.alias("v")).first()["v"]


def test_bucketed_mean_fixture(spark):
    """Invalid positions hold 1e6, as poison."""
    rows = [(s, v if t < n else 1e6, t < n) for s, n, v in ((0.05, 8, 1.0), (0.15, 6, 2.0), (0.17, 4, 4.0), (0.95, 5, 8.0)) for t in range(8) for _ in range(2)]
    df = spark.createDataFrame(rows, "sigma double, v double, ok boolean")
    got = {r["bucket"]: r["mean"] for r in G.bucketed_mean(df, F.col("sigma"), F.col("v"), F.col("ok")).collect()}
    assert got[0] == 1 and got[1] == pytest.approx(2.8) and got[9] == 8 and got[5] is None and len(got) == 10


def test_ema_decay_fixture(spark):
    d = lambda k: one(spark, S.ema_decay(F.lit(k), 0.9995, 0.75, 1.0))
    assert d(0) == 0 and d(1) == pytest.approx(1 - 2**-0.75) and d(100) == pytest.approx(1 - 101**-0.75) and d(1e9) == 0.9995


@pytest.mark.parametrize("n,c,o", [(1, 5, 2), (5, 5, 2), (17, 5, 2), (40, 8, 4), (41, 8, 4), (23, 10, 6)])
def test_stitch_is_identity(spark, n, c, o):
    text = "".join(random.Random(n).choices("abcdefghij", k=n))
    df = spark.createDataFrame([(1, text)], "k int, s string")
    assert W.stitch(df, "k", "s", c, o).first()["stitched"] == text


def test_masks_arrays_and_silence(spark):
    arr = lambda v: F.array(*[F.lit(float(x)) for x in v])
    assert one(spark, A.prefix_mask(F.lit(2), 4)) == [1, 1, 0, 0]
    assert one(spark, A.nearest(arr(range(6)), 3)) == [0, 2, 4]
    assert one(spark, A.tile_pad(arr([1, 2]), 6, arr([7, 8, 9]))) == [1, 2, 7, 8, 9, 7]
    assert one(spark, A.tile_pad(arr([1, 2]), 4, F.array().cast("array<double>"))) == [1, 2, 0, 0]
    assert one(spark, A.align_left(arr([1, 2, 3]), 2)) == [2, 3] and one(spark, A.align_left(arr([1]), 3)) == [0, 0, 1]
    assert one(spark, A.is_silent(arr([0, 0]))) and not one(spark, A.is_silent(arr([0.5, 0])))
    assert one(spark, A.active_length(arr([0.5] * 8 + [0] * 20), 8)) == 8
    assert one(spark, A.active_length(arr([0] * 16), 8)) == 0 and one(spark, A.active_length(arr([0] * 3), 8)) == 3
    assert one(spark, A.repeat_each(F.array(F.lit(1), F.lit(0)), 2)) == [1, 1, 0, 0]
    assert one(spark, A.to_channels(F.array(arr([1, 3]), arr([3, 5])), 1)) == [[2, 4]]
    assert one(spark, A.pcm16(arr([2, -0.5]))) == [32767, -16383]
    assert max(one(spark, A.gain(arr([0.5, -0.9]), F.lit(20.0)))) <= 0.95


def test_projection_and_guidance(spark):
    rng = np.random.default_rng(0)
    a, b, x = rng.normal(size=(3, 8))
    arr = lambda v: F.array(*[F.lit(float(q)) for q in v])
    p = one(spark, A.project(arr(a), arr(b)))
    u = b / np.linalg.norm(b)
    assert np.allclose(p["parallel"], (a @ u) * u) and np.allclose(np.add(p["parallel"], p["orthogonal"]), a)
    got = one(spark, A.guide(arr(x), arr(a), arr(b), F.lit(0.7), 4.0, 0.5, 1.0))
    c, d = x - 0.7 * a, x - 0.7 * b
    diff = (c - d) * min(1, 1.0 / np.linalg.norm(c - d))
    v = c / np.linalg.norm(c)
    diff = 0.5 * (diff - (diff @ v) * v) + 0.5 * diff
    assert np.allclose(got, (x - (c + 3 * diff)) / 0.7)


def _plain_heading(x):
    """The rule of strip_heading by loops over lines."""
    lines = x.splitlines()
    first = next((i for i, v in enumerate(lines) if v.strip()), None)
    if first is None:
        return x
    if not re.match(r"\s*Genre\s*:", lines[first], re.I):
        return x.strip()
    end = first + 1
    while end < len(lines) and re.match(r"\s*Sub[- ]?genres?\s*:", lines[end], re.I):
        end += 1
    return "\n".join(lines[end:]).strip()


def test_headings_of_odd_texts_by_brute_force(spark):
    rng = random.Random(1)
    odd = [chr(c) for c in range(0x3001) if chr(c).isspace()]
    parts = ["Genre:", "genre :", "GENRE\u2003:", "Sub-genres:", "subgenre\xa0: a", "Sub genre :", "Subs:", "Deep, Acid", "é", "\U0001f600", "\r\n", "\n", "\n", " ", ":", "", *odd]
    texts = [f"{a}{b}" for a in ("x", "", "Genre: y\nz") for b in odd] + [f"{b}{a}{b}{a}" for a in ("x", "Genre: y\nz") for b in odd]
    texts += ["".join(rng.choices(parts, k=rng.randint(0, 12))) for _ in range(3000)]
    texts += ["\n Genre: h" + "".join(rng.choices(parts, k=rng.randint(0, 12))) for _ in range(3000)]
    rows = spark.createDataFrame([(x,) for x in [None, *texts]], "x string").select("x", T.strip_heading(F.col("x")).alias("h"), T.strip(F.col("x")).alias("s")).collect()
    assert rows[0]["h"] is None and rows[0]["s"] is None and len(rows) == len(texts) + 1
    assert [(r["h"], r["s"]) for r in rows[1:]] == [(_plain_heading(x), x.strip()) for x in texts]


def test_headings_of_long_texts_take_linear_time(spark):
    """A run of spaces, many short lines and many lines of a heading, a few MB each: seconds where it took minutes."""
    body = "a" + " " * 300_000 + "b\n" + "word\n" * 1_000_000 + "end"
    texts = [f"\nGenre: x\n{body}\n", f" {body} ", "Genre: x\n" + "Sub-genre: y\n" * 200_000 + "end", " " * 1_000_000]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, x string").select("i", F.md5(T.strip_heading(F.col("x"))).alias("h"))
    df.filter("i = 3").collect()
    began = time.monotonic()
    got = {r["i"]: r["h"] for r in df.collect()}
    assert time.monotonic() - began < 30
    assert got == {i: hashlib.md5(x.encode()).hexdigest() for i, x in enumerate([body, body, "end", texts[3]])}


def test_text_functions(spark):
    t = lambda f, s: one(spark, f(F.lit(s)))
    assert t(T.strip_heading, "\n genre: X\nSub-Genres: a\nSubgenre: b\n\nBody\n") == "Body" and t(T.strip_heading, " plain \n") == "plain" and t(T.strip_heading, "Genre: only") == ""
    assert t(T.strip_heading, "Genre: X\nBody") == "Body"
    assert t(T.tempo, "120.5") == 120 and t(T.tempo, "121.5") == 122 and t(T.tempo, "nan") is None and t(T.tempo, "fast") is None
    assert t(T.safe_part, " a/b ü?c ") == "a_b_ü_c" and t(T.safe_part, " ") == "item"
    assert t(T.has_artifacts, "Calm piano. Length: 30 seconds.") is False and t(T.has_artifacts, "Female voice. Length: 3 seconds") is True
    assert t(T.tidy_prompt, "x</think> - soft pads. warm bass") == "Soft pads. Warm bass"
    assert t(T.slug, "  Héllo, World! ") == "h_llo_world" and t(T.condense, 'a/b:"c"') == "a-b--c-" and t(T.condense, "") == "_"
    assert [one(spark, T.duration(F.lit(s))) for s in (3, 123, 3723)] == ["3s", "2m03s", "1h02m03s"]
    assert t(T.truthy, " YES ") is True and t(T.null_condition, "NaN") is True and t(T.null_condition, "0") is False
    assert t(T.stated_seconds, "x. Length: 45 seconds.") == 45 and t(T.track_kind, "TrackType: SFX") == "sfx"
    assert t(T.row_base, "clip_1_003") == "clip_1" and t(lambda c: T.named_number(c, "rtf"), "\x1b[1mRTF: 3.5x") == 3.5


def test_draws(spark):
    df = spark.range(4000).select("id", D.uniform("id", "a").alias("u"), D.uniform("id", "b").alias("w"), D.normal("id").alias("z"), D.split("id", 0.2).alias("s"), D.timestep("id", "log_snr").alias("t"))
    p = df.toPandas()
    assert abs(p.u.mean() - 0.5) < 0.02 and abs(p.z.std() - 1) < 0.05 and abs((p.s == "val").mean() - 0.2) < 0.03 and abs(np.corrcoef(p.u, p.w)[0, 1]) < 0.05
    assert p.t.between(1e-4, 1 - 1e-4).all()
    assert df.repartition(7).orderBy("id").toPandas().equals(df.orderBy("id").toPandas())
    assert [one(spark, D.radical_inverse(F.lit(k))) for k in range(4)] == [0, 0.5, 0.25, 0.75]
    base = spark.range(50).withColumn("bad", F.col("id") % 5 == 0)
    again = R.on_reject(base, "id", F.col("bad"), "resample").collect()
    assert sorted(r["id"] for r in again) == list(range(50)) and all(r["source_key"] % 5 for r in again)
    assert R.on_reject(base, "id", F.col("bad")).count() == 40


def test_packing(spark):
    rows = [("a", i, f"g{i}", n) for i, n in enumerate([2, 2, 1, 4, 1, 9, 1])]
    df = spark.createDataFrame(rows, "split string, o int, grp string, size int")
    got = {r["grp"]: r["shard"] for r in W.pack(df, ["split"], "o", "grp", "size", 4).collect()}
    assert (got["g0"], got["g1"], got["g2"], got["g3"], got["g4"]) == (0, 0, 1, 2, 3) and got["g5"] > got["g4"] and got["g6"] >= got["g5"]


def test_samplers_reach_the_flow(spark):
    """dx/dt = x / (1 + t) has the solution x (1 + t) / 2 from t = 1."""
    x, t = np.array([[1.0, -2.0]]), np.linspace(1, 0, 65)[None]
    for name, tol in (("euler", 2e-2), ("rk4", 1e-4), ("dpmpp", 2e-2)):
        assert np.allclose(samplers.SAMPLERS[name](samplers.toy_model, x, t), x / 2, atol=tol), name
    df = spark.createDataFrame([(1, [1.0, 2.0], [1.0, 0.5, 0.0]), (2, [1.0], [1.0, 0.0])], "id long, x array<double>, t array<double>")
    a = {r["id"]: r["x"] for r in samplers.sample(df, "pingpong").collect()}
    b = {r["id"]: r["x"] for r in samplers.sample(df.repartition(2), "pingpong").collect()}
    assert a == b and len(a[1]) == 2
    cost = np.array([[0.0, 1, 2], [1, 0, 2], [2, 2, 0.1]])
    assert samplers.couple(cost).tolist() == [0, 1, 2]


def test_low_rank_and_pca(spark):
    rng = np.random.default_rng(1)
    w = rng.normal(size=(6, 4))
    t = spark.createDataFrame([("w", 6, 4, w.ravel().tolist())], "name string, rows int, cols int, values array<double>")
    r = lowrank.svd_bases(t, 4).first()
    u, v = np.array(r["up"]).reshape(6, 4), np.array(r["down"]).reshape(4, 4)
    assert np.allclose(u @ u.T @ w, w) and np.allclose(v @ v.T, np.eye(4)) and all(u[np.abs(u[:, k]).argmax(), k] > 0 for k in range(4))
    long = spark.createDataFrame([(i, j, float(w[i, j])) for i in range(6) for j in range(4)], "r int, c int, v double")
    mag = spark.createDataFrame([(i, float(i + 1)) for i in range(6)], "r int, norm double")
    d = lowrank.dora(long, long.withColumn("v", F.lit(0.0)), mag)
    assert all(abs(x["norm"] - (x["r"] + 1)) < 1e-9 for x in lowrank.norms(d, "r").collect())
    x = rng.normal(size=(200, 5)) * [5, 3, 1, 0.1, 0.1]
    p = G.pca(spark.createDataFrame([(v.tolist(),) for v in x], "e array<double>"), "e", 2).toPandas()
    got = np.array(p["pca"].tolist())
    vec = np.linalg.eigh(np.cov(x.T))[1][:, ::-1][:, :2]
    assert np.allclose(np.abs(got), np.abs(x @ vec))


def test_masks_for_inpainting_and_mel(spark):
    df = spark.createDataFrame([(i, n) for i, n in enumerate([0, 1, 2, 5, 64, 200] * 20)], "id long, n int")
    rows = inpaint.random_masks(df).collect()
    assert {r["kind"] for r in rows} == set(inpaint.KINDS)
    assert all(set(r["mask"]) <= {0, 1} and (not r["mask"] or 0 in r["mask"]) for r in rows)
    tone = np.sin(2 * math.pi * 1000 * np.arange(8000) / 8000)
    m = spectral.mel_spectrogram(tone, 8000, 512, 32)
    peak = m[:, 5].argmax()
    centre = 700 * (10 ** (np.linspace(0, 2595 * np.log10(1 + 4000 / 700), 34)[peak + 1] / 2595) - 1)
    assert abs(centre - 1000) < 150 and m.max() - m.min() <= 80 + 1e-9
    assert len(spark.createDataFrame([(tone.tolist(),)], "x array<double>").select(spectral.mel(F.col("x"), 8000, 512, 32).alias("m")).first()["m"]) == 32


def test_records(spark):
    df = spark.createDataFrame([("r/a/x.wav",), ("r/ab/y.wav",), ("q/z",)], "path string")
    roots = spark.createDataFrame([("r", 2, 0.5), ("r/a", 1, 0.1)], "root string, priority int, w double")
    got = {r["path"]: (r["root"], r["w"]) for r in R.root_match(df, "path", roots).collect()}
    assert got == {"r/a/x.wav": ("r/a", 0.1), "r/ab/y.wav": ("r", 0.5), "q/z": (None, None)}
    assert R.root_match(df, "path", roots, first=False).count() == 3
    saved = spark.createDataFrame([("m.pre.a", [1], [1.0]), ("b", [2], [1.0, 2.0])], "name string, shape array<int>, values array<double>")
    model = spark.createDataFrame([("m.a", [1]), ("b", [2]), ("c", [1])], "name string, shape array<int>")
    assert {(r["name"], r["source"]) for r in R.remap_names(model, saved).collect()} == {("m.a", "m.pre.a"), ("b", "b")}
    hit, miss = R.match_tensors(model, saved)
    assert [r["name"] for r in hit.collect()] == ["b"] and sorted(r["name"] for r in miss.collect()) == ["c", "m.a"]
    s = spark.createDataFrame([("train", 3, ["a", "b"])], "split string, next_idx long, completed array<string>")
    t = spark.createDataFrame([("train", 5, ["b", "c"]), ("val", 1, ["z"])], "split string, next_idx long, completed array<string>")
    assert {(r["split"], r["next_idx"], tuple(r["completed"])) for r in R.merge_state(s, t).collect()} == {("train", 5, ("a", "b", "c")), ("val", 1, ("z",))}
    with pytest.raises(ValueError):
        R.broadcast_to_batch(["a", "b"], [1.0])
    assert R.broadcast_to_batch(["a", "b"], 2.0) == [("a", 2.0), ("b", 2.0)]
    one_row = spark.createDataFrame([(float("nan"), None, "x")], "a double, b int, c string")
    assert one_row.select(R.clean_row(one_row, ["c"]).alias("j")).first()["j"] == '{"a":null,"b":null}'


def test_streams(spark, tmp_path):
    from sparkloom.streaming import etl

    src = str(tmp_path / "in")
    rows = [("a", 0, None), ("a", None, 2), ("b", 0, None), ("b", 1, None)]
    schema = "key string, chunk_idx int, expected int"
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(src)
    spark.createDataFrame([("a", 1, None), ("a", 1, None), ("b", None, 3)], schema).coalesce(1).write.mode("append").parquet(src)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
    out = etl.run_once(etl.barrier_stream(stream), "t").collect()
    assert [(r["key"], r["n"]) for r in out] == [("a", 2)]

    timed = spark.readStream.schema(schema).parquet(src).withColumn("ts", F.timestamp_seconds(F.coalesce("chunk_idx", F.lit(0)) * 3600 + 1_000_000)).withWatermark("ts", "1 hour")
    assert etl.run_once(etl.barrier_stream(timed, forget_ms=60_000), "u").collect() == out

    def encode(pdf: pd.DataFrame) -> pd.DataFrame:
        if pdf.iloc[0]["key"] == "b":
            raise ValueError("no")
        return pd.DataFrame({"key": pdf["key"], "y": pdf["chunk_idx"].fillna(-1).astype("int64")})

    path = str(tmp_path / "out")
    etl.encode_stream(spark.readStream.schema(schema).parquet(src), encode, "key string, y long", path).awaitTermination()
    assert spark.read.parquet(f"{path}/data").count() == 4 and spark.read.json(f"{path}/errors").count() == 3

    def strict(pdf: pd.DataFrame) -> pd.DataFrame:
        if (pdf["key"] == "b").any():
            raise ValueError("no")
        return pd.DataFrame({"key": pdf["key"], "y": pdf["chunk_idx"].fillna(-1).astype("int64")})

    path = str(tmp_path / "batched")
    etl.encode_stream(spark.readStream.schema(schema).parquet(src), strict, "key string, y long", path, batched=True).awaitTermination()
    assert spark.read.parquet(f"{path}/data").count() == 4 and spark.read.json(f"{path}/errors").count() == 3


def test_encode_plan(spark):
    from sparkloom.plans import encode

    rows = [("id 1", "s3://b/x/clip1.wav", 2.0, None, "d", None, " ", "120.0", 2500), (None, "s3://b/clip2.flac", None, 900.0, None, "v", None, None, 1000), ("done", "s3://b/c.wav", 1.0, None, "d", None, None, None, 10)]
    m = spark.createDataFrame(rows, "sample_id string, audio_s3_uri string, duration_sec double, duration_ms double, dense_caption string, vivid_caption string, one_line_caption string, tempo string, n long")
    done = spark.createDataFrame([("done", "done")], "key string, status string")
    out = encode.plan_chunks(m, done, "n", 1000, 1000, 0.0).orderBy("row_base", "chunk_idx").collect()
    assert [(r["row_base"], r["chunk_idx"], r["valid"], r["prompt"], r["tempo"]) for r in out] == [("clip2", 0, 1000, "v", None), ("id_1", 0, 1000, "d", 120), ("id_1", 1, 1000, "d", 120), ("id_1", 2, 500, "d", 120)]
    encoded = spark.createDataFrame(out).filter("not (row_base = 'id_1' and chunk_idx = 1)")
    assert [r["row_base"] for r in encode.completed(encoded).collect()] == ["clip2"]


def test_conditioning_and_requests(spark):
    from sparkloom.operators import conditioning as K

    bag = F.create_map(F.lit("text"), F.struct(F.array(F.lit(1.0), F.lit(2.0)).alias("emb"), F.array(F.lit(1), F.lit(0)).alias("mask")), F.lit("negative_text"), F.struct(F.array(F.lit(9.0)).alias("emb"), F.array(F.lit(1)).alias("mask")), F.lit("sec"), F.struct(F.array(F.lit(5.0)).alias("emb"), F.array(F.lit(1)).alias("mask")))
    got = one(spark, K.assemble(bag, cross=["text", "sec"], glob=["sec"], local=["sec"]))
    assert got["cross"] == [1, 2, 5] and got["cross_mask"] == [1, 0, 1] and got["global"] == [5] and got["local"]["sec"] == [5]
    assert one(spark, K.assemble(bag, cross=["text", "sec"], negative=True))["cross"] == [9, 5]
    df = spark.createDataFrame([(1, ["a", "b"], None, [1.0, 2.0], [0.5], [1.0]), (2, ["c"], ["n"], [3.0], None, None)], "id long, prompt array<string>, negative_prompt array<string>, duration array<double>, inpaint_starts array<double>, inpaint_ends array<double>")
    rows = {(r["id"], r["place"]): r for r in K.requests(df, rate=100, ratio=10, most=1000).collect()}
    assert rows[1, 0]["samples"] == 200 and rows[1, 0]["latents"] == 20 and sum(rows[1, 0]["mask"]) == 5 and sum(rows[1, 1]["mask"]) == 15
    assert rows[2, 0]["negative_prompt"] == "n" and sum(rows[2, 0]["mask"]) == 30
    with pytest.raises(Exception, match="differ in number"):
        K.requests(df.withColumn("duration", F.array(F.lit(1.0), F.lit(1.0), F.lit(1.0)))).collect()
    t = spark.createDataFrame([(1, [[1.0, 2.0], [3.0, 4.0]], "x")], "k int, e array<array<double>>, l string")
    assert [tuple(r) for r in K.embedding_table(t, "k", "e", "l").orderBy("frame").collect()] == [(1, 0, "x", 1.0, 3.0), (1, 1, "x", 2.0, 4.0)]
    u = spark.range(3000).select(D.truncated_logistic("id").alias("t")).toPandas().t
    assert 0 <= u.min() and u.max() < 1 and 0.3 < u.mean() < 0.6


def test_more_low_rank(spark):
    f = lambda m, r, c: spark.createDataFrame([(i, j, float(m[i][j])) for i in range(len(m)) for j in range(len(m[0]))], f"{r} int, {c} int, v double")
    a, b, c = np.arange(6.0).reshape(3, 2), np.array([[1.0, 2], [0, 1]]), np.arange(8.0).reshape(2, 4)
    got = {(r["r"], r["c"]): r["v"] for r in lowrank.core_product(f(a, "r", "k"), f(b, "k", "c"), f(c, "k", "c"), 2.0).collect()}
    want = 2 * a @ b @ c
    assert all(got[i, j] == want[i, j] for i in range(3) for j in range(4))
    ad = spark.createDataFrame([("x", "w", 1.0, 0, 0, 2.0), ("y", "w", 1.0, 0, 0, 3.0)], "adapter string, name string, weight double, r int, c int, v double")
    assert lowrank.merge(lowrank.set_strength(ad, {"y": 0.5})).first()["v"] == 3.5
    assert lowrank.select_adapters(ad, remove=["x"]).count() == 1 and lowrank.adapter_count(ad).first()[0] == 2


def test_stream_end_check(spark):
    from sparkloom.streaming import etl

    m = spark.createDataFrame([("a", 0, 1), ("b", 0, None)], "key string, chunk_idx int, expected int")
    assert [r["key"] for r in etl.unresolved(m).collect()] == ["b"]
    with pytest.raises(RuntimeError):
        etl.assert_resolved(m)
    etl.assert_resolved(m.filter("key = 'a'"))


@pytest.mark.parametrize(("name", "key"), [("documents", "doc_id"), ("lineitem", "l_orderkey"), ("orders", "o_orderpriority")])
def test_numbers_are_dense_over_many_partitions(spark, name, key):
    df = spark.read.parquet(f"{DATA}/sf0.1/{name}.parquet").repartition(4)
    n = df.count()
    got = D.numbered(df, key).agg(F.count(F.lit(1)), F.count_distinct("__n"), F.min("__n"), F.max("__n")).first()
    assert tuple(got) == (n, n, 0, n - 1)
    w = D.numbered(df, key).select("__n", key).orderBy("__n").select(key).toPandas()[key]
    assert w.is_monotonic_increasing


def test_numbers_of_odd_tables(spark):
    rows = [(None, 1), (None, 1), ("a", None), ("b", 2), ("b", 2), ("b", 3)]
    df = spark.createDataFrame(rows, "k string, v int")
    got = D.numbered(df, "k").orderBy("__n").collect()
    assert [r["__n"] for r in got] == list(range(6)) and [r["k"] for r in got] == [None, None, "a", "b", "b", "b"]
    assert D.numbered(df.limit(0), "k").collect() == []
    ends = sorted(r["end"] for r in W.cumulative(df, "k", F.col("v")).collect())
    assert ends[-1] == 9


def test_running_sums_against_a_window(spark):
    df = spark.read.parquet(f"{DATA}/sf0.1/orders.parquet").repartition(4)
    got = W.cumulative(df, "o_orderkey", F.col("o_custkey")).agg(F.sum("end").cast("string"), F.max("end")).first()
    total, acc = 0, 0
    for (v,) in df.orderBy("o_orderkey").select("o_custkey").toPandas().itertuples(index=False):
        acc += v
        total += acc
    assert (int(got[0]), got[1]) == (total, acc)


def test_coupling_callback_and_nested_update(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(6, 3))
    cost = np.square(x[:, None] - x[None, ::-1]).sum(2)
    assert samplers.couple(cost).tolist() == [5, 4, 3, 2, 1, 0]
    rows = [(b, k, x[k].tolist(), x[5 - k].tolist()) for b in (0, 1) for k in range(6)]
    got = samplers.couple_batches(spark.createDataFrame(rows, "batch int, key int, x array<double>, z array<double>"), "batch", "key", "x", "z").collect()
    assert len(got) == 12 and all(np.allclose(r["z"], x[r["key"]]) for r in got)
    seen = []
    look = samplers._watched(samplers.toy_model, seen.append)
    t = np.linspace(1, 0, 5)[None].repeat(2, 0)
    samplers.euler(look, x[:2], t)
    assert [s["i"] for s in seen] == [0, 1, 2, 3] and np.allclose(seen[1]["denoised"], seen[1]["x"] - 0.75 * samplers.toy_model(seen[1]["x"], seen[1]["t"]))
    base = {"a": {"b": 1, "c": [1]}, "d": 2}
    out = T.nested_update(base, {"a": {"b": 5}, "e": {"f": 1}})
    assert out == {"a": {"b": 5, "c": [1]}, "d": 2, "e": {"f": 1}} and base == {"a": {"b": 1, "c": [1]}, "d": 2} and out["a"]["c"] is not base["a"]["c"]


def test_resampled_stream_and_telemetry(spark, tmp_path):
    from sparkloom.streaming import etl

    df = spark.range(50).withColumn("v", F.col("id") * 2)
    watch = etl.Telemetry(0.0)
    spark.streams.addListener(watch)
    stream = etl.resampled_stream(df, "id", 200)
    q = stream.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/log").start()
    import time

    for _ in range(60):
        time.sleep(0.5)
        if q.lastProgress and any(p["numInputRows"] > 0 for p in q.recentProgress):
            break
    q.stop()
    rows = spark.read.parquet(f"{tmp_path}/out").collect()
    want = {r["draw"]: r["id"] for r in D.resample(df, "id", 500).collect()}
    assert rows and all(r["v"] == 2 * r["id"] and r["epoch"] == r["draw"] // 50 and want.get(r["draw"], r["id"]) == r["id"] for r in rows)
    for _ in range(20):
        if watch.last.get(str(q.id), {}).get("state") == "ended":
            break
        time.sleep(0.5)
    spark.streams.removeListener(watch)
    assert watch.last[str(q.id)]["state"] == "ended"
