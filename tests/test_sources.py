import io
import json
import math
import tarfile

import numpy as np
import pytest
from pyspark.sql import functions as F
from sparkloom.sources import config, scan, sinks


@pytest.fixture
def folder(tmp_path):
    d = tmp_path / "a"
    (d / "sub").mkdir(parents=True)
    tone = (0.8 * np.sin(np.linspace(0, 2 * math.pi * 44, 800))).tolist()
    for name in ("one.wav", "sub/Two.WAV", "sub/.hidden.wav", "three.txt"):
        (d / name).write_bytes(scan.write_wav([tone, tone], 8000))
    (d / "one.txt").write_text("  a caption \n")
    (d / "bad.wav").write_bytes(b"not audio")
    np.save(d / "lat.npy", np.arange(6, dtype=np.float32).reshape(2, 3))
    np.save(d / "silence.npy", np.zeros((2, 2), np.float32))
    (d / "lat.json").write_text(json.dumps({"seconds_total": 3.5}))
    return str(d)


def test_scan_decode_and_sidecars(spark, folder):
    wavs = scan.files(spark, folder, ("wav",), content=True)
    assert sorted(r["name"] for r in wavs.collect()) == ["Two.WAV", "bad.wav", "one.wav"]
    out = {r["name"]: r for r in scan.wav(wavs).collect()}
    assert out["bad.wav"]["audio"] is None and "Error" in out["bad.wav"]["error"]
    a = out["one.wav"]["audio"]
    assert a["sample_rate"] == 8000 and len(a["samples"]) == 2 and 0.79 < max(a["samples"][0]) <= 0.81
    assert [r["name"] for r in scan.files(spark, folder, keywords=["TWO"]).collect()] == ["Two.WAV"]
    joined = wavs.join(scan.captions(spark, folder), ["dir", "stem"])
    assert [(r["name"], r["prompt"]) for r in joined.collect()] == [("one.wav", "a caption")]
    lat = scan.npy(scan.latents(spark, folder, content=True)).collect()
    assert [r["latent"] for r in lat] == [[[0, 1, 2], [3, 4, 5]]] and lat[0]["json_path"].endswith("/lat.json")
    info = scan.json_sidecars(spark, folder, "seconds_total double").collect()
    assert info[0]["info"]["seconds_total"] == 3.5


def test_config(spark, folder):
    c = config.DatasetConfig.parse({"dataset_type": "audio_dir", "datasets": [{"id": "x", "path": folder, "weight": 2}], "random_crop": True, "random_crop_valid": False})
    rows = c.frame(spark).collect()
    assert len(rows) == 3 and {r["weight"] for r in rows} == {2.0} and c.options_valid["random_crop"] is False
    for bad in ({"dataset_type": "odd"}, {"dataset_type": "wds", "datasets": []}, {"dataset_type": "s3", "datasets": [{"id": "a"}]}):
        with pytest.raises(ValueError):
            config.DatasetConfig.parse(bad)
    with pytest.raises(ValueError):
        config.streaming_options({"idle_timeout_sec": 0})
    with pytest.raises(ValueError):
        config.check_request(["a"], [1.0], 8, 1.0, 0, 1, [1.0], [0.5])


def test_shards_round_trip(spark, tmp_path):
    rows = [("train", f"k{g}_{i}", f"g{g:02d}", {"npy": scan.write_npy([[g, i]]), "json": b"{}"}) for g in range(7) for i in range(g % 4 + 1)]
    df = spark.createDataFrame(rows, "split string, key string, grp string, members map<string,binary>")
    out = sinks.write_shards(df, f"file://{tmp_path}/s", 4).collect()
    assert sum(r["n"] for r in out) == len(rows) and all(r["n"] <= 4 for r in out)
    back = scan.webdataset(spark, f"{tmp_path}/s").collect()
    assert {r["key"]: bytes(r["members"]["npy"]) for r in back} == {k: m["npy"] for _, k, _, m in rows}
    shard = {}
    for r in back:
        shard.setdefault(r["key"].split("_")[0], set()).add(r["url"])
    assert all(len(v) == 1 for v in shard.values())


def test_state_errors_and_tensors(spark, tmp_path):
    path = f"{tmp_path}/st"
    assert sinks.load_state(spark, path).count() == 0
    s = spark.createDataFrame([("train", 3, ["a"])], "split string, next_idx long, completed array<string>")
    sinks.save_state(s, path)
    sinks.save_state(s.withColumn("next_idx", F.lit(5).cast("long")), path)
    assert sinks.load_state(spark, path).first()["next_idx"] == 5
    left = sinks.dead_letters(spark.createDataFrame([(1, None), (2, "x")], "k int, error string"), f"{tmp_path}/err")
    assert [r["k"] for r in left.collect()] == [1] and spark.read.json(f"{tmp_path}/err").count() == 1
    (tmp_path / "m.safetensors").write_bytes(scan.write_tensors({"a.w": np.ones((2, 2)), "b.w": np.zeros(3)}, {"rank": "4"}))
    got = scan.tensors(spark.read.format("binaryFile").load(f"{tmp_path}/m.safetensors"), "a.").collect()
    assert [(r["name"], r["shape"], r["values"], r["metadata"]["rank"]) for r in got] == [("a.w", [2, 2], [1.0] * 4, "4")]
    buf = io.BytesIO()
    with tarfile.open(fileobj=buf, mode="w") as t:
        i = tarfile.TarInfo("x.txt")
        i.size = 2
        t.addfile(i, io.BytesIO(b"hi"))
    scan.untar_udtf(spark)
    spark.createDataFrame([(buf.getvalue(),)], "content binary").createOrReplaceTempView("tars")
    assert [(r["key"], bytes(r["data"])) for r in spark.sql("select u.* from tars, lateral untar(content) u").collect()] == [("x", b"hi")]


def test_urls_tokens_and_frames(spark):
    names = spark.createDataFrame([("ds",)], "name string")
    listing = spark.createDataFrame([("ds", "2024-01-01 10:00:00   12 sub/a.tar"), ("ds", "2024-01-01 10:00:00  1 b.txt"), ("ds", "2024-01-01 10:00:00  0 dir/")], "name string, line string")
    assert [r["url"] for r in scan.object_urls(names, ["sub"], listing, "s3://b").collect()] == ["s3://b/ds/sub/a.tar"]
    t = spark.createDataFrame([("ab",), ("",), ("abcdef",)], "s string").select(scan.tokenized(F.col("s"), 4).alias("t")).collect()
    assert [(r["t"]["ids"], r["t"]["mask"]) for r in t] == [([97, 98, 0, 0], [1, 1, 0, 0]), ([0] * 4, [0] * 4), ([97, 98, 99, 100], [1] * 4)]
    raw = np.array([0.5, -0.5, 0.25, 0.75], "<f4").tobytes()
    f = scan.pcm_frames(spark.createDataFrame([(1, raw), (2, raw[:-1])], "i int, content binary"), 2).orderBy("i").collect()
    assert f[0]["samples"] == [[0.5, 0.25], [-0.5, 0.75]] and "whole frames" in f[1]["error"]
