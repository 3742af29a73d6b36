import math
import re
import zlib

import numpy as np
import pytest
from conftest import DATA
from sparkloom.llm import quality as Q


def test_statistics_do_not_depend_on_the_batch():
    texts = [b"", b"\n", b"One two two.\nTWO!!", b"a", "é ü".encode(), b"x" * 5000, b" \n \n", b"###aa### | b&&&"]
    whole = Q.statistics(texts)
    assert np.isfinite(whole).all() and whole.shape == (len(texts), len(Q.NAMES))
    for k, t in enumerate(texts):
        assert np.allclose(whole[k], Q.statistics([t])[0])


def test_density_against_direct_formula():
    rng = np.random.default_rng(0)
    x = [rng.normal(size=(300, 4)), rng.normal(1.0, 2.0, size=(200, 4))]
    sums = {k: (len(v), v.sum(0), v.T @ v) for k, v in enumerate(x)}
    m = Q.Discriminant.fit(sums, 4, 0.0, 0.0)

    def log_density(v, k):
        cov = np.cov(x[k].T, bias=True)
        d = v - x[k].mean(0)
        return -0.5 * np.einsum("ij,jk,ik->i", d, np.linalg.inv(cov), d) - 0.5 * np.linalg.slogdet(cov)[1] + np.log(len(x[k]))

    v = np.concatenate(x)
    assert np.allclose(m.score(v), 1 / (1 + np.exp(log_density(v, 0) - log_density(v, 1))))


def test_missing_classes_and_odd_rows(spark):
    docs = spark.createDataFrame([(1, "a b", 0.5), (2, None, 0.1), (None, "x", 0.0), (2, "", 1.0)], "doc_id long, text string, score double")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r["score"] for r in Q.classify(docs, none).collect()} == {0.5}
    one = spark.createDataFrame([(1, 1, 0), (1, 1, 0), (None, 0, 0), (2, None, 0), (9, 0, 0)], "doc_id long, quality int, toxic int")
    out = Q.classify(docs, one).collect()
    assert len(out) == 4 and {r["score"] for r in out} == {1.0} and {r["predicted"] for r in out} == {1}
    assert Q.classify(docs.limit(0), one).collect() == []


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{DATA}/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    got = {r["doc_id"]: r for r in Q.classify(docs, labels).collect()}
    assert len(got) == docs.count()
    assert all(r["held_out"] == (zlib.crc32(str(d).encode()) % 5 == 0) for d, r in got.items())
    known = [(r["quality"], got[r["doc_id"]]) for r in labels.collect() if got[r["doc_id"]]["held_out"]]
    right = np.mean([q == r["predicted"] for q, r in known])
    assert right >= 0.93, right
    good, bad = ([r["score"] for q, r in known if q == k] for k in (1, 0))
    assert np.mean([g > b for g in good for b in bad]) == pytest.approx(1.0, abs=0.05)


def plain_statistics(text):
    """One document's statistics, byte by byte."""
    b = (text or "").encode()
    kind = lambda c: next((k for k, members in enumerate(Q._CLASSES) if c in members), 10 if c < 128 else 11)
    kinds = [kind(c) for c in b]
    words = re.findall(rb"[^ \t\r\x0b\x0c\n]+", b)
    share = lambda hits, of: math.log((hits + 0.5) / (of + 1))
    lines = b.split(b"\n")
    return [
        *[share(kinds.count(k), len(b)) for k in range(12)], math.log(len(b) + 1), math.log((len(b) + 1) / (len(words) + 1)), math.log((len(words) + 1) / len(lines)),
        share(len(set(words)), len(words)), share(len(set(lines)), len(lines)), share(sum(x == y and 5 <= k <= 10 for x, y, k in zip(b[1:], b, kinds[1:], strict=False)), len(b)),
        share(sum(len(w) > 1 and 65 <= w[1] <= 90 for w in words), len(words)), share(sum(w[-1] in b"#$%&*@~^" for w in words), len(words)),
    ]


def test_query_against_brute_force(spark):
    """Every row of the query by loops over bytes and by densities from determinants and inverses."""
    from sparkloom.llm.queries import op3_quality

    sf = f"{DATA}/sf0.01"
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    labels = [(r["doc_id"], r["quality"]) for r in spark.read.parquet(f"{sf}/labels.parquet").collect()]
    out = {d: zlib.crc32(str(d).encode()) % 5 == 0 for d in docs}
    x = {d: np.array(plain_statistics(t)) for d, t in docs.items()}
    known = [(x[d], y) for d, y in labels if d in x and not out[d]]
    every = np.array([v for v, _ in known])
    shift, scale = every.mean(0), every.std(0)
    z = lambda v: (v - shift) / scale
    of = {k: np.array([z(v) for v, y in known if y == k]) for k in (0, 1)}
    cov = {k: np.cov(v.T, bias=True) for k, v in of.items()}
    both = sum(len(of[k]) * cov[k] for k in (0, 1)) / len(known)
    dens = {}
    for k in (0, 1):
        s = (1 - Q.POOLED) * cov[k] + Q.POOLED * both
        s = (1 - Q.IDENTITY) * s + Q.IDENTITY * max(np.trace(s) / len(s), 1e-3) * np.eye(len(s))
        dens[k] = (of[k].mean(0), np.linalg.inv(s), np.linalg.slogdet(s)[1], math.log(len(of[k])))
    got = {r["doc_id"]: r for r in op3_quality(spark, sf).collect()}
    assert got.keys() == docs.keys()
    for d, r in got.items():
        log = {k: -0.5 * ((z(x[d]) - m) @ i @ (z(x[d]) - m)) - 0.5 * det + prior for k, (m, i, det, prior) in dens.items()}
        want = 1 / (1 + math.exp(-min(max(log[1] - log[0], -700), 700)))
        assert abs(r["score"] - want) < 1e-6 and r["held_out"] == out[d] and r["predicted"] == int(r["score"] >= 0.3)


def test_statistics_do_not_depend_on_stretches(monkeypatch):
    rng = np.random.default_rng(3)
    texts = ["".join(rng.choice(list("abcAB,.!#|( \né "), rng.integers(0, 400))).encode() for _ in range(40)] + [b"", b"word " * 500 + b"end##"]
    want = Q.statistics(texts)
    assert np.allclose(want, [plain_statistics(t.decode()) for t in texts])
    monkeypatch.setattr(Q, "STRETCH", 64)
    assert np.allclose(Q.statistics(texts), want)
