import random
import re

import numpy as np
import pytest
import xxhash
from conftest import DATA
from sparkloom.llm import simhash as S
from sparkloom.llm.components import components, forest


def brute_fp(text, n_words):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    sh = [" ".join(words[i : i + n_words]) for i in range(max(1, len(words) - n_words + 1))]
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps, max_bits):
    """{vertex: root} over integers."""
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    fps = sorted(root)
    a = np.array(fps, np.uint64)
    for i, f in enumerate(fps):
        for j in np.flatnonzero(np.bitwise_count(a[i + 1 :] ^ np.uint64(f)) <= max_bits).tolist():
            x, y = find(f), find(fps[i + 1 + j])
            root[max(x, y)] = min(x, y)
    return {f: find(f) for f in fps}


def brute(rows, n_words=4, max_bits=4):
    fp = [brute_fp(t, n_words) for _, t, *_ in rows]
    comp, least = brute_components(set(fp), max_bits), {}
    for (d, *_), f in zip(rows, fp, strict=True):
        if d is not None:
            least[comp[f]] = min(least.get(comp[f], d), d)
    return sorted((d if d is not None else -1, f"{f:016x}", least.get(comp[f], -1)) for (d, *_), f in zip(rows, fp, strict=True))


def got(df):
    return sorted((r[0] if r[0] is not None else -1, r[1], r[2] if r[2] is not None else -1) for r in df.select("doc_id", "fingerprint", "component_id").collect())


def test_cells_meet_within_two_by_group():
    rng = np.random.default_rng(5)
    for bits in range(5):
        for _ in range(60):
            a = rng.integers(0, 2**64, dtype=np.uint64)
            b = a
            for k in rng.choice(64, bits, replace=False):
                b ^= np.uint64(1) << np.uint64(k)
            x, y = (set(S.cells(np.array([[v]], np.uint64), 16)[1].tolist()) for v in (a, b))
            assert x & y


def test_cell_links_span_all_pairs():
    rng = np.random.default_rng(6)
    base = rng.integers(0, 2**64, 6, dtype=np.uint64)
    fp = np.array([int(base[rng.integers(6)]) ^ int(sum(1 << int(k) for k in rng.choice(64, rng.integers(0, 4), replace=False))) for _ in range(900)], np.uint64)
    key = np.sort(rng.integers(0, 12, 900))
    key[:300] = 0
    key = np.sort(key)
    a, b = S.cell_links(key, fp[:, None], 4)
    assert (key[a] == key[b]).all() and (S.distance(fp[a][:, None], fp[b][:, None]) <= 4).all()
    want = {(i, j) for i in range(900) for j in range(i + 1, 900) if key[i] == key[j] and bin(int(fp[i]) ^ int(fp[j])).count("1") <= 4}
    v1 = dict(zip(*(x.tolist() for x in forest(a, b)), strict=True))
    w = np.array(sorted(want))
    v2 = dict(zip(*(x.tolist() for x in forest(w[:, 0], w[:, 1])), strict=True))
    assert v1 == v2


@pytest.mark.parametrize("text", ["", None, " \t\n", "one", "A b C", "a b c d e f g a b c d", "É a\x0bb\x85c d e"])
def test_fingerprint(text):
    assert S.fingerprint((text or "").encode(), 4) == [brute_fp(text, 4)]


def test_long_text_is_whole(monkeypatch):
    words = [f"w{random.Random(i).randrange(50)}" for i in range(2000)]
    text = " ".join(words)
    want = brute_fp(text, 4)
    monkeypatch.setattr(S, "BLOCK", 300)
    assert S.fingerprint(text.encode(), 4) == [want]


def test_components_against_union_find(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(k, k + 1) for k in range(1000, 1040)] + [(5000, k) for k in range(5001, 5100)] + [(7, 7), (None, 3)]
    df = spark.createDataFrame(edges, "a long, b long")
    out = {r["v"]: r["root"] for r in components(df).collect()}
    real = np.array([e for e in edges if None not in e and e[0] != e[1]])
    assert out == dict(zip(*(x.tolist() for x in forest(real[:, 0], real[:, 1])), strict=True))
    assert components(df.limit(0)).collect() == []


def test_contract_on_odd_rows(spark):
    rng = random.Random(2)
    vocab = [f"word{k}" for k in range(300)]
    rows = [(10, ""), (3, None), (4, " \n"), (20, "Same text here now"), (2, "same TEXT here now"), (None, "same text here now"), (None, "lonely null"), (20, "other repeated id")]
    base = [rng.choice(vocab) for _ in range(400)]
    for i in range(120):
        w = list(base)
        for _ in range(i % 3):
            w[rng.randrange(len(w))] = rng.choice(vocab)
        rows.append((100 + i, " ".join(w)))
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, component_id int").repartition(5)
    assert got(S.digest(df)) == brute(rows)
    assert S.digest(df.limit(0)).collect() == []


def test_contract_on_documents(spark):
    docs = spark.read.parquet(f"{DATA}/sf0.01/documents.parquet")
    assert got(S.digest(docs)) == brute([(r["doc_id"], r["text"]) for r in docs.collect()])


def test_stage_keeps_one_of_each_group(spark):
    rng = random.Random(4)
    vocab = [f"word{k}" for k in range(2000)]
    rows, group = [], {}
    for g in range(40):
        base = [rng.choice(vocab) for _ in range(250)]
        for c in range(1 + g % 4):
            w = list(base)
            for _ in range(c):
                w[rng.randrange(len(w))] = "changed"
            group[len(rows)] = g
            rows.append((len(rows), " ".join(w), "x", "y", 1))
    rows += [(0, rows[0][1], "x", "y", 1), (None, rows[1][1], "x", "y", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, t long").repartition(4)
    out = S.keep_one(df)
    assert out.columns == df.columns
    assert sorted(group[r["doc_id"]] for r in out.collect()) == list(range(40))


def test_fingerprints_do_not_depend_on_stretches(monkeypatch):
    rng = random.Random(7)
    texts = [" ".join(rng.choices(["a", "Bc", "longer", "été", "x\ty", "\x0b"], k=rng.randint(0, 300))) for _ in range(40)] + ["w " * 3, "one" * 50]
    whole = [S.fingerprint(t.encode(), 4, 2) for t in texts]
    assert [f[0] for f in whole] == [brute_fp(t, 4) for t in texts]
    monkeypatch.setattr(S, "BLOCK", 16)
    assert [S.fingerprint(t.encode(), 4, 2) for t in texts] == whole
