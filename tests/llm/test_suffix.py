import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from conftest import DATA
from sparkloom.llm import suffix as S


def brute(rows, length=200):
    seen = {}
    data = [(d, (t or "").encode()) for d, t, *_ in rows]
    for _, b in data:
        for i in range(len(b) - length + 1):
            k = b[i : i + length]
            seen[k] = seen.get(k, 0) + 1
    out = []
    for d, b in data:
        gone = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                gone[i : i + length] = True
        kept = bytes(x for x, g in zip(b, gone, strict=False) if not g)
        out.append((d if d is not None else -1, len(b), int(gone.sum()), int((gone[1:] & ~gone[:-1]).sum() + gone[0]), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def got(df):
    return sorted((r[0] if r[0] is not None else -1, *r[1:]) for r in df.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect())


def prose(rng, n):
    return " ".join("".join(rng.choices("abcdefghij", k=rng.randint(2, 7))) for _ in range(n))


def test_anchors_depend_on_content(monkeypatch):
    rng = random.Random(0)
    text = prose(rng, 3000).encode() + b"z" * 700
    h, i, n, shift = S.anchors(text)
    assert i[0] == 0 and (i[1:] == i[:-1] + n[:-1]).all() and i[-1] + n[-1] == len(text) - 199
    assert (shift >= n - 1).all() and (shift <= 160).all()
    part = S.anchors(text[1000:3000])
    at = {int(a) + 1000: (int(x), int(a + s) + 1000) for x, a, s in zip(part[0], part[1], part[3], strict=True)}
    whole = {int(w): (int(x), int(a + s)) for x, a, c, s in zip(h, i, n, shift, strict=True) for w in range(a, a + c)}
    assert all(whole[w] == v for w, v in at.items())
    monkeypatch.setattr(S, "STRETCH", 256)
    cut = S.anchors(text)
    again = {int(w): (int(x), int(a + s)) for x, a, c, s in zip(*cut, strict=True) for w in range(a, a + c)}
    assert again == whole
    assert len(S.anchors(b"x" * 199)[0]) == 0


def test_queue_orders_and_spills(tmp_path):
    rng = np.random.default_rng(1)
    q, want = S.TupleQueue(S._tuples(3), 640, str(tmp_path)), {v: [] for v in range(256)}
    n = 0
    for _ in range(40):
        b = np.sort(rng.integers(0, 256, 30)).astype(np.uint8)
        t = np.zeros(30, S._tuples(3))
        t["h"] = np.arange(n, n + 30)
        n += 30
        q.push(b, t)
        for v, r in zip(b.tolist(), t["h"].tolist(), strict=True):
            want[v].append(r)
    assert len(list(tmp_path.iterdir())) > 1
    assert np.concatenate(list(q.take()))["h"].tolist() == [r for v in range(256) for r in want[v]]
    assert not list(tmp_path.iterdir())


def batch(rows, length):
    """Rows (core, text, anchor's distance, number of windows) as a shard gets them."""
    rows = sorted((h, seg[o : o + length], xxhash.xxh3_64_intdigest(seg) >> 1, o, n, seg[:o][::-1]) for h, seg, o, n in rows)
    kinds = [pa.int64(), pa.binary(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=["h", "right", "s", "shift", "count", "left"])


def windows_found(batches, length, memory, folder):
    out = []
    for x in S._shard(iter(batches), length, memory, str(folder)):
        out += [(h, s, w) for h, s, a, b in zip(*(x.column(c).to_pylist() for c in "hsab"), strict=True) for w in range(a, b)]
    return out


@pytest.mark.parametrize("seed", range(6))
@pytest.mark.parametrize("take", [3, 4096])
def test_induced_prefixes_against_sorting(seed, take, monkeypatch, tmp_path):
    """Every round's order and common prefixes, by way of the windows found, against all pairs of windows."""
    monkeypatch.setattr(S, "TAKE", take)
    monkeypatch.setattr(S, "BLOCK", 5 if take == 3 else 16_384)
    monkeypatch.setattr(S, "CORE", 60)
    rng = random.Random(seed)
    length, segs, core, shift, count = 80, [], [], [], []
    for c in range(4):
        middle = prose(rng, 40)[:60]
        for _ in range(rng.randint(1, 12)):
            o = rng.randint(3, 20)
            left, right = ("".join(rng.choices("ab", k=20))[-o:], "".join(rng.choices("ab\0", k=40)))
            n = rng.randint(1, o + 1)
            segs.append((left + middle + right)[: n - 1 + length].encode())
            core.append(c)
            shift.append(o)
            count.append(n)
    rows = list(zip(core, segs, shift, count, strict=True))
    windows = {}
    for h, seg, o, n in rows:
        for w in range(n):
            windows.setdefault((h, o - w, seg[w : w + length]), []).append((h, xxhash.xxh3_64_intdigest(seg) >> 1, w))
    want = sorted({x for v in windows.values() if len(v) > 1 for x in v})
    whole = batch(rows, length)
    for size in (1, 7, whole.num_rows):
        found = windows_found([whole.slice(a, size) for a in range(0, whole.num_rows, size)], length, 100, tmp_path)
        assert sorted(found) == want and not list(tmp_path.iterdir())


def test_a_core_beyond_memory_goes_to_files(tmp_path, monkeypatch):
    """60,000 contents of one core, with the bounds of production: tuples spill, memory stays."""
    import resource

    rng = np.random.default_rng(8)
    core = prose(random.Random(8), 30).encode()[:100]
    rows, want = [], set()
    for k in range(30_000):
        left, right = rng.integers(97, 123, 60, dtype=np.uint8).tobytes(), rng.integers(97, 123, 120, dtype=np.uint8).tobytes()
        seg = left + core + right
        rows.append((1, seg, 60, 61))
        other = bytes([left[0] ^ 1]) + left[1:] + core + right  # differs in its first byte: shares all windows but the first
        rows.append((1, other, 60, 61))
        want |= {(xxhash.xxh3_64_intdigest(x) >> 1, w) for x in (seg, other) for w in range(1, 61)}
    whole = batch(rows, 200)
    spilled = []
    monkeypatch.setattr(S.TupleQueue, "_spill", lambda self, f=S.TupleQueue._spill: (spilled.append(self.held), f(self)))
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    found = windows_found([whole.slice(a, 5_000) for a in range(0, whole.num_rows, 5_000)], 200, S.QUEUE_BYTES, tmp_path)
    assert {(s, w) for _, s, w in found} == want and len(found) == len(want)
    assert len(spilled) > 10 and max(spilled) < S.QUEUE_BYTES + (8 << 20)
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 900 << 10  # the windows found are held by the test


def test_odd_rows(spark):
    rng = random.Random(3)
    p, q = prose(rng, 60), prose(rng, 90)
    rows = [
        (1, prose(rng, 100) + p + prose(rng, 30)), (2, p), (3, "x" + p[:-1]), (4, None), (5, ""), (6, p[:199]), (7, "é" * 150 + q), (8, q + "é" * 150), (None, "n" + q[5:250]),
        (9, "a" * 1500), (10, "b" * 200), (11, q * 5), (12, q), (12, q), (13, prose(rng, 4000) + q[:220]), (14, "\0" * 210 + "end"), (15, "tail" + "\0" * 205), (16, p + p), (17, prose(rng, 60)),
    ]
    df = spark.createDataFrame([(*r, 1, "h") for r in rows], "doc_id long, text string, k int, h string").repartition(4)
    want = brute(rows)
    assert got(S.digest(df)) == want
    assert got(S.remove_repeats(df, memory=64, hot=1)) == want
    assert S.digest(df.limit(0)).collect() == []


def test_many_variants_of_one_passage(spark, monkeypatch):
    monkeypatch.setattr(S, "BLOCK", 8)
    monkeypatch.setattr(S, "TAKE", 50)
    rng = random.Random(5)
    p = prose(rng, 70)
    rows = [(i, prose(rng, 20) + p[rng.randint(0, 9) :] + prose(rng, 20)) for i in range(120)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert got(S.digest(df)) == brute(rows)
    assert got(S.remove_repeats(df, hot=5)) == brute(rows)  # the core split by the bytes around it


def test_documents(spark):
    docs = spark.read.parquet(f"{DATA}/sf0.001/documents.parquet")
    assert got(S.digest(docs)) == brute([(r["doc_id"], r["text"]) for r in docs.collect()])
