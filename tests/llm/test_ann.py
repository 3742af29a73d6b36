import numpy as np
from conftest import DATA
from sparkloom.llm import ann as A


def brute(ids, x, every=100, k=10):
    out = {}
    for i, v in zip(ids, x, strict=True):
        if i % every == 0:
            d = np.sqrt(np.square(x - v).sum(1))
            out[i] = sorted((float(a), j) for a, j in zip(d, ids, strict=True) if j != i)[:k]
    return out


def answers(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["score"], r["vec_id"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def test_transform_is_orthonormal():
    h = A.hadamard(np.eye(16))
    assert np.allclose(h @ h.T, np.eye(16))


def test_recall_and_exact_scores(spark):
    df = spark.read.parquet(f"{DATA}/sf0.1/embeddings.parquet")
    rows = df.orderBy("vec_id").collect()
    want = brute([r["vec_id"] for r in rows], np.array([r["embedding"] for r in rows], float))
    got = answers(A.nearest(df))
    assert got.keys() == want.keys() and all(len(v) == 10 for v in got.values())
    hits = [len({j for _, j in got[q]} & {j for _, j in want[q]}) for q in want]
    assert sum(hits) >= 0.95 * 10 * len(want)
    for q, v in got.items():
        exact = {j: d for d, j in want[q]}
        assert all(abs(exact[j] - d) < 1e-12 for d, j in v if j in exact) and v == sorted(v)


def test_odd_rows_ties_and_small_tables(spark):
    nan, inf = float("nan"), float("inf")
    good = [(0, [1.0, 0, 0]), (5, [1.0, 0.5, 0]), (3, [1.0, 0.5, 0]), (100, [0.0, 0, 2.0]), (7, [-1.0, 0, 1e-3]), (7, [-1.0, 0, 1e-3])]
    bad = [(200, None), (1, [0.0, 0, 0]), (2, [nan, 1, 1]), (4, [inf, 1, 1]), (6, [1.0, None, 1]), (8, [1.0]), (None, [1.0, 1, 1]), (9, [])]
    df = spark.createDataFrame([(i, v and [None if c is None else float(c) for c in v], "c", 1.0) for i, v in good + bad], "vec_id long, embedding array<double>, cell string, score double").repartition(3)
    keep = dict(good)
    assert answers(A.nearest(df)) == {q: v for q, v in brute(list(keep), np.array(list(keep.values()))).items()}
    assert A.nearest(df.limit(0)).collect() == []


def recall(want, got, k=10):
    return sum(len({j for _, j in got.get(q, [])} & {j for _, j in want[q]}) for q in want) / sum(len(v) for v in want.values())


def frame(spark, x, ids=None):
    ids = range(len(x)) if ids is None else ids
    return spark.createDataFrame([(int(i), [float(c) for c in v]) for i, v in zip(ids, x, strict=True)], "vec_id long, embedding array<double>").repartition(4)


def test_common_vector_is_indexed_once(spark, monkeypatch):
    monkeypatch.setattr(A, "PART", 100)
    rng = np.random.default_rng(2)
    x = np.concatenate([np.repeat(rng.normal(size=(1, 20)), 400, 0), rng.normal(size=(500, 20))])
    want, got = brute(list(range(900)), x), answers(A.nearest(frame(spark, x)))
    assert recall(want, got) >= 0.9 and got[0] == want[0] and got[300] == want[300]


def test_few_rows_all_come_back(spark):
    rng = np.random.default_rng(4)
    for n in (2, 9, 11, 30):
        x = rng.normal(size=(n, 8))
        x[1] = -x[0]  # the antipode of the query
        assert answers(A.nearest(frame(spark, x))) == brute(list(range(n)), x)
    assert A.nearest(frame(spark, rng.normal(size=(1, 8)))).collect() == []


def test_query_opposite_to_a_cluster(spark):
    rng = np.random.default_rng(5)
    x = np.concatenate([-np.ones((1, 64)), 1 + 0.02 * rng.normal(size=(3000, 64))])
    want, got = brute(list(range(3001)), x), answers(A.nearest(frame(spark, x)))
    assert got[0] == want[0] and recall(want, got) >= 0.9 and all(len(v) == 10 for v in got.values())


def test_lengths_are_searched_apart_and_repeated_ids_count_once(spark):
    rng = np.random.default_rng(6)
    long, short = rng.normal(size=(120, 12)), rng.normal(size=(40, 5))
    rows = [(i, v.tolist()) for i, v in enumerate(long)] + [(1000 + i, v.tolist()) for i, v in enumerate(short)]
    rows += [(50, (long[0] + 1e-6).tolist())]  # a second vector of an id, next to a query
    got = answers(A.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>")))
    assert set(got) == {0, 100, 1000} and got[0][0][1] == 50 and [j for _, j in got[0]].count(50) == 1
    assert got[1000] == brute([1000 + i for i in range(40)], short)[1000]


def test_recall_and_work_at_fifty_thousand(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    x = np.random.default_rng(7).normal(size=(50_000, 64)).astype(np.float32)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    flat = pa.ListArray.from_arrays(np.arange(0, x.size + 1, 64, dtype=np.int32), pa.array(x.ravel()))
    pq.write_table(pa.table({"vec_id": np.arange(50_000), "embedding": flat}), tmp_path / "x.parquet")
    got = answers(A.nearest(spark.read.parquet(str(tmp_path / "x.parquet"))))
    big = x.astype(float)
    some = range(0, 50_000, 1_000)
    found = seen = 0
    made = A.Tables(64, A.TABLES, 11)
    codes = np.concatenate([made.codes(big[a : a + 5_000]) for a in range(0, 50_000, 5_000)])
    sizes = np.bincount(codes.ravel(), minlength=made.tables * made.cells)
    for q in some:
        d = np.square(big - big[q]).sum(1)
        d[q] = np.inf
        found += len(set(np.argpartition(d, 10)[:10].tolist()) & {j for _, j in got[q]})
        cells = next(made.look(big[q : q + 1], sizes, A.BASE * 10 + int(A.BUDGET * 50_000**A.POWER)))
        seen += np.isin(codes, cells).any(1).sum()
    assert found >= 0.95 * 10 * len(some)
    assert seen <= 0.2 * 50_000 * len(some)  # rows compared with a query
