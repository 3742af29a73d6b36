import math

import pytest
from sparkloom.llm import mixing as M


def test_shares_follow_weights_and_odd_rows(spark):
    rows = [(i, "x" * (20 + i % 30), "hot" if i % 3 else f"s{i % 5}", i) for i in range(6000)] + [(None, "n", None, 0), (7, None, "s1", 0), (8, "", "empty", 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, copy int")
    out = M.mix(df, {"hot": 0.2, "s0": 0.5, "empty": 0.1}, other=0.2)
    assert out.columns == [*df.columns, "copy_", "shuffle_key"] and M.mix(df, marks=False).columns == df.columns
    out = out.collect()
    mass = {}
    for r in out:
        k = r["source"] if r["source"] in ("hot", "s0", "empty") else "rest"
        mass[k] = mass.get(k, 0) + len(r["text"] or "")
    total = sum(len(t or "") for _, t, *_ in rows)
    for k, share in (("hot", 0.2), ("s0", 0.5), ("rest", 0.2)):
        assert abs(mass[k] / total - share) < 0.05
    assert "empty" not in mass
    copies = {}
    for r in out:
        copies.setdefault(r["doc_id"], []).append(r["copy_"])
    assert all(sorted(v) == list(range(len(v))) for d, v in copies.items() if d not in (7, 8, None))


def test_empty_and_bad_weights(spark):
    df = spark.createDataFrame([], "doc_id long, text string, source string")
    assert M.mix(df).collect() == []
    with pytest.raises(ValueError):
        M.mix(df, {"a": -1.0})
    with pytest.raises(ValueError):
        M.mix(df, {"a": 0.0}, other=0.0)


def test_distribution_at_large_rates(spark):
    from pyspark.sql import functions as F

    for rate in (0.01, 3.5, 1200.0):
        cdf = spark.range(1).select(M._distribution(F.lit(rate)).alias("c")).first()["c"]
        assert abs(cdf[-1] - 1) < 1e-9 and cdf == sorted(cdf)
        assert math.isclose(cdf[0], math.exp(-rate), rel_tol=1e-9, abs_tol=1e-300)


def test_a_small_source_for_its_weight(spark):
    """Rates beyond one draw are sums of draws: mean and spread are those of the Poisson distribution."""
    rows = [(i, "x" * 1000, "big") for i in range(400)] + [(1000 + i, "x", "tiny") for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    n = {r["doc_id"]: r["count"] for r in M.mix(df, {"tiny": 0.2}, other=0.8).groupBy("doc_id").count().collect()}
    rate = 0.2 * 400_020 / 20
    tiny = [n[1000 + i] for i in range(20)]
    assert rate > M.ONE_DRAW and all(abs(v - rate) < 5 * math.sqrt(rate) for v in tiny) and len(set(tiny)) > 10
