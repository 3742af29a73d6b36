import hashlib
import re

from conftest import DATA
from sparkloom.llm import lines as L


def brute(rows):
    strip = re.compile(r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+\Z")
    low = lambda s: re.sub("[A-Z]", lambda m: m[0].lower(), s)
    key = lambda line: low(strip.sub("", line))
    ids = {}
    big = -(1 << 63)
    for d, t in rows:
        for line in (t or "").split("\n"):
            k = key(line)
            if len(k) >= 20:
                ids.setdefault(k, set()).add(big if d is None else d)
    out = []
    for d, t in rows:
        all_lines = (t or "").split("\n")
        keep = [x for x in all_lines if not (len(ids.get(key(x), ())) >= 3 and max(ids[key(x)]) != (big if d is None else d))]
        out.append((d if d is not None else big, len(all_lines), len(all_lines) - len(keep), hashlib.sha256("\n".join(keep).encode()).hexdigest()))
    return sorted(out)


def got(df):
    return sorted((r[0] if r[0] is not None else -(1 << 63), *r[1:]) for r in df.collect())


def test_odd_rows(spark):
    a, b = "A common line of twenty", "another é line that is long"
    rows = [(1, a + "\nx\n" + b), (2, "  " + a.upper() + "\t\n" + a), (3, a), (4, None), (5, ""), (6, "\n\n"), (None, a + "\n" + b), (7, b + "\r"), (7, b + "\r"), (7, a + "\nmore"), (8, "short\n" * 3), (9, "\n".join([b] * 2000) + "\nend")]
    df = spark.createDataFrame([(*r, 1, "h") for r in rows], "doc_id long, text string, n int, h string").repartition(3)
    assert got(L.digest(df)) == brute(rows)
    assert L.digest(df.limit(0)).collect() == []


def test_shuffle_join_of_many_keys(spark, monkeypatch):
    monkeypatch.setattr(L, "BROADCAST_KEYS", 0)
    docs = spark.read.parquet(f"{DATA}/sf0.001/documents.parquet")
    assert got(L.digest(docs)) == brute([(r["doc_id"], r["text"]) for r in docs.collect()])
