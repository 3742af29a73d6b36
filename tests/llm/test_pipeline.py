import functools
import hashlib
import math
import re
import zlib
from collections import Counter

import corpus_pipeline as P
import numpy as np
from conftest import DATA
from sparkloom.llm import common as C
from sparkloom.llm import mixing, simhash

SF = f"{DATA}/sf0.001"


def brute_copies(rows):
    mass = {}
    for r in rows:
        k = r["source"] if r["source"] in mixing.WEIGHTS else ""
        mass[k] = mass.get(k, 0) + len(r["text"] or "")
    whole, total = sum(mass.values()), sum(mixing.WEIGHTS.values()) + mixing.OTHER
    out = []
    for r in rows:
        k = r["source"] if r["source"] in mixing.WEIGHTS else ""
        rate = mixing.WEIGHTS.get(k, mixing.OTHER) / total * whole / mass[k]
        u = int(hashlib.md5(f"17:{r['doc_id']}".encode()).hexdigest()[:13], 16) / 2**52
        n, cdf = 0, math.exp(-rate)
        while cdf <= u and n < 1000:
            n += 1
            cdf += math.exp(n * math.log(rate) - rate - math.lgamma(n + 1))
        out += [r["doc_id"]] * n
    return sorted(out)


@functools.cache
def shingles(text):
    w = (text or "").lower().split()
    c = Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4)))
    return c, math.sqrt(sum(v * v for v in c.values()))


def cosine(a, b):
    (x, n), (y, m) = shingles(a), shingles(b)
    return sum(v * y[k] for k, v in x.items() if k in y) / (n * m)


def joined(rows, near):
    """Groups of doc_ids over the rows that near(i) names."""
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in near(i):
            a, b = find(i), find(int(j))
            root[max(a, b)] = min(a, b)
    groups = {}
    for i, r in enumerate(rows):
        groups.setdefault(find(i), []).append(r["doc_id"])
    return list(groups.values())


def test_near_copies_share_a_group(spark):
    """All pairs of sf0.1 by exact similarity of five-word shingles: recall of pairs and partners of dropped documents."""
    docs = C.load(spark, f"{DATA}/sf0.1", "documents")
    rows = {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}
    group = {r["doc_id"]: (r["component_id"], r["kept"]) for r in simhash.group(docs, **simhash.STAGE).collect()}
    holders = {}
    for d, t in rows.items():
        for s in shingles(t)[0]:
            holders.setdefault(hash(s), []).append(d)
    # copies share many shingles that few documents have
    pairs = {(a, b) for h in holders.values() if 1 < len(h) <= 30 for i, a in enumerate(h) for b in h[i + 1 :]}
    sets = {d: set(shingles(rows[d])[0]) for p in pairs for d in p}
    jaccard = {p: len(sets[p[0]] & sets[p[1]]) / len(sets[p[0]] | sets[p[1]]) for p in pairs}
    together = lambda low, high: [group[a][0] == group[b][0] for (a, b), j in jaccard.items() if low <= j < high]
    assert np.mean(together(0.9, 1.1)) == 1 and np.mean(together(0.8, 0.9)) >= 0.98 and np.mean(together(0.75, 0.8)) >= 0.88
    best = {}
    for a, b in pairs:
        c = cosine(rows[a], rows[b])
        for d in (a, b):
            best[d] = max(best.get(d, 0), c)
    dropped = [d for d, (_, kept) in group.items() if not kept and (rows[d] or "").strip()]
    members = {}
    for d, (c, _) in group.items():
        members.setdefault(c, []).append(d)
    for d in dropped:  # texts whose shingles many documents have
        if best.get(d, 0) < 0.7:
            best[d] = max(cosine(rows[d], rows[m]) for m in members[group[d][0]] if m != d)
    assert len(dropped) > 500 and np.mean([best[d] >= 0.7 for d in dropped]) >= 0.99


def test_stages_against_brute_force(spark):
    from tokenizers import Tokenizer

    docs = C.load(spark, SF, "documents")
    rows = docs.collect()
    assert [n for n, _ in P.STAGES][-1] == "token_output" and 4 <= len(P.STAGES) <= 5
    frames = []
    for name, stage in P.STAGES:
        docs = C.materialize(stage(spark, docs, SF), name)
        frames.append(docs)
    clean, single, pure, mixed, out = frames
    for f in frames[:-1]:
        assert f.columns == C.load(spark, SF, "documents").columns
    # toxicity: labelled documents
    toxic = {r["doc_id"] for r in C.load(spark, SF, "labels").filter("toxic = 1").collect()}
    left = {r["doc_id"] for r in clean.collect()}
    labelled = {r["doc_id"] for r in C.load(spark, SF, "labels").collect()}
    gone = {r["doc_id"] for r in rows} - left
    print("toxic left", len(toxic & left), len(toxic), "clean gone", len((labelled - toxic) & gone), len(labelled - toxic), "all gone", len(gone), len(rows))
    assert len(toxic & left) <= 0.35 * len(toxic) and len(gone) <= 0.25 * len(rows)
    # near-dedup: one document of each group, no group joined that all pairs do not join; few merges may be missed
    rows = clean.collect()
    fp = np.array([simhash.fingerprint((r["text"] or "").encode(), 5, simhash.STAGE["n_fp"]) for r in rows], np.uint64)
    groups = joined(rows, lambda i: np.flatnonzero(simhash.distance(fp[i + 1 :], fp[i]) <= simhash.STAGE["max_bits"]) + i + 1)
    alike = joined(rows, lambda i: [j for j in range(i + 1, len(rows)) if cosine(rows[i]["text"], rows[j]["text"]) >= 0.87])
    ids = sorted(r["doc_id"] for r in single.collect())
    assert set(ids) >= {min(g) for g in groups} and len(set(ids) - {min(g) for g in alike}) == 0
    # decontamination: no item is left, and only documents with one went
    words = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    items = [words(r["text"]) for r in C.load(spark, SF, "benchmark").collect()]

    def holds(text):
        w = words(text)
        have = {tuple(w[i : i + 8]) for i in range(len(w) - 7)}
        return any(sum(tuple(t[i : i + 8]) in have for i in range(len(t) - 7)) >= 0.6 * (len(t) - 7) for t in items)

    assert sorted(r["doc_id"] for r in pure.collect()) == sorted(r["doc_id"] for r in single.collect() if not holds(r["text"]))
    # mixing and token output
    assert sorted(r["doc_id"] for r in mixed.collect()) == brute_copies(pure.collect())
    t, at = Tokenizer.from_file(P.TOKENIZER), 0
    texts = {r["doc_id"]: r["text"] for r in pure.collect()}
    for r in sorted(out.collect(), key=lambda r: r["start"]):
        ids = [*t.encode(texts[r["doc_id"]], add_special_tokens=False).ids, P.END_ID]
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)


def test_run_and_empty_input(spark):
    assert P.run(spark, SF).columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    docs = C.load(spark, SF, "documents").limit(0)
    for name, stage in P.STAGES:
        docs = C.materialize(stage(spark, docs, SF), name)
    assert docs.count() == 0


def test_odd_rows_pass_through_every_stage(spark):
    rows = [(1, "Some words to keep here.", "en", "src0", 24), (1, "Some words to keep here.", "en", "src0", 24), (None, None, None, None, None), (2, "", None, "src1", 0), (3, "x " * 60_000, "en", None, None), (None, "Some words to keep here.", "en", "src9", 24)]
    docs = spark.createDataFrame([(*r, 1, "k") for r in rows], "doc_id long, text string, lang string, source string, n_chars long, copy int, shuffle_key string")
    for name, stage in P.STAGES:
        columns = docs.columns
        docs = C.materialize(stage(spark, docs, SF), name)
        if name != "token_output":
            assert docs.columns == columns
        if name == "simhash_near_dedup":
            assert sorted((r["doc_id"] or -1, len(r["text"] or "")) for r in docs.collect()) in ([(1, 24), (2, 0), (3, 120_000)],)
    assert docs.count() > 0
