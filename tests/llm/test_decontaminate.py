import random
import re

import regex
from conftest import DATA
from pyspark.sql import functions as F
from sparkloom.llm import decontaminate as D

ITEMS = [
    (1, "A train leaves the station with Alice Brown and travels 120 km in 2 hours before it stops at noon for Alice and her 3 bags near the old bridge."),
    (2, "the quick brown fox jumps over the lazy dog while seven small cats sleep under one large tree by the river bank"),
    (3, "only four words here"),
    (4, "1 2 3 4 5 6 7 8 9 10 11 12"),
    (5, None),
]
DOCS = [
    (1, "before text " + ITEMS[1][1].upper() + " after text"),
    (2, "intro line\n" + ITEMS[0][1].replace("120", "75.5").replace("Alice Brown", "Carol Jones").replace("Alice", "Carol").replace("2 hours", "9 hours").replace("3 bags", "8 bags")),
    (3, "x. " + ITEMS[0][1].replace("Alice Brown", "Carol Jones")),
    (4, "the quick brown fox jumps over the lazy dog and nothing else of that kind is here at all my friend"),
    (5, "we have only four words here today"),
    (6, "5 6 7 8 9 10 11 12 13 14 15 16"),
    (7, None),
    (8, ""),
    (None, ITEMS[1][1]),
    (9, ITEMS[1][1]),
    (9, ITEMS[1][1]),
    (10, "filler words " * 5000 + ITEMS[1][1] + " more filler" * 100),
]


def test_tokens(spark):
    df = spark.createDataFrame([("He met Anna, paid 1,234.5 dollars and ran 5km. Then Bob left",), (None,), ("x",)], "text string")
    out = [r[0] for r in df.select(D.tokens(F.col("text"), True)).collect()]
    n, a, u, p = D.NUMBER, D.NAME, D.UNIT, D.POINT
    assert out[0] == ["he", "met", f"{a}anna", "paid", f"{n}1{p}234{p}5", f"{u}dollars", "and", "ran", f"{n}5", f"{u}km", "then", f"{a}bob", "left"]
    assert out[1] == [] and out[2] == ["x"]
    plain = df.select(D.tokens(F.col("text"), False)).collect()[0][0]
    assert plain == [x[0] if x[0] in n + a + u else x for x in out[0]]


def test_planted_cases(spark):
    docs = spark.createDataFrame([(*d, 7) for d in DOCS], "doc_id long, text string, item_id int").repartition(3)
    bench = spark.createDataFrame([(*i, 1) for i in ITEMS], "item_id long, text string, hash int")
    got = sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["item_id"]) for r in D.contaminated(docs, bench).collect())
    # 2: other values, used consistently; 3: one name for two slots of the same item value; 4: a part only
    assert got == [(-1, 2), (1, 2), (2, 1), (5, 3), (9, 2), (10, 2)]
    kept = D.keep_clean(docs, bench)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [3, 4, 6, 7, 8]
    assert D.contaminated(docs.limit(0), bench).collect() == [] and D.contaminated(docs, bench.limit(0)).collect() == []


def test_against_brute_force(spark):
    docs, bench = (spark.read.parquet(f"{DATA}/sf0.01/{t}.parquet") for t in ("documents", "benchmark"))
    words = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    items = {r["item_id"]: words(r["text"]) for r in bench.collect()}
    want = set()
    for r in docs.collect():
        w = words(r["text"])
        have = {tuple(w[i : i + 8]) for i in range(len(w) - 7)}
        for k, t in items.items():
            own = [tuple(t[i : i + 8]) for i in range(len(t) - 7)]
            if sum(x in have for x in own) >= 0.9 * len(own):
                want.add((r["doc_id"], k))
    got = {(r["doc_id"], r["item_id"]) for r in D.digest(docs, bench).collect()}
    assert want and got == want


def test_few_windows_at_every_offset(spark):
    words = "amber boats carry dusty engines from green harbours into"  # 9 tokens, then 8, 10 and an item of which 3 windows of 5 are held
    items = [(1, words), (2, words.replace("amber ", "").replace("dusty", "rusty")), (3, words + " jars"), (4, "old oak doors " + " ".join(f"{x}ing" for x in "abcdefghi"))]
    held = [items[0][1], items[1][1], items[2][1], " ".join(items[3][1].split()[2:])]
    docs = [(10 * k + n, "so " * n + held[k - 1] + " end of it") for k in (1, 2, 3, 4) for n in range(4)]
    got = D.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    got = {(r["doc_id"], r["item_id"]) for r in got}
    assert {(10 * k + n, k) for k in (1, 2, 3, 4) for n in range(4)} <= got


def test_numbers_are_met_with_their_values(spark):
    items = [(1, "1 2 3 4 5 6 7 8 9 10 11 12"), (2, "17 + 25 ="), (3, "the sum of these few plain words is 3 km 5 kg 7 cm 9 mg 11 km 13 kg 15 cm 17 mg 19 km 21 kg 23 cm 25 mg 27 km 29 kg")]
    tail = items[2][1].split("words is ")[1]
    docs = [(1, "count 1 2 3 4 5 6 7 8 9 10 11 12 now"), (2, "count 2 3 4 5 6 7 8 9 10 11 12 13 14 now"), (3, "count 21 22 23 24 25 26 27 28 29 30 31 32"), (4, "is 17 + 25 = 42"), (5, "is 18 + 25 = 43"), (6, "a table of " + tail), (7, items[2][1].replace("3 km 5 kg", "4 km 6 kg"))]
    got = D.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    # 2: four of the first item's five windows; 6: most windows, but none of the few templates; 7: templates with other values
    assert sorted((r["doc_id"], r["item_id"]) for r in got) == [(1, 1), (2, 1), (4, 2), (6, 3), (7, 3)]


def py_tokens(text):
    """The tokens with values, by another regular expression engine."""
    t = regex.sub(f"[{D.NUMBER}{D.NAME}{D.UNIT}{D.POINT}]", "", text or "")
    t = regex.sub(r"(?<=\p{Nd})[.,:/](?=\p{Nd})", D.POINT, t)
    t = regex.sub(r"(?<=[\p{Ll}\p{Nd},;][ \n])(\p{Lu}\p{Ll}+)", D.NAME + r"\1", t)
    starter = set(D._STARTERS.split("|"))
    first = lambda m: m[0] if regex.match(r"\p{Lu}\p{Ll}*", m[0])[0].lower() in starter else D.NAME + m[0]
    t = regex.sub(r"(?<=^|[.!?\n]|[.!?\n][ \n])(\p{Lu}\p{Ll}+)", first, t)
    t = regex.sub(rf"(?i)(\p{{Nd}}) ?({D._UNITS})(?![\p{{L}}\p{{N}}])", rf"\1 {D.UNIT}\2", t)
    t = regex.sub(rf"(\p{{Nd}}[\p{{Nd}}{D.POINT}]*)", rf" {D.NUMBER}\1 ", t)
    return [x for x in regex.split(rf"[^\p{{L}}\p{{N}}{D.NUMBER}-{D.POINT}]+", t.lower()) if x]


def py_contaminated(docs, items, window=8, coverage=0.6):
    """The whole method over all pairs of windows, item by item."""
    held = lambda x: x[0] in (D.NUMBER, D.NAME, D.UNIT)
    bare = lambda w: tuple(x[0] if held(x) else x for x in w)
    out = set()
    prepared = []
    for k, text in items:
        t = py_tokens(text)
        if len(t) < D.MIN_TOKENS:
            continue
        w = min(window, len(t))
        wins = []
        for q in range(len(t) - w + 1):
            own = tuple(t[q : q + w])
            exact = w - sum(map(held, own)) < min(D.PLAIN, -(-w // 2))
            wins.append((q, own, exact))
        prepared.append((k, w, wins))
    for d, text in docs:
        t = py_tokens(text)
        at = {}
        for w in {w for _, w, _ in prepared}:
            for p in range(len(t) - w + 1):
                own = tuple(t[p : p + w])
                at.setdefault((w, bare(own)), []).append((p, own))
        for k, w, wins in prepared:
            met = [(q, p, exact, item, own) for q, item, exact in wins for p, own in at.get((w, bare(item)), ()) if not exact or own == item]
            slots = {}
            for q, p, exact, item, own in met:
                if not exact:
                    slots.setdefault(p - q, set()).update((a, b) for a, b in zip(item, own, strict=True) if held(a))
            bad = {x for x, pairs in slots.items() if len({a for a, _ in pairs}) < len(pairs) or len({b for _, b in pairs}) < len(pairs)}
            good = [(q, exact) for q, p, exact, item, _ in met if exact or p - q not in bad or not any(map(held, item))]
            n_t, n_all = sum(not e for _, _, e in wins), len(wins)
            f_t, f_all = len({q for q, e in good if not e}), len({q for q, _ in good})
            share = f_t / n_t if n_t and f_t / n_t >= coverage else f_all / n_all
            if share >= coverage:
                out.add((d, k))
    return out


def found(docs, bench):
    return {(r["doc_id"], r["item_id"]) for r in D.contaminated(docs, bench).collect()}


def test_whole_method_against_brute_force(spark):
    docs, bench = (spark.read.parquet(f"{DATA}/sf0.01/{t}.parquet") for t in ("documents", "benchmark"))
    rows, items = [(r["doc_id"], r["text"]) for r in docs.collect()], [(r["item_id"], r["text"]) for r in bench.collect()]
    want = py_contaminated(rows, items)
    assert want and found(docs, bench) == want


def test_altered_items_against_brute_force(spark):
    """Items with numbers, names and units in documents, their values changed in many ways."""
    rng = random.Random(9)
    plain = "buys sells carries wants keeps sees near under with without green large apples boats bags roads before after noon today".split()
    names, units = ["Anna", "Tom", "Carol", "Bob"], ["km", "kg", "hours", "m"]

    def item():
        out = []
        for _ in range(rng.randint(2, 24)):
            u = rng.random()
            out.append(str(rng.randint(1, 9)) if u < 0.15 else rng.choice(names) if u < 0.3 else f"{rng.randint(1, 9)} {rng.choice(units)}" if u < 0.4 else rng.choice(plain))
        return " ".join(out)

    items = [(k, item()) for k in range(40)] + [(40, "yes"), (41, None), (None, "a b c d e f")]
    docs = []
    for k in range(400):
        t = items[k % 40][1]
        for _ in range(rng.randint(0, 3)):
            a, b = rng.choice([(names, names), ("123456789", "123456789"), (units, units), (plain, plain)])
            t = t.replace(rng.choice(a), rng.choice(b), rng.choice([1, 9]))
        docs.append((k, rng.choice(["", "Some words. ", "yes, "]) + t + rng.choice([" and so on", ". Anna left", ""])))
    got = found(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert got == py_contaminated(docs, [x for x in items if x[0] is not None])
    short = D.too_short(spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r["item_id"], r["n_tokens"]) for r in short} == {(40, 1), (41, 0), (None, 6)}


def test_names_at_sentence_starts_and_one_to_one_slots(spark):
    items = [(1, "Anna has 3 apples and buys 12 more apples today"), (2, "two boats leave at 4 and at 9 from the old harbour")]
    docs = [
        (1, "Tom has 7 apples and buys 15 more apples today"), (2, "Well. Tom has 7 apples and buys 15 more apples today."), (3, "Tom has 7 apples and buys 7 more apples today"),
        (4, "two boats leave at 5 and at 8 from the old harbour"), (5, "two boats leave at 5 and at 5 from the old harbour"), (6, "yes. The apples are more today"),
    ]
    got = found(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert got == {(1, 1), (2, 1), (4, 2)}


def test_verbatim_items_of_every_short_length_at_every_offset(spark):
    words = [f"{a}{b}ling" for a in "bdfgklmnprst" for b in "aeo"]
    items = [(n, " ".join(words[n : 2 * n])) for n in range(3, 13)]
    docs = [(100 * n + k, "so " * k + t + " end of it") for n, t in items for k in range(9)]
    got = found(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {(100 * n + k, n) for n, _ in items for k in range(9)} <= got
