"""Benchmark decontamination by template canonicalisation (DataFrame functions only).

Numbers, names and units become typed placeholders, so that a question asked again with other values keeps its
template. Windows of template tokens are hash-joined with the benchmark's; of documents that meet an item, every
window is then compared, and values must fill an item's slots consistently.

Both sides list all of their windows, so that an item is met wherever it starts, also one of a single window. Tokens are
hashed once and windows are hashes of their tokens' hashes. Windows of mostly placeholders say little as templates;
they are compared with their values and count beside the others, so that a verbatim copy of numbers is found.

Values fill slots one to one: on a diagonal of matching windows, an item's value always meets the same value of the
document, and the other way round; templates of a diagonal that breaks this do not count.

Items of fewer than MIN_TOKENS tokens say nothing about a document; they are not looked for, too_short() lists them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common as C

WINDOW = 8
#: Share of an item's windows that a document must hold; plain tokens that a window must have to count as a template.
COVERAGE, PLAIN = 0.6, 4
#: Tokens that an item must have to be looked for.
MIN_TOKENS = 2
#: Benchmark windows (about 100 bytes each) and candidate documents (16 bytes each) up to these counts are broadcast.
BROADCAST_WINDOWS, BROADCAST_DOCS = 300_000, 1_000_000

#: Placeholders and the mark within a number, of the private use area; taken out of texts first.
NUMBER, NAME, UNIT, POINT = "\ue000", "\ue001", "\ue002", "\ue003"
_UNITS = (
    "kilometers|kilometres|meters|metres|centimeters|centimetres|miles|feet|inches|km|cm|mm|m|ft|mi|kilograms|grams|pounds|ounces|kg|mg|g|lb|lbs|oz|"
    "liters|litres|gallons|ml|l|seconds|minutes|hours|days|weeks|months|years|ms|s|min|h|dollars|cents|euros|usd|eur|percent|degrees|mph|kmh|kb|mb|gb|tb"
)
#: Words that often begin a sentence and are no names, in English, French, German and Spanish (fixed values).
_STARTERS = (
    "a|about|after|all|an|and|are|as|at|before|both|but|by|can|do|does|during|each|every|find|for|from|give|given|had|has|have|he|her|here|his|how|i|if|in|into|is|it|its|"
    "let|many|my|no|not|now|of|on|one|only|or|our|over|she|since|so|some|than|that|the|their|then|there|these|they|this|those|to|two|under|until|was|we|were|what|when|where|"
    "which|while|who|whose|why|will|with|you|your|"
    "au|aux|avec|ce|cette|ces|chaque|dans|de|des|du|elle|en|est|et|il|ils|la|le|les|mais|ne|nous|on|ou|par|pas|pour|que|quel|quelle|qui|sa|se|si|son|sont|sur|un|une|vous|"
    "aber|als|am|an|auch|auf|aus|bei|das|dem|den|der|die|durch|ein|eine|einem|einen|einer|er|es|ich|ihr|im|ist|mit|nach|nicht|oder|sie|sind|und|von|vor|was|wenn|wer|wie|wir|wo|zu|"
    "al|cada|como|con|cual|cuando|del|donde|el|ella|es|esta|este|la|las|lo|los|no|para|pero|por|que|se|si|sin|su|sus|un|una|y"
)


def tokens(text: Column, values: bool) -> Column:
    """Template tokens of a text; with values, a placeholder is followed by what it stands for.

    Names are capitalised words after a lower-case letter, digit or comma and one blank, and at the start of a text or
    sentence, unless they are words that often begin one; units follow a number.
    """
    v = (lambda group: f"${group}") if values else (lambda group: "")
    t = F.translate(F.coalesce(text, F.lit("")), NUMBER + NAME + UNIT + POINT, "")
    t = F.regexp_replace(t, r"[.,:/](?<=\p{Nd}[.,:/])(?=\p{Nd})", POINT)
    t = F.regexp_replace(t, r"(\p{Lu})(?<=[\p{Ll}\p{Nd},;][ \n]\p{Lu})(\p{Ll}+)", f"{NAME}{v(1)}{v(2)}")
    t = F.regexp_replace(t, rf"(?=\p{{Lu}})(?<=^|[.!?\n]|[.!?\n][ \n])(?!(?i:{_STARTERS})(?!\p{{Ll}}))(\p{{Lu}})(\p{{Ll}}+)", f"{NAME}{v(1)}{v(2)}")
    t = F.regexp_replace(t, rf"(?i)(\p{{Nd}}) ?({_UNITS})(?![\p{{L}}\p{{N}}])", f"$1 {UNIT}{v(2)}")
    t = F.regexp_replace(t, rf"(\p{{Nd}}[\p{{Nd}}{POINT}]*)", f" {NUMBER}{v(1)} ")
    return F.filter(F.split(F.lower(t), rf"[^\p{{L}}\p{{N}}{NUMBER}-{POINT}]+"), lambda x: x != "")


def _bare(token: Column) -> Column:
    """A token with its value, without it."""
    return F.when(_placeholder(token), F.substring(token, 1, 1)).otherwise(token)


def _placeholder(token: Column) -> Column:
    return F.substring(token, 1, 1).isin(NUMBER, NAME, UNIT)


def _enough(placeholders: Column, width: Column) -> Column:
    """Whether a window has plain tokens enough for a template."""
    return width - placeholders >= F.least(F.lit(PLAIN), F.ceil(width / 2))


def _template(window: Column) -> Column:
    """A window of tokens with values, without them."""
    return F.transform(window, _bare)


def _starts(n: Column, width: int) -> Column:
    return F.when(n >= width, F.sequence(F.lit(0), n - width)).otherwise(F.array().cast("array<int>"))


def _with_hash(df: DataFrame, window: str) -> DataFrame:
    """With exact and hash of a column's windows of w tokens with values; _hashes() gives the same hashes for all windows of a text."""
    df = df.withColumn("exact", ~_enough(F.size(F.filter(window, _placeholder)), F.col("w")))
    hashed = F.transform(F.when(F.col("exact"), F.col(window)).otherwise(_template(F.col(window))), lambda x: F.xxhash64(x))
    return df.withColumn("hash", F.xxhash64(F.when(F.col("exact"), -F.col("w")).otherwise(F.col("w")), hashed))


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(item_id, q, w, exact, hash, item): the windows of every item, materialised. An item shorter than the window is
    one window of its own length; windows of mostly placeholders are exact; items that are too short have none."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), tokens(F.col("text"), True).alias("tokens")).filter(F.col("item_id").isNotNull() & (F.size("tokens") >= MIN_TOKENS))
    items = items.withColumn("w", F.least(F.lit(window), F.size("tokens")))
    rows = items.select("item_id", "w", "tokens", F.explode(F.sequence(F.lit(0), F.size("tokens") - F.col("w"))).alias("q"))
    rows = rows.select("item_id", "q", "w", F.slice("tokens", F.col("q") + 1, F.col("w")).alias("item"))
    return C.materialize(_with_hash(rows, "item").select("item_id", "q", "w", "exact", "hash", "item"), "benchmark-windows")


def too_short(benchmark: DataFrame) -> DataFrame:
    """(item_id, n_tokens) of the items that are not looked for, with a null item_id or under MIN_TOKENS tokens."""
    n = F.size(tokens(F.col("text"), True))
    return benchmark.select(F.col("item_id").cast("long").alias("item_id"), n.alias("n_tokens")).filter(F.col("item_id").isNull() | (F.col("n_tokens") < MIN_TOKENS))


def _hashes(widths: list[int], exact: set[int]) -> Column:
    """Hashes of all windows, from the hashes of the tokens: plain, and for exact widths own (with values) and held (1 for a placeholder)."""
    at = lambda c, i, w: [F.get(c, i + k) for k in range(w)]  # noqa: E731; slice() copies the whole array for every window
    template = lambda i, w: F.xxhash64(F.lit(w), *at("plain", i, w))
    either = lambda i, w: F.when(_enough(sum(at("held", i, w), F.lit(0)), F.lit(w)), template(i, w)).otherwise(F.xxhash64(F.lit(-w), *at("own", i, w)))
    one = lambda w: F.transform(_starts(F.size("plain"), w), lambda i: (either if w in exact else template)(i, w))
    return F.flatten(F.array(*map(one, widths)))


def contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, coverage: float = COVERAGE) -> DataFrame:
    """doc_id, t (hash of the text), item_id, n_windows, n_found, coverage: documents that hold enough of an item.

    Null texts and items hold nothing; null item_ids and items that are too short are left out; a null doc_id is reported as null. Rows that repeat
    doc_id and text are reported once. Either table may be empty.
    """
    bench = benchmark_windows(benchmark, window)
    kinds = {(r["w"], r["exact"]) for r in bench.select("w", "exact").distinct().collect()}  # at most two a width
    widths, exact = sorted({w for w, _ in kinds}) or [window], {w for w, e in kinds if e}
    small = lambda df, n: F.broadcast(df) if C.fits(df, n) else df
    held = C.materialize(bench.select("hash", "item_id").distinct(), "benchmark-hashes")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("t"), F.col("text").cast("string").alias("text"))
    first = rows.select("doc_id", "t", tokens(F.col("text"), bool(exact)).alias("tokens"))
    hashed = [F.transform("tokens", lambda x: F.xxhash64(_bare(x) if exact else x)).alias("plain")]
    if exact:
        hashed += [F.transform("tokens", lambda x: F.xxhash64(x)).alias("own"), F.transform("tokens", lambda x: _placeholder(x).cast("int")).alias("held")]
    first = first.select("doc_id", "t", *hashed).select("doc_id", "t", F.explode(F.array_distinct(_hashes(widths, exact))).alias("hash"))
    pairs = C.materialize(first.join(small(held, BROADCAST_WINDOWS), "hash").select("doc_id", "t", "item_id").distinct(), "benchmark-candidates")

    some = C.materialize(pairs.select(F.col("doc_id").alias("d"), F.col("t").alias("u")).distinct(), "candidate-documents")
    texts = rows.join(small(some, BROADCAST_DOCS), [rows["doc_id"].eqNullSafe(F.col("d")), rows["t"] == F.col("u")], "left_semi").dropDuplicates(["doc_id", "t"])
    words = texts.select("doc_id", "t", tokens(F.col("text"), True).alias("tokens"))
    place = lambda w: F.transform(_starts(F.size("tokens"), w), lambda i: F.struct(i.alias("p"), F.lit(w).alias("w")))
    each = F.flatten(F.array(*[place(w) for w in widths]))
    at = words.select("doc_id", "t", "tokens", F.explode(each).alias("at")).select("doc_id", "t", "at.p", "at.w", F.slice("tokens", F.col("at.p") + 1, F.col("at.w")).alias("own"))
    at = _with_hash(at, "own").drop("w", "exact")
    same = F.when(F.col("exact"), F.col("own") == F.col("item")).otherwise(_template(F.col("own")) == _template(F.col("item")))
    met = at.join(small(bench.drop("w"), BROADCAST_WINDOWS), "hash").filter(same)
    slots = F.filter(F.arrays_zip("item", "own"), lambda x: ~F.col("exact") & _placeholder(x["item"]))
    met = met.select("doc_id", "t", "item_id", "q", "exact", (F.col("p") - F.col("q")).alias("diagonal"), slots.alias("slots"))
    met = C.materialize(met, "benchmark-matches")
    C.release(held, pairs, some)

    line = ["doc_id", "t", "item_id", "diagonal"]
    filled = met.select(*line, F.explode("slots").alias("s")).groupBy(*line, F.col("s.item").alias("slot")).agg(F.min("s.own").alias("a"), F.max("s.own").alias("b"))
    taken = met.select(*line, F.explode("slots").alias("s")).groupBy(*line, F.col("s.own").alias("slot")).agg(F.min("s.item").alias("a"), F.max("s.item").alias("b"))
    bad = filled.unionByName(taken).filter("a <> b").select(*[F.col(c).alias(f"bad_{c}") for c in line]).distinct()
    same = [met[c].eqNullSafe(F.col(f"bad_{c}")) for c in line]
    good = met.join(bad, same, "left").filter(F.col("bad_t").isNull() | (F.size("slots") == 0))
    # an item is held by its templates alone, as with other values, or by all windows, as in a verbatim copy
    template = F.when(~F.col("exact"), F.col("q"))
    total = bench.groupBy("item_id").agg(F.count(template).alias("n_templates"), F.count(F.lit(1)).alias("n_all"))
    found = good.groupBy("doc_id", "t", "item_id").agg(F.count_distinct(template).alias("templates"), F.count_distinct("q").alias("all"))
    out = found.join(total, "item_id")
    loose = (F.col("n_templates") > 0) & (F.col("templates") / F.greatest("n_templates", F.lit(1)) >= coverage)
    for name, one, other in (("n_windows", "n_templates", "n_all"), ("n_found", "templates", "all")):
        out = out.withColumn(name, F.when(loose, F.col(one)).otherwise(F.col(other)))
    out = out.withColumn("coverage", F.col("n_found") / F.col("n_windows"))
    return C.resting_on(out.filter(F.col("coverage") >= coverage).select("doc_id", "t", "item_id", "n_windows", "n_found", "coverage"), bench, met)


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs, with their columns, that hold no benchmark item."""
    found = contaminated(docs, benchmark)
    hit = C.materialize(found.select(F.col("doc_id").alias("__i"), F.col("t").alias("__t")).distinct(), "contaminated")
    C.release(found)
    keys = [F.col("doc_id").cast("long").eqNullSafe(F.col("__i")), F.xxhash64("text") == F.col("__t")]
    return docs.join(F.broadcast(hit) if C.fits(hit, BROADCAST_DOCS) else hit, keys, "left_anti")


def digest(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    return contaminated(docs, benchmark).select("doc_id", "item_id", "n_windows", "n_found", F.round("coverage", 6).alias("coverage"))
