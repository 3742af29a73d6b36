"""String and metadata functions as columns."""

from __future__ import annotations

import copy
import itertools
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Words that mark a vocal prompt (fixed values).
VOCAL = r"\b(vocals?|singing|singer|female|male|voice|voices|chorus|rap|rapper|chant(ing)?|lyrics?)\b"
#: Line breaks, and other white space, as characters of a class.
_BREAKS = r"\n-\r\x1c-\x1e\x85\u2028\u2029"
_BLANKS = r"\t\x1f\x20\xa0\u1680\u2000-\u200a\u202f\u205f\u3000"
_SPACE = f"[{_BREAKS}{_BLANKS}]"
#: A "Genre:" line with blank lines before it, and the "Sub-genre(s):" lines right after it.
_HEADING = (
    rf"\A{_SPACE}*+(?i:Genre)[{_BLANKS}]*+:[^{_BREAKS}]*+"
    rf"(?:(?:\r\n|[{_BREAKS}])[{_BLANKS}]*+(?i:Sub[- ]?genres?)[{_BLANKS}]*+:[^{_BREAKS}]*+)*+"
)


def strip(x: Column) -> Column:
    """Unicode white space off both ends, in linear time: a run inside is entered at its first character only. Printable
    ASCII is told apart first, as the whole class is slow."""
    return F.regexp_replace(x, rf"\A{_SPACE}++|[^!-~](?![!-~])(?<={_SPACE})(?<!{_SPACE}{{2}}){_SPACE}*+\z", "")


def valid_prompt(x: Column) -> Column:
    """Not null and not blank."""
    return x.isNotNull() & (strip(x) != "")


def all_valid(fields: list[Column]) -> Column:
    return F.forall(F.array(*fields), valid_prompt)


def any_present(bag: Column, names: list[str]) -> Column:
    """Some of the names is a key of the map."""
    return F.exists(F.array(*[F.lit(n) for n in names]), lambda n: F.map_contains_key(bag, n))


def truthy(x: Column) -> Column:
    return F.coalesce(F.lower(strip(x)).isin("1", "true", "t", "yes", "y"), F.lit(False))


def null_condition(x: Column) -> Column:
    """Null, NaN, or a word for nothing."""
    return x.isNull() | F.lower(strip(x.cast("string"))).isin("", "none", "null", "nan")


def safe_part(x: Column, fallback: str = "item", longest: int = 200) -> Column:
    """A path part: stripped, odd runs to '_', cut to length."""
    x = F.coalesce(F.nullif(strip(x), F.lit("")), F.lit(fallback))
    return F.substring(F.regexp_replace(x, r"(?U)[^\w.\-]+", "_"), 1, longest)


def stem(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]+?)(\.[^./]*)?$", 1)


def output_base(sample_id: Column, uri: Column) -> Column:
    """The id, made safe, or where it is null or blank the name of the URI."""
    given = F.nullif(strip(sample_id.cast("string")), F.lit(""))
    return F.when(given.isNotNull(), safe_part(given)).otherwise(safe_part(stem(uri)))


def row_base(sample: Column) -> Column:
    """A chunk's name without its number."""
    return F.regexp_replace(sample, r"_\d+$", "")


def strip_heading(x: Column) -> Column:
    """Without a leading "Genre:" line, "Sub-genre(s):" lines after it and one blank line; trimmed."""
    body = F.regexp_replace(F.regexp_replace(x, _HEADING, ""), rf"[^ -~](?<=[{_BREAKS}])(?<!\n)(?:(?<=\r)\n)?+", "\n")
    return F.when(x.rlike(_HEADING), strip(body)).when(x.rlike(f"[^{_BREAKS}{_BLANKS}]"), strip(x)).otherwise(x)


def subgenres(x: Column) -> Column:
    """Trimmed, not empty items of a comma list."""
    return F.filter(F.transform(F.split(F.coalesce(x, F.lit("")), ","), strip), lambda v: v != "")


def genre_prefix(main: Column, subs: Column, most: int = 3) -> Column:
    """'Main: a, b, c.' of up to three other subgenres, 'Main.' without, '' without a main genre."""
    main = strip(main)
    others = F.slice(F.filter(subs, lambda v: F.lower(v) != F.lower(main)), 1, most)
    text = F.when(F.size(others) > 0, F.concat(main, F.lit(": "), F.array_join(others, ", "), F.lit("."))).otherwise(F.concat(main, F.lit(".")))
    return F.when(F.coalesce(main, F.lit("")) == "", "").otherwise(text)


def tempo(x: Column) -> Column:
    """Half-even rounded number, null where it is not one."""
    v = x.cast("string").try_cast("double")
    return F.when(~F.isnan(v), F.rint(v).cast("int"))


def tempo_text(bucket: Column, bpm: Column, text: Column) -> Column:
    lead = F.when(bucket.isin("dense", "vivid"), F.concat(bpm.cast("string"), F.lit(" BPM. "))).otherwise(F.concat(bpm.cast("string"), F.lit(" BPM ")))
    return F.when(bpm.isNotNull(), F.concat(lead, text)).otherwise(text)


def has_artifacts(x: Column, most_words: int = 45) -> Column:
    """Brackets or marks, vocal words, no closing length statement, or too many words."""
    many = F.size(F.filter(F.split(x, r"(?U)\s+"), lambda w: w != "")) > most_words
    return x.rlike(r"[\[\]*#]") | x.rlike("(?i)" + VOCAL) | ~x.rlike(r"\. Length: \d+ seconds\.?\s*$") | many


def stated_seconds(x: Column) -> Column:
    return F.regexp_extract(x, r" Length: (\d+) seconds", 1).try_cast("int")


def tidy_prompt(raw: Column) -> Column:
    """After a closing thought, without a list dash, sentences capitalised."""
    body = F.when(F.contains(raw, F.lit("</think>")), strip(F.substring_index(raw, "</think>", -1))).otherwise(raw)
    body = strip(F.when(F.startswith(body, F.lit("- ")), F.substring(body, 3, 1 << 30)).otherwise(body))
    parts = F.split(body, r"(?<=\.\s)")
    return F.array_join(F.transform(parts, lambda p: F.concat(F.upper(F.substring(p, 1, 1)), F.substring(p, 2, 1 << 30))), "")


def examples(x: Column) -> Column:
    return F.transform(F.regexp_extract_all(x, F.lit(r"(?m)^- (.+)"), F.lit(1)), strip)


def condense(x: Column, longest: int = 150) -> Column:
    """A file name of a prompt."""
    name = F.substring(F.regexp_replace(F.coalesce(x, F.lit("")), r'[\\/:*?"<>|]', "-"), 1, longest)
    return F.when(name == "", "_").otherwise(name)


def slug(x: Column, longest: int = 48) -> Column:
    s = F.regexp_replace(F.regexp_replace(F.lower(x), r"[^a-z0-9]+", "_"), r"^_+|_+$", "")
    return F.substring(s, 1, longest)


def bracket_patterns(pattern: str) -> list[str]:
    """'a[0-2]' to a0, a1, a2; runs may descend; several brackets multiply."""
    parts = re.split(r"\[(\d+)-(\d+)\]", pattern)
    runs = []
    for a, b in zip(parts[1::3], parts[2::3], strict=True):
        a, b = int(a), int(b)
        runs.append([str(k) for k in (range(a, b + 1) if a <= b else range(a, b - 1, -1))])
    fixed = parts[0::3]
    return ["".join(x + y for x, y in itertools.zip_longest(fixed, (*pick, ""), fillvalue="")) for pick in itertools.product(*runs)]


def name_matches(name: Column, include: list[str], exclude: list[str] = ()) -> Column:
    """Contains some included and no excluded pattern; exclusion wins, no inclusion list means all."""
    some = lambda pats: F.exists(F.array(*[F.lit(p) for q in pats for p in bracket_patterns(q)]), lambda p: F.contains(name, p))
    ok = some(include) if include else F.lit(True)
    return ok & ~some(exclude) if exclude else ok


def layer_toggle(name: Column, off: str) -> Column:
    """False for layers named in a comma list."""
    names = [x.strip().lower() for x in off.split(",") if x.strip()]
    return ~F.exists(F.array(*[F.lit(x) for x in names]), lambda p: F.contains(F.lower(name), p)) if names else F.lit(True)


def duration(seconds: Column) -> Column:
    """1h02m03s, 2m03s or 3s."""
    s = F.greatest(seconds.cast("long"), F.lit(0))
    h, m, r = F.floor(s / 3600), F.floor(s % 3600 / 60), s % 60
    return F.when(h > 0, F.format_string("%dh%02dm%02ds", h, m, r)).when(m > 0, F.format_string("%dm%02ds", m, r)).otherwise(F.format_string("%ds", r))


def iso_date(seconds: Column) -> Column:
    """A UTC date, 2024-01-31, from seconds since 1970, whatever the session's time zone."""
    return F.date_format(F.date_add(F.lit("1970-01-01").cast("date"), F.floor(seconds / 86_400).cast("int")), "yyyy-MM-dd")


def utc_stamp(seconds: Column) -> Column:
    """A UTC time, 2024-01-31T12:00:00Z, from seconds since 1970, whatever the session's time zone."""
    days = F.floor(seconds / 86_400)
    rest = seconds - days * 86_400
    day = F.date_add(F.lit("1970-01-01").cast("date"), days.cast("int"))
    clock = F.format_string("T%02d:%02d:%02dZ", F.floor(rest / 3600).cast("int"), F.floor(rest % 3600 / 60).cast("int"), (rest % 60).cast("int"))
    return F.concat(F.date_format(day, "yyyy-MM-dd"), clock)


def nested_update(base: dict, change: dict) -> dict:
    """A copy of a configuration with another put over it, level by level; neither input changes."""
    out = copy.deepcopy(base)
    for k, v in change.items():
        out[k] = nested_update(out[k], v) if isinstance(v, dict) and isinstance(out.get(k), dict) else copy.deepcopy(v)
    return out


def listing_name(line: Column) -> Column:
    """The name of an object listing line (date, time, size, name); null for folders."""
    name = F.regexp_replace(line, r"^\S+\s+\S+\s+\d+\s+", "")
    return F.when(~F.endswith(name, F.lit("/")), name)


def plain(x: Column) -> Column:
    """Without terminal colour codes."""
    return F.regexp_replace(x, "\\x1b\\[[0-9;]*m", "")


def named_number(x: Column, name: str) -> Column:
    return F.regexp_extract(plain(x), rf"(?i){re.escape(name)}\s*[:=]\s*(-?\d+(?:\.\d+)?)", 1).try_cast("double")


def track_kind(x: Column) -> Column:
    """Routing by stated track type."""
    low = F.lower(x)
    has = lambda s: F.contains(low, F.lit(s))
    return (
        F.when(has("tracktype: music") & has("vocaltype: instrumental"), "music")
        .when(has("tracktype: instrument"), "instrument")
        .when(has("tracktype: sfx"), "sfx")
        .otherwise("unknown")
    )


def name_part(name: Column, back: int) -> Column:
    """A dotted name's part, counted from the end (1: last)."""
    return F.try_element_at(F.split(name, r"\."), F.lit(-back))


def is_adapter(name: Column) -> Column:
    return F.exists(F.split(name, r"\."), lambda p: F.startswith(p, F.lit("lora_")))


def is_bias(name: Column) -> Column:
    return name_part(name, 1) == "bias"
