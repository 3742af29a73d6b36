"""Arrays as signals: masks, crops, stitching plans, resizing, patches and norms. Lengths and positions count from 0."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def positions(n: Column | int) -> Column:
    """0 .. n-1, empty for n <= 0."""
    n = F.lit(n) if isinstance(n, int) else n
    return F.when(n > 0, F.sequence(F.lit(0), n.cast("int") - 1)).otherwise(F.array().cast("array<int>"))


def passed(ascending: Column, below: Column) -> Column:
    """How many items of an ascending array are not above a value, by halving."""
    steps = F.sequence(F.lit(1), F.length(F.bin(F.size(ascending))))
    whole = F.struct(F.lit(0).alias("lo"), F.size(ascending).alias("hi"))

    def half(acc: Column, _: Column) -> Column:
        mid = F.shiftright(acc["lo"] + acc["hi"], 1)
        more = (acc["lo"] < acc["hi"]) & F.coalesce(F.get(ascending, mid) <= below, F.lit(False))
        lo = F.when(more, mid + 1).otherwise(acc["lo"])
        return F.struct(lo.alias("lo"), F.greatest(lo, F.when(more, acc["hi"]).otherwise(mid)).alias("hi"))

    return F.aggregate(steps, whole, half, lambda acc: acc["lo"])


def min_max(x: Column, low: float, high: float) -> Column:
    """Clamped to [low, high] and brought to [0, 1]."""
    return (clamp(x, low, high) - low) / F.lit(float(high - low))


def zeros(n: Column) -> Column:
    return F.array_repeat(F.lit(0.0), F.greatest(n, F.lit(0)).cast("int"))


def prefix_mask(length: Column, n: Column | int) -> Column:
    return F.transform(positions(n), lambda i: (i < length).cast("int"))


def chunk_count(n: Column, c: int) -> Column:
    return F.ceil(n / F.lit(c)).cast("int")


def chunk_plan(n: Column, c: int) -> Column:
    """array<struct<idx, start, valid>> of tumbling chunks; none for n = 0."""
    return F.transform(positions(chunk_count(n, c)), lambda k: F.struct(k.alias("idx"), (k * c).alias("start"), F.least(F.lit(c), n.cast("int") - k * c).alias("valid")))


def overlap_starts(n: Column, c: int, overlap: int) -> Column:
    """Starts of chunks of c that overlap, the last one anchored at the end; one start of 0 where n < c."""
    hop = c - overlap
    return F.when(n < c, F.array(F.lit(0))).otherwise(F.array_distinct(F.concat(F.sequence(F.lit(0), n.cast("int") - c, F.lit(hop)), F.array(n.cast("int") - c))))


def stitch_plan(n: Column, c: int, overlap: int) -> Column:
    """array<struct<start, lo, hi>>: of each overlapping chunk the part [lo, hi) that is written, half an overlap off
    inner edges. Later chunks overwrite earlier ones."""
    half = overlap // 2
    starts = overlap_starts(n, c, overlap)
    last = F.size(starts) - 1
    size = F.least(n.cast("int"), F.lit(c))
    return F.transform(starts, lambda s, k: F.struct(s.alias("start"), F.when(k == 0, 0).otherwise(half).alias("lo"), F.when(k == last, size).otherwise(c - half).alias("hi")))


def nearest(x: Column, out: int) -> Column:
    """Nearest resize: index floor(i * n / out)."""
    return F.when(F.size(x) > 0, F.transform(positions(out), lambda i: F.get(x, F.floor(i * F.size(x) / F.lit(float(out))).cast("int"))))


def resized_length(valid: Column, n: Column, out: int) -> Column:
    """Valid length after a resize, rounded up."""
    return F.ceil(valid * F.lit(out) / n).cast("int")


def interval_mask(n: Column, regions: Column, end: Column | None = None) -> Column:
    """1 outside, 0 inside of any region [s, e) and from ``end`` on."""
    inside = lambda i: F.exists(regions, lambda r: (i >= r["s"]) & (i < r["e"]))
    past = (lambda i: i >= end) if end is not None else (lambda i: F.lit(False))
    return F.transform(positions(n), lambda i: F.when(inside(i) | past(i), 0).otherwise(1))


def crop_or_pad(x: Column, start: Column, n: int, pad: bool = True) -> Column:
    """n items from start; zeros behind where the input ends."""
    cut = F.slice(x, start + 1, n)
    return F.concat(cut, zeros(F.lit(n) - F.size(cut))) if pad else cut


def tile_pad(x: Column, n: int, fill: Column) -> Column:
    """The first n items; what is missing comes from ``fill``, repeated (zeros where it is null or empty)."""
    short = F.greatest(F.lit(n) - F.size(x), F.lit(0))
    tiled = F.slice(F.flatten(F.array_repeat(fill, F.ceil(short / F.size(fill)).cast("int"))), 1, short)
    return F.slice(F.concat(x, F.when(F.size(fill) > 0, tiled).otherwise(zeros(short))), 1, n)


def patch(x: Column, h: int) -> Column:
    """(l h) to h rows of l; zero-padded to a multiple of h."""
    l_ = F.ceil(F.size(x) / h).cast("int")
    full = F.concat(x, zeros(l_ * h - F.size(x)))
    return F.transform(positions(h), lambda j: F.transform(positions(l_), lambda i: F.get(full, i * h + j)))


def unpatch(rows: Column) -> Column:
    h, l_ = F.size(rows), F.size(F.get(rows, F.lit(0)))
    return F.transform(positions(h * l_), lambda k: F.get(F.get(rows, k % h), F.floor(k / h).cast("int")))


def repeat_each(x: Column, times: int) -> Column:
    return F.flatten(F.transform(x, lambda v: F.array_repeat(v, times)))


def align_left(x: Column, n: int) -> Column:
    """The last n items, zeros in front where there are fewer."""
    return F.concat(zeros(F.lit(n) - F.size(x)), F.slice(x, F.greatest(F.size(x) - n, F.lit(0)) + 1, n))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, v: s + v)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def total(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda s, v: s + v.cast("double"))


def mean(a: Column) -> Column:
    return total(a) / F.size(a)


def energy(a: Column) -> Column:
    return dot(a, a) / F.size(a)


def peak(a: Column) -> Column:
    return F.array_max(F.transform(a, lambda v: F.abs(v.cast("double"))))


def decibel(x: Column, floor: float = 1e-10) -> Column:
    return 20 * F.log10(x + F.lit(floor))


def is_silent(a: Column, threshold: float = -60.0) -> Column:
    """Peak below the threshold; all zeros and empty are silent."""
    p = F.coalesce(peak(a), F.lit(0.0))
    return (p == 0) | (F.coalesce(20 * F.log10(p), F.lit(float("-inf"))) < threshold)


def active_length(a: Column, hop: int, threshold: float = -60.0, shortest_tail: int = 0) -> Column:
    """Length without the silent tail, in whole frames of hop; a tail shorter than given stays; under a frame unchanged;
    nothing active is 0."""
    n = F.size(a)
    frames = F.floor(n / hop).cast("int")
    loud = F.transform(positions(frames), lambda k: F.when(decibel(peak(F.slice(a, k * hop + 1, hop))) > threshold, k))
    last = F.array_max(F.filter(loud, lambda k: k.isNotNull()))
    end = (last + 1) * hop
    return F.when(frames < 1, n).when(last.isNull(), 0).when(n - end < F.greatest(F.lit(shortest_tail), F.lit(1)), n).otherwise(end)


def to_channels(rows: Column, n: int) -> Column:
    """Mono to more channels by repetition, more to mono by the mean, else the first n."""
    mono = F.transform(positions(F.size(F.get(rows, F.lit(0)))), lambda i: total(F.transform(rows, lambda r: F.get(r, i))) / F.size(rows))
    if n == 1:
        return F.when(F.size(rows) == 1, F.transform(rows, lambda r: r.cast("array<double>"))).otherwise(F.array(mono))
    return F.when(F.size(rows) == 1, F.array_repeat(F.get(rows, F.lit(0)), n)).otherwise(F.slice(rows, 1, n))


def flip(x: Column, on: Column) -> Column:
    return F.when(on, F.transform(x, lambda v: -v)).otherwise(x)


def fill_padding(x: Column, mask: Column, how: str = "none", value: float = 0.0) -> Column:
    """Masked-out items as they are, zero, or a learned value."""
    if how == "none":
        return x
    return F.zip_with(x, mask, lambda v, m: F.when(m > 0, v).otherwise(F.lit(0.0 if how == "zero" else value)))


def latent_length(seconds: Column, rate: int, ratio: int) -> Column:
    return F.ceil(F.floor(seconds * rate) / ratio).cast("int")


def align_up(x: Column, step: int) -> Column:
    return (F.ceil(x / step) * step).cast("int")


def gain(x: Column, change_db: Column, highest: float = 0.95) -> Column:
    """Scaled by decibels, then brought under ``highest`` if it clips."""
    scale = F.pow(F.lit(10.0), change_db / 20)
    up = peak(x) * scale
    factor = F.when(up > highest, F.lit(highest) / peak(x)).otherwise(scale)
    return _once(factor, lambda f: F.transform(x, lambda v: v * f))


def clamp(x: Column, lo: float, hi: float) -> Column:
    return F.greatest(F.least(x, F.lit(hi)), F.lit(lo))


def pcm16(x: Column) -> Column:
    return F.transform(x, lambda v: (clamp(v, -1.0, 1.0) * 32767).cast("smallint"))


def _once(value: Column, use) -> Column:
    """use(value) with the value computed once and not for every element of a lambda inside."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def project(v0: Column, v1: Column) -> Column:
    """struct<parallel, orthogonal> of v0 by v1's direction."""

    def parts(s: Column) -> Column:
        par = F.transform(v1, lambda x: x * s)
        return F.struct(par.alias("parallel"), F.zip_with(v0, v1, lambda a, x: a - x * s).alias("orthogonal"))

    size = F.greatest(norm(v1), F.lit(1e-12))
    return _once(dot(v0, v1) / size / size, parts)


def guide(x: Column, cond: Column, uncond: Column, sigma: Column, scale: float, apg: float = 0.0, threshold: float = 0.0) -> Column:
    """Classifier-free guidance of a flow output, optionally projected and bounded by a norm."""
    denoise = lambda out: F.zip_with(x, out, lambda a, o: a - o * sigma)
    c, u = denoise(cond), denoise(uncond)
    diff = F.zip_with(c, u, lambda a, b: a - b)
    if threshold > 0:
        # norm 0 divides to null, which least() passes over
        bounded = lambda d: _once(F.least(F.lit(1.0), F.try_divide(F.lit(float(threshold)), norm(d))), lambda f: F.transform(d, lambda v: v * f))
    else:
        bounded = lambda d: d

    def blended(d: Column) -> Column:
        if not apg:
            return d
        return F.zip_with(project(d, c)["orthogonal"], d, lambda o, v: o * apg + v * (1 - apg))

    done = _once(bounded(diff), lambda d: F.zip_with(c, blended(d), lambda a, v: a + (scale - 1) * v))
    return F.zip_with(x, done, lambda a, d: (a - d) / sigma)


def fourier(x: Column, n: int, low: float, high: float) -> Column:
    """cos then sin of x at n frequencies, evenly spaced in the logarithm."""
    import math

    step = (math.log(high) - math.log(low)) / max(1, n - 1)
    freq = lambda k: F.exp(F.lit(math.log(low)) + k * step) * (2 * math.pi)
    return F.concat(F.transform(positions(n), lambda k: F.cos(x * freq(k))), F.transform(positions(n), lambda k: F.sin(x * freq(k))))


def rotary(x: Column, position: Column, base: float = 10_000.0) -> Column:
    """Rotary embedding: the halves of x turned by position-dependent angles."""
    half = F.floor(F.size(x) / 2).cast("int")
    angle = lambda k: position * F.pow(F.lit(base), -k / half)
    first = F.transform(positions(half), lambda k: F.get(x, k) * F.cos(angle(k)) - F.get(x, k + half) * F.sin(angle(k)))
    second = F.transform(positions(half), lambda k: F.get(x, k + half) * F.cos(angle(k)) + F.get(x, k) * F.sin(angle(k)))
    return F.concat(first, second)
