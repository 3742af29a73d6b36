"""Quality classifier: regularised quadratic discriminant over transformed document statistics.

One pass turns whole texts into a short vector each; class sums of those vectors give means and covariances, which are
shrunk towards the pooled covariance and a scaled identity; a score comes from the difference of the two Mahalanobis
log-densities, by Cholesky factors computed once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

#: Byte classes: upper, lower, digit, blank, newline, full stops and commas, !?, marks, bar, brackets and quotes, other ASCII, beyond ASCII.
_CLASSES = [b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789", b" \t\r\x0b\x0c", b"\n", b".,;:", b"!?", b"#$%&*@~^", b"|", b"()[]{}<>\"'`/\\"]
_CLASS = np.full(256, 10, np.uint8)
_CLASS[128:] = 11
for _k, _members in enumerate(_CLASSES):
    _CLASS[list(_members)] = _k
_UPPER, _BLANK, _LINE, _MARK = 0, 3, 4, 7
N_CLASSES = 12
#: Transformed statistics of a document, in order.
NAMES = [*[f"share_{k}" for k in range(N_CLASSES)], "chars", "word_length", "words_a_line", "distinct_words", "distinct_lines", "repeated_marks", "capital_words", "mark_words"]
#: Shares of the pooled covariance and of the scaled identity in a class covariance.
POOLED, IDENTITY = 0.05, 0.001
#: Bytes of text that are counted at a time.
STRETCH = 256 << 10


def _tally(texts: list[bytes]) -> np.ndarray:
    """For each text the bytes of every class, then words, repeated marks, capital words and words that end in a mark."""
    n = np.fromiter(map(len, texts), np.int64, len(texts))
    # a newline before every text: no text is empty for reduceat, and words do not join
    data = np.frombuffer(b"\n" + b"\n".join(texts), np.uint8)
    start = np.cumsum(n + 1) - (n + 1)
    cls = _CLASS[data]
    total = lambda hit: np.add.reduceat(hit, start, dtype=np.int64)
    counts = [total(cls == k) for k in range(N_CLASSES)]
    counts[_LINE] = counts[_LINE] - 1
    gap = (cls == _BLANK) | (cls == _LINE)
    first = np.zeros(len(data), bool)
    first[1:] = gap[:-1] & ~gap[1:]
    same = np.zeros(len(data), bool)
    same[1:] = (data[1:] == data[:-1]) & ~gap[1:] & (cls[1:] >= 5) & (cls[1:] <= 10)
    last = np.zeros(len(data), bool)
    last[:-1] = ~gap[:-1] & gap[1:]
    last[-1] = not gap[-1]
    second = np.zeros(len(data), bool)
    second[1:] = first[:-1] & (cls[1:] == _UPPER)
    return np.stack([*counts, total(first), total(same), total(second), total(last & (cls == _MARK))], 1)


def statistics(texts: list[bytes]) -> np.ndarray:
    """One row of NAMES for each text. Counts add up over stretches of a text; a word of over 512 KB counts once for
    every 512 KB or so."""
    n = np.fromiter(map(len, texts), np.int64, len(texts))
    out, tally = np.zeros((len(texts), len(NAMES))), np.zeros((len(texts), N_CLASSES + 4), np.int64)
    owners: list[int] = []
    held: list[bytes] = []
    size = 0

    def flush() -> None:
        nonlocal owners, held, size
        if held:
            np.add.at(tally, owners, _tally(held))
        owners, held, size = [], [], 0

    different = np.zeros((len(texts), 3), np.int64)  # words, different words, different lines
    for k, t in enumerate(texts):
        some: set[bytes] = set()
        for part in C.stretches(t, STRETCH, b" \n", hard=True):
            owners.append(k)
            held.append(part)
            size += len(part)
            split = part.split()
            different[k, 0] += len(split)
            some.update(split)
            if size >= STRETCH:
                flush()
        different[k, 1:] = len(some), len(set(t.split(b"\n")))
    flush()
    share = lambda hits, of: np.log((hits + 0.5) / (of + 1.0))
    words, same, capitals, marks = tally[:, N_CLASSES:].T
    out[:, :N_CLASSES] = share(tally[:, :N_CLASSES], n[:, None])
    lines = tally[:, _LINE] + 1
    out[:, N_CLASSES:] = np.stack(
        [
            np.log1p(n),
            np.log((n + 1.0) / (words + 1.0)),
            np.log((words + 1.0) / lines),
            share(different[:, 1], different[:, 0]),
            share(different[:, 2], lines),
            share(same, n),
            share(capitals, words),
            share(marks, words),
        ],
        1,
    )
    return out


def featurize(docs: DataFrame, name: str = "quality-features") -> DataFrame:
    """(doc_id, x) for every row, materialised; null text is empty. x is narrow whatever the length of a text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in C.pieces(whole):
                x = statistics(batch.column("text").cast(pa.large_binary()).fill_null(b"").to_pylist())
                flat = pa.ListArray.from_arrays(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32), pa.array(x.ravel()))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), flat], names=["doc_id", "x"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return C.materialize(rows.mapInArrow(run, "doc_id long, x array<double>"), name)


def class_sums(labelled: DataFrame, width: int) -> dict[int, tuple[float, np.ndarray, np.ndarray]]:
    """class -> (rows, sum of x, sum of x x^T) over (y, x). Summed in every task first, then by position."""
    size = 1 + width + width * width

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, size))
        for batch in batches:
            y = batch.column("y").to_numpy(zero_copy_only=False)
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            for k in (0, 1):
                v = x[y == k]
                sums[k] += np.concatenate([[len(v)], v.sum(0), (v.T @ v).ravel()])
        k, i = np.nonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(k.astype(np.int32)), pa.array(i.astype(np.int32)), pa.array(sums[k, i])], names=["y", "i", "v"])

    found: dict[int, np.ndarray] = {}
    for y, i, v in labelled.select("y", "x").mapInArrow(run, "y int, i int, v double").groupBy("y", "i").agg(F.sum("v")).collect():
        found.setdefault(y, np.zeros(size))[i] = v
    return {k: (s[0], s[1 : 1 + width], s[1 + width :].reshape(width, width)) for k, s in found.items()}


@dataclass
class Discriminant:
    """Prior log-odds of class 1 and, for each class, mean and inverse Cholesky factor; constant where a class is missing."""

    log_odds: float
    shift: np.ndarray
    scale: np.ndarray
    mean: list[np.ndarray] | None = None
    factor: list[np.ndarray] | None = None
    constant: float = 0.5

    @classmethod
    def fit(cls, sums: dict[int, tuple[float, np.ndarray, np.ndarray]], width: int, pooled: float = POOLED, identity: float = IDENTITY) -> Discriminant:
        n = {k: s[0] for k, s in sums.items() if s[0] > 0}
        unit = np.zeros(width), np.ones(width)
        if len(n) < 2:
            return cls(0.0, *unit, constant=float(next(iter(n), 0.5)))
        all_n = sum(n.values())
        shift = sum(sums[k][1] for k in n) / all_n
        scale = np.sqrt(np.maximum(np.diag(sum(sums[k][2] for k in n)) / all_n - shift**2, 1e-12))
        mean, cov = [], []
        for k in (0, 1):
            mu = sums[k][1] / n[k]
            c = (sums[k][2] / n[k] - np.outer(mu, mu)) / np.outer(scale, scale)
            mean.append((mu - shift) / scale)
            cov.append((c + c.T) / 2)
        both = (n[0] * cov[0] + n[1] * cov[1]) / all_n
        factor = []
        for c in cov:
            s = (1 - pooled) * c + pooled * both
            s = (1 - identity) * s + identity * max(np.trace(s) / width, 1e-3) * np.eye(width)
            factor.append(np.linalg.inv(np.linalg.cholesky(s)))
        return cls(float(np.log(n[1] / n[0])), shift, scale, mean, factor)

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.mean is None:
            return np.full(len(x), self.constant)
        z = (x - self.shift) / self.scale
        logs = [-0.5 * np.square((z - m) @ f.T).sum(1) + np.log(np.diag(f)).sum() for m, f in zip(self.mean, self.factor, strict=True)]
        return 1 / (1 + np.exp(-np.clip(logs[1] - logs[0] + self.log_odds, -700, 700)))


def fit(features: DataFrame, labels: DataFrame) -> Discriminant:
    """labels: (doc_id, y). Rows with a null doc_id or a label other than 0 and 1 are left out; repeated rows count."""
    known = labels.filter("doc_id is not null and y in (0, 1)").select(F.col("doc_id"), F.col("y").cast("int").alias("y"))
    return Discriminant.fit(class_sums(features.join(known, "doc_id"), len(NAMES)), len(NAMES))


def score(features: DataFrame, model: Discriminant) -> DataFrame:
    """(doc_id, score): the probability of class 1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, len(NAMES))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(model.score(x))], names=["doc_id", "score"])

    return features.mapInArrow(run, "doc_id long, score double")


def held_out():
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted for every row; learns from all labels that are not held out.

    Null and empty texts are scored like any other. A null doc_id is not held out. Without labels the score is 0.5;
    with labels of one class, that class. Extra columns are ignored.
    """
    features = featurize(docs)
    known = labels.filter(~held_out()).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").alias("y"))
    scored = score(features, fit(features, known))
    return scored.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
