"""Random inpainting masks, seeded by row: 1 keeps, 0 is to be generated."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

KINDS = ("segments", "full", "causal", "spans")
#: Chances of 1, 2, 3 and 4 spans, in proportion (fixed values).
SPAN_COUNTS = (4, 2, 1, 1)
#: Positions of masks that are held at a time.
BLOCK = 1 << 22


def _spans(n: int, rng: np.random.Generator) -> np.ndarray:
    """Spans that do not overlap and cover a drawn share of the row; the longest is placed first."""
    mask = np.ones(n, np.int8)
    target = max(1, int(n * rng.uniform(0.2, 1.0)))
    k = 1 + int(rng.choice(len(SPAN_COUNTS), p=np.array(SPAN_COUNTS) / sum(SPAN_COUNTS)))
    cuts = np.sort(rng.integers(1, max(2, target), k - 1)) if target > 1 else np.zeros(0, int)
    sizes = sorted(np.diff(np.concatenate([[0], cuts, [target]])).tolist(), reverse=True)
    for size in (s for s in sizes if s > 0):
        free = lambda a: a + size <= n and mask[a : a + size].all()  # noqa: E731, B023
        tries = (int(a) for a in rng.integers(0, n - size + 1, 50)) if size <= n else ()
        at = next((a for a in tries if free(a)), None)
        if at is None:
            at = next((a for a in range(n - size + 1) if free(a)), None)
        if at is not None:
            mask[at : at + size] = 0
    return mask


def draw_mask(kind: str, n: int, rng: np.random.Generator) -> np.ndarray:
    mask = np.ones(n, np.int8)
    if kind == "full" or n == 0:
        mask[:] = 0
    elif kind == "causal":
        mask[int(rng.integers(0, n)) :] = 0
    elif kind == "segments":
        for _ in range(int(rng.integers(1, 4))):
            size = int(rng.integers(1, max(2, n // 2 + 1)))
            at = int(rng.integers(0, max(1, n - size + 1)))
            mask[at : at + size] = 0
    else:
        mask = _spans(n, rng)
    return mask


def random_masks(df: DataFrame, seed: int = 0) -> DataFrame:
    """(id, kind, mask) for rows (id, n)."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            out, held = [], 0
            for i, n in zip(pdf["id"], pdf["n"], strict=True):
                rng = np.random.default_rng([seed, int(i)])
                kind = KINDS[int(rng.integers(len(KINDS)))]
                out.append((i, kind, draw_mask(kind, int(n), rng).astype(np.int32)))
                held += int(n)
                if held > BLOCK:
                    yield pd.DataFrame(out, columns=["id", "kind", "mask"])
                    out, held = [], 0
            yield pd.DataFrame(out, columns=["id", "kind", "mask"])

    return df.select("id", "n").mapInPandas(run, "id long, kind string, mask array<int>")
