"""Iterative samplers over rows (id, x, t): x follows a schedule t under a pluggable model v = model(x, t)."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import arrays as A
from ..functions import schedules as S
from .conditioning import mix_init

Model = Callable[[np.ndarray, np.ndarray], np.ndarray]
#: Called in the worker after each step with i, x, t, sigma and denoised of the rows that are advanced together.
Callback = Callable[[dict], None]


def toy_model(x: np.ndarray, t: np.ndarray) -> np.ndarray:
    """A deterministic stand-in: the flow whose data are half of x at full noise."""
    return x / (1 + t[:, None])


def euler(model: Model, x: np.ndarray, t: np.ndarray, rng: list | None = None) -> np.ndarray:
    for a, b in zip(t.T[:-1], t.T[1:], strict=True):
        x = x + (b - a)[:, None] * model(x, a)
    return x


def rk4(model: Model, x: np.ndarray, t: np.ndarray, rng: list | None = None) -> np.ndarray:
    for a, b in zip(t.T[:-1], t.T[1:], strict=True):
        h = (b - a)[:, None]
        mid = (a + b) / 2
        k1 = model(x, a)
        k2 = model(x + h / 2 * k1, mid)
        k3 = model(x + h / 2 * k2, mid)
        k4 = model(x + h * k3, np.maximum(b, 1e-5))
        x = x + h / 6 * (k1 + 2 * (k2 + k3) + k4)
    return x


def dpmpp(model: Model, x: np.ndarray, t: np.ndarray, rng: list | None = None) -> np.ndarray:
    """Second order in log-SNR; first order on the first step and where t reaches 0."""
    tiny = 1e-10
    snr = lambda s: np.log(np.maximum(1 - s, tiny) / np.maximum(s, tiny))
    old = None
    for i in range(t.shape[1] - 1):
        now, nxt = t[:, i], t[:, i + 1]
        clean = x - now[:, None] * model(x, now)
        use = clean
        if old is not None and not (nxt == 0).all():
            r = (snr(now) - snr(t[:, i - 1])) / (snr(nxt) - snr(now))
            use = clean + (clean - old) / (2 * r[:, None])
        keep = nxt / np.maximum(now, tiny)
        gain = (1 - nxt) * (nxt - now) / (np.maximum(1 - nxt, tiny) * np.maximum(now, tiny))
        x, old = keep[:, None] * x - gain[:, None] * use, clean
    return x


def ping_pong(model: Model, x: np.ndarray, t: np.ndarray, rng: list | None = None) -> np.ndarray:
    for a, b in zip(t.T[:-1], t.T[1:], strict=True):
        clean = x - a[:, None] * model(x, a)
        x = (1 - b)[:, None] * clean + b[:, None] * np.stack([g.standard_normal(x.shape[1]) for g in rng])
    return x


SAMPLERS = {"euler": euler, "rk4": rk4, "dpmpp": dpmpp, "pingpong": ping_pong}


def _watched(model: Model, callback: Callback) -> Model:
    """A model that reports the first look at every noise level."""
    step, last = 0, None

    def look(x: np.ndarray, t: np.ndarray) -> np.ndarray:
        nonlocal step, last
        v = model(x, t)
        if last is None or (t < last).all():
            callback({"i": step, "x": x, "t": t, "sigma": t, "denoised": x - t[:, None] * v})
            step, last = step + 1, t
        return v

    return look


def sample(df: DataFrame, how: str = "euler", model: Model = toy_model, seed: int = 0, callback: Callback | None = None) -> DataFrame:
    """(id, x): rows of one width and schedule length are advanced together; noise follows from seed and id. A callback
    sees each noise level the model is asked about, the midpoints of rk4 among them."""
    run = SAMPLERS[how]

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            ids = b.column("id").to_pylist()
            x, t = (b.column(c).to_pylist() for c in ("x", "t"))
            out: list = [None] * len(ids)
            shapes: dict[tuple[int, int], list[int]] = {}
            for k in range(len(ids)):
                shapes.setdefault((len(x[k]), len(t[k])), []).append(k)
            for rows in shapes.values():
                rng = [np.random.default_rng([seed, int(ids[k])]) for k in rows]
                asked = model if callback is None else _watched(model, callback)
                y = run(asked, np.array([x[k] for k in rows]), np.array([t[k] for k in rows]), rng)
                for k, v in zip(rows, y, strict=True):
                    out[k] = v.tolist()
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(out, pa.list_(pa.float64()))], names=["id", "x"])

    return df.select(df["id"].cast("long").alias("id"), "x", "t").mapInArrow(step, "id long, x array<double>")


def generate(df: DataFrame, steps: int, width: int, rate: int, ratio: int, how: str = "euler", shift=S.log_snr, headroom: float = 5.0, sigma_max: float = 1.0, model: Model = toy_model, decode: Callable[[Column], Column] | None = None) -> DataFrame:
    """(id, x, valid) of requests (id, noise, init, seconds_total): a run from noise to decoded signal.

    The schedule is shifted by the effective length, the one of seconds_total (the row's width where that is null). An
    init (null: none) is mixed with the noise at ``sigma_max``, from where its schedule then starts. After sampling and
    decoding, everything beyond the valid length, that of seconds_total plus headroom, is zero; a decoder returns
    ``ratio`` samples for each latent frame.
    """
    length = F.coalesce(A.latent_length(F.col("seconds_total"), rate, ratio), F.lit(width))
    valid = F.least(F.coalesce(A.latent_length(F.col("seconds_total"), rate, ratio) + int(headroom * rate / ratio), F.lit(width)), F.lit(width))
    varied = F.col("init").isNotNull()
    rows = df.select("id", valid.alias("valid"), F.when(varied, mix_init(F.col("init"), F.col("noise"), sigma_max)).otherwise(F.col("noise")).alias("x"), F.when(varied, S.schedule(steps, length, shift, sigma_max)).otherwise(S.schedule(steps, length, shift)).alias("t"))
    done = sample(rows, how, model).join(rows.select(F.col("id").cast("long").alias("id"), "valid"), "id")
    x = decode(F.col("x")) if decode else F.col("x")
    end = F.col("valid") * (ratio if decode else 1)
    return done.select("id", F.transform(x, lambda v, i: F.when(i < end, v).otherwise(0.0)).alias("x"), "valid")


def couple(cost: np.ndarray, rounds: int = 20) -> np.ndarray:
    """A one-to-one assignment (column for each row): entropic transport at the scale of the mean cost, rows and columns
    normalised in turn in logarithms, then for each row in turn the best column that is left."""
    score = -cost / max(float(np.mean(cost)), 1e-12)
    for k in range(2 * rounds):
        axis = 1 - k % 2
        top = score.max(axis, keepdims=True)
        score = score - top - np.log(np.exp(score - top).sum(axis, keepdims=True))
    out, free = np.empty(len(score), int), np.ones(score.shape[1], bool)
    for r, row in enumerate(score):
        out[r] = np.where(free, row, -np.inf).argmax()
        free[out[r]] = False
    return out


def couple_batches(df: DataFrame, batch: str, key: str, x: str, z: str) -> DataFrame:
    """(batch, key, z): in each batch the noise rows z dealt anew to the data rows x, for straighter paths.

    A batch is a training batch, of a size that one task holds; its rows are taken in the order of the key."""
    from pyspark.sql.types import ArrayType, DoubleType, StructType

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(key, kind="stable")
        a, b = (np.array(pdf[c].tolist(), float).reshape(len(pdf), -1) for c in (x, z))
        cost = np.square(a).sum(1)[:, None] + np.square(b).sum(1)[None] - 2 * a @ b.T
        return pd.DataFrame({batch: pdf[batch], key: pdf[key], z: [b[k].tolist() for k in couple(cost)]})

    out = StructType([df.schema[batch], df.schema[key]]).add(z, ArrayType(DoubleType()))
    return df.select(batch, key, x, z).groupBy(batch).applyInPandas(run, out)
