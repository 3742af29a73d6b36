"""Short-time spectra and mel filter banks, as an Arrow function over arrays of samples."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def mel_filters(bins: int, n_mels: int, rate: int) -> np.ndarray:
    """(n_mels, bins) triangles even on the HTK mel scale, each of unit area."""
    to_mel = lambda f: 2595 * np.log10(1 + f / 700)
    edges = 700 * (10 ** (np.linspace(0, to_mel(rate / 2), n_mels + 2) / 2595) - 1)
    f = np.linspace(0, rate / 2, bins)
    up = (f[None] - edges[:-2, None]) / np.diff(edges)[:-1, None]
    down = (edges[2:, None] - f[None]) / np.diff(edges)[1:, None]
    return np.maximum(0, np.minimum(up, down)) * (2 / (edges[2:] - edges[:-2]))[:, None]


def power_to_db(p: np.ndarray, span: float = 80.0) -> np.ndarray:
    db = 10 * np.log10(np.maximum(p, 1e-10))
    return np.maximum(db, db.max() - span) if db.size else db


def mel_spectrogram(x: np.ndarray, rate: int, n_fft: int = 1024, n_mels: int = 128) -> np.ndarray:
    """(n_mels, frames) in decibels; hop of half a frame, reflected ends, Hann window."""
    hop, half = n_fft // 2, n_fft // 2
    if len(x) == 0:
        return np.zeros((n_mels, 0))
    padded = np.pad(x, half, mode="reflect") if len(x) > half else np.pad(x, half)
    n = 1 + (len(padded) - n_fft) // hop
    frames = padded[np.arange(n)[:, None] * hop + np.arange(n_fft)]
    window = 0.5 - 0.5 * np.cos(2 * np.pi * np.arange(n_fft) / n_fft)
    power = np.abs(np.fft.rfft(frames * window, axis=1)) ** 2
    return power_to_db(mel_filters(n_fft // 2 + 1, n_mels, rate) @ power.T)


def mel(x: Column, rate: int, n_fft: int = 1024, n_mels: int = 128) -> Column:
    @F.pandas_udf("array<array<double>>")
    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda v: None if v is None else mel_spectrogram(np.asarray(v, float), rate, n_fft, n_mels).tolist())

    return run(x)
