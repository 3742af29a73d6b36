"""Timestep schedules and their shifts as columns; t = 0 is data, t = 1 noise."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def identity(t: Column, length: Column) -> Column:
    return t


def flux(t: Column, length: Column, low: int = 256, high: int = 4096, alpha_low: float = 1.0, alpha_high: float = 1.0) -> Column:
    """alpha t / (1 + (alpha - 1) t), alpha log-linear in the length."""
    span = math.log(high) - math.log(low) or 1e-8
    n = F.greatest(F.least(length.cast("double"), F.lit(float(high))), F.lit(float(low)))
    a0, a1 = math.log(max(alpha_low, 1e-8)), math.log(max(alpha_high, 1e-8))
    alpha = F.exp(F.lit(a0) + (F.ln(n) - math.log(low)) / span * (a1 - a0))
    return alpha * t / (1 + (alpha - 1) * t)


def full(t: Column, length: Column, base: float = 0.5, top: float = 1.15, low: int = 256, high: int = 4096, sine: bool = False) -> Column:
    n = F.greatest(F.least(length.cast("double"), F.lit(float(high))), F.lit(float(low)))
    mu = -(F.lit(base) + (top - base) * (n - low) / (high - low))
    odds = F.try_divide(F.lit(1.0), 1 - t) - 1
    out = F.when(t >= 1, F.lit(1.0)).otherwise(1 - F.exp(mu) / (F.exp(mu) + odds))
    return F.sin(out * (math.pi / 2)) if sine else out


def log_snr(t: Column, length: Column, anchor_length: float = 2000.0, anchor: float = -6.2, rate: float = 1.0, end: float = 2.0) -> Column:
    """Even steps in log-SNR; the noisy end falls by ``rate`` for each doubling of the length. Ends stay 0 and 1."""
    start = F.lit(anchor) - rate * F.log2(length.cast("double") / anchor_length)
    out = 1 / (1 + F.exp(F.lit(end) - t * (F.lit(end) - start)))
    return F.when(t <= 0, 0.0).when(t >= 1, 1.0).otherwise(out)


SHIFTS = {"none": identity, "flux": flux, "full": full, "logsnr": log_snr}
#: The shift where none is named.
DEFAULT = {"name": "logsnr", "rate": 0.0, "anchor": -6.2, "end": 2.0}


def shift(name: str | None = None):
    """A shift function of (t, length) by name; without one, the default."""
    if name is None:
        return lambda t, n: log_snr(t, n, rate=DEFAULT["rate"], anchor=DEFAULT["anchor"], end=DEFAULT["end"])
    if name not in SHIFTS:
        raise ValueError(f"unknown shift {name}")
    return SHIFTS[name]


def schedule(steps: int, length: Column, how=identity, sigma_max: float = 1.0, endpoint: bool = True) -> Column:
    """array<double> from sigma_max down to 0 (left out without endpoint), shifted; the first value stays sigma_max."""
    n = F.greatest(length.cast("double"), F.lit(1.0))
    last = steps if endpoint else steps - 1
    points = F.sequence(F.lit(0), F.lit(last))
    return F.transform(points, lambda k: F.when(k == 0, F.lit(float(sigma_max))).otherwise(how(F.lit(float(sigma_max)) * (F.lit(1.0) - k / F.lit(float(steps))), n)))


def steps_of(t: Column) -> Column:
    """Differences of neighbours."""
    return F.transform(F.sequence(F.lit(1), F.size(t) - 1), lambda k: F.get(t, k) - F.get(t, k - 1))


def warm_inverse(step: Column, inv_gamma: float = 1.0, power: float = 1.0, warmup: float = 0.0, lowest: float = 0.0, rate: float = 1.0) -> Column:
    """Inverse decay of a learning rate with an exponential warm-up."""
    up = 1 - F.pow(F.lit(warmup), step + 1)
    return up * F.greatest(F.lit(lowest), rate * F.pow(1 + step / inv_gamma, F.lit(-power)))


def ema_decay(step: Column, beta: float = 0.9999, power: float = 2 / 3, inv_gamma: float = 1.0) -> Column:
    return F.greatest(F.least(1 - F.pow(1 + step / inv_gamma, F.lit(-power)), F.lit(beta)), F.lit(0.0))
