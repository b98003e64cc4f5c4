"""Tail probabilities for the drift tests.

They run on one row per monitored column, after all data-sized work is done.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


def kolmogorov_tail(statistic: Column, n1: Column, n2: Column, terms: int = 100) -> Column:
    """Asymptotic two-sample Kolmogorov-Smirnov p-value: 2 * sum (-1)^(k-1) exp(-2 k^2 t^2)."""
    a, b = n1.cast("double"), n2.cast("double")  # the product of two counts exceeds a long
    t = statistic * F.sqrt(a * b / (a + b))
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(terms)),
        F.lit(0.0),
        lambda acc, k: acc + F.when(k % 2 == 1, 1.0).otherwise(-1.0) * F.exp(-2.0 * k * k * t * t),
    )
    # The alternating series does not converge for t near 0, where the tail is 1.
    return F.when(t < 0.2, F.lit(1.0)).otherwise(F.least(F.greatest(2 * series, F.lit(0.0)), F.lit(1.0)))


def _poisson_sum(mean: float, n: int, shift: float) -> float:
    """Sum over i < n of mean^(i + shift) e^-mean / gamma(i + shift + 1), outwards from its largest term.

    Terms too small to change the sum end it, so the steps grow with the root of ``mean``, not with ``n``.
    """
    if mean <= 0:
        return 1.0 if n and not shift else 0.0
    top, total = min(n - 1, int(mean)), 0.0
    for places in (range(top, -1, -1), range(top + 1, n)):
        for i in places:
            term = math.exp((i + shift) * math.log(mean) - math.lgamma(i + shift + 1) - mean)
            total += term
            if term <= total * 1e-17:
                break
    return total


def _chi_square_tail(x: float, dof: float) -> float:
    """P(X > x) from the finite series that hold for whole degrees of freedom."""
    if x is None or dof is None or math.isnan(x) or math.isnan(dof) or dof < 1:
        return float("nan")
    if math.isinf(x):
        return 0.0
    half, k = x / 2.0, int(dof)
    if k % 2 == 0:
        return min(1.0, _poisson_sum(half, k // 2, 0.0))
    return min(1.0, math.erfc(math.sqrt(half)) + _poisson_sum(half, k // 2, 0.5))


@F.pandas_udf(DoubleType())
def chi_square_tail(x: pd.Series, dof: pd.Series) -> pd.Series:
    return pd.Series([_chi_square_tail(a, b) for a, b in zip(x, dof)], dtype="float64")


@F.pandas_udf(DoubleType())
def two_sided_normal_tail(z: pd.Series) -> pd.Series:
    return z.map(lambda v: math.erfc(abs(v) / math.sqrt(2.0)) if v == v else float("nan")).astype("float64")


_LEAST_LOG = -745.2  # the logarithm of less than the smallest double
_FACTORIALS = np.array([0.0] + [math.lgamma(n + 1) - n * math.log(n) + n for n in range(1, 32)])
WIDE = 3000  # places side by side from which the steps far from both borders are taken at once


def _log_excess(n: np.ndarray) -> np.ndarray:
    """log n! - n log n + n, by Stirling's series from 32 on."""
    x = np.maximum(n, 32).astype(float)
    series = 0.5 * np.log(2 * math.pi * x) + (1 / 12 - (1 / 360 - (1 / 1260 - 1 / (1680 * x * x)) / (x * x)) / (x * x)) / x
    return np.where(n < 32, _FACTORIALS[np.minimum(n, 31)], series)


def _excess(x: np.ndarray, mean: np.ndarray) -> np.ndarray:
    """x log(x / mean) - x + mean, without cancellation near the mean."""
    gap = x - mean
    return x * np.log1p(np.where(x > 0, gap / np.maximum(mean, 1e-300), 0.0)) - gap


def _log_binomial(n: np.ndarray, x: np.ndarray, p: float) -> np.ndarray:
    """The logarithm of the chance of x out of n, for 0 <= x <= n."""
    return _log_excess(n) - _log_excess(x) - _log_excess(n - x) - _excess(x, n * p) - _excess(n - x, n * (1 - p))


def _walk(mass: np.ndarray, low: np.ndarray, high: np.ndarray, up: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Carries ``mass``, at the places low[0] to high[0], along paths that go up one place a step with chance ``up``.

    Returns what is at the places low[-1] to high[-1], and what each step lost below ``low`` and above ``high``. These rise by 0 or 1 a step.
    """
    below, above = np.zeros(len(low) - 1), np.zeros(len(low) - 1)
    room = np.zeros(high[-1] - low[0] + 2)
    room[: len(mass)] = mass
    first, last = (low - low[0]).tolist(), (high - low[0]).tolist()
    for k, (a, b, next_a, next_b) in enumerate(zip(first, last, first[1:], last[1:])):
        part = room[a : b + 1]
        moved = part * up
        part *= 1 - up
        room[a + 1 : b + 2] += moved
        if next_a > a:
            below[k] = room[a]
        if next_b == b:
            above[k] = room[b + 1]
            room[b + 1] = 0.0
    return room[first[-1] : last[-1] + 1], below, above


def _stride(mass: np.ndarray, low: np.ndarray, high: np.ndarray, up: float, margin: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same as ``_walk`` for a wide range: step by step near its borders only.

    ``margin`` is farther than a path strays from its mean in so many steps. So what ends farther than that from both borders has not met
    them, and all its steps are one convolution. What ends near a border comes from places no farther in, seen along the border.
    """
    steps = len(low) - 1
    places = int(low[-1] - low[0]) + margin + 1
    bottom, below, _ = _walk(mass[:places], low, np.full_like(low, low[0] + places - 1), up)
    under = np.arange(steps + 1) - high  # steps that don't go up, less a constant: the upper border seen from the other side
    places = int(under[-1] - under[0]) + margin + 1
    top, above, _ = _walk(mass[::-1][:places], under, np.full_like(under, under[0] + places - 1), 1 - up)
    mean = steps * up
    ups = np.arange(max(0, math.floor(mean) - margin), min(steps, math.ceil(mean) + margin) + 1)
    middle = np.convolve(mass, np.exp(_log_binomial(np.full_like(ups, steps), ups, up)))
    origin = low[0] + ups[0]
    return np.concatenate([bottom, middle[low[-1] + margin + 1 - origin : high[-1] - margin - origin], top[::-1]]), below, above


def _kolmogorov_exact(statistic: float, n1: int, n2: int) -> float:
    """P(D >= statistic) for two samples without ties, over all orders in which their values can stand.

    An order is a lattice path from (0, 0) to (n1, n2), and D reaches the statistic where the path comes as far from the
    diagonal. Paths that have not been there are carried along i + j, each step up with the same chance; what steps out counts with the
    chance to end in (n1, n2) from there. All terms are positive, so small probabilities keep their digits. The steps grow with the rows, and
    the places touched in a step with the fourth root of their number or so. A probability whose bound is below the smallest double is 0.
    """
    if math.isnan(statistic) or n1 < 1 or n2 < 1:
        return float("nan")
    a, b = sorted((int(n1), int(n2)))
    reach, total = round(statistic * a * b), a + b
    if reach <= 0:
        return 1.0
    # Serfling's bound for draws without replacement, summed over both sides of all steps.
    if math.log(2 * total) - 2 * (reach / total) * (reach / a) / (b + 1) < _LEAST_LOG:
        return 0.0
    up = a / total
    width = 2 * reach // total
    block = max(256, width // 12)
    # Paths that stray farther in a block (Hoeffding) weigh less than 1e-17 of the result, which is about exp(-2 reach^2 / (a b total)).
    margin = 2 + math.ceil(math.sqrt(block * (reach / a * (reach / b) / total + 20 + math.log(total))))
    whole = _log_binomial(np.array([total]), np.array([a]), up)

    def left(s: np.ndarray, i: np.ndarray, mass: np.ndarray) -> float:
        some = (mass > 0) & (i <= a) & (a - i <= total - s)
        return float(np.sum(mass[some] * np.exp(_log_binomial(total - s[some], a - i[some], up) - whole)))

    mass, touched = np.ones(1), 0.0
    for s in range(0, total, block):
        step = np.arange(min(block, total - s) + 1)
        (low, low_rest), (high, high_rest) = divmod(s * a - reach, total), divmod(-s * a - reach, total)
        low, high = low + (low_rest + step * a) // total + 1, -(high + (high_rest - step * a) // total) - 1
        free = low[0] > max(0, s - b) and low[-1] > s + step[-1] - b and high[0] < s and high[-1] < a  # neither end of the paths cuts the range
        low, high = np.maximum(low, np.maximum(0, s + step - b)), np.minimum(high, np.minimum(s + step, a))
        if (high < low).any():
            return 1.0
        if free and len(mass) > max(WIDE, 3 * (len(step) + 2 * margin)):
            mass, below, above = _stride(mass, low, high, up, margin)
        else:
            mass, below, above = _walk(mass, low, high, up)
        at = s + step[1:]
        touched += left(at, low[:-1], below) + left(at, high[:-1] + 1, above)
        if not mass.any():
            break
    return min(1.0, touched)


@F.pandas_udf(DoubleType())
def kolmogorov_exact(statistic: pd.Series, n1: pd.Series, n2: pd.Series) -> pd.Series:
    known = statistic.notna() & n1.notna() & n2.notna()
    return pd.Series([_kolmogorov_exact(d, a, b) if k else float("nan") for d, a, b, k in zip(statistic, n1, n2, known)], dtype="float64")
