"""Tail probabilities.

KS: exact two-sample distribution up to ``EXACT_LIMIT`` rows a side, above it the
one-sample distribution at the effective size. Chi-square: regularised upper incomplete
gamma function, log-scaled, as column expressions.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The largest sample with an exact p-value; the largest effective size whose
# one-sample distribution is computed exactly.
EXACT_LIMIT = 10_000
SMALL_SIZE = 140


def ks_exact(d: float, n: int, m: int) -> float:
    """P(D >= d) for two samples of n and m rows without ties.

    The merged order of both samples is a lattice path from (0, 0) to (n, m), all paths
    being equally likely; D >= d when the path touches a point with |i m - j n| >= d n m.
    One diagonal i + j = s at a time: the chance to have touched is 1 outside the band, and
    inside the mean of the two points before, weighted by i / s and j / s. All terms are
    positive, so small tails keep their digits."""
    limit = round(d * n * m)
    if limit <= 0:
        return 1.0
    touched = np.ones(n + 2)  # place i + 1 holds point (i, s - i)
    touched[1] = 0.0
    left = 0
    for s in range(1, n + m + 1):
        lo = max(0, s - m, (s * n - limit) // (n + m) + 1)
        hi = min(n, s, -((-s * n - limit) // (n + m)) - 1)
        if lo > hi:
            return 1.0
        i = np.arange(lo, hi + 1)
        inside = (i * touched[lo:hi + 1] + (s - i) * touched[lo + 1:hi + 2]) / s
        touched[left + 1:lo + 1] = 1.0
        touched[lo + 1:hi + 2] = inside
        left = lo
    return float(touched[n + 1])


def ks_exact_many(d: np.ndarray, n: np.ndarray, m: np.ndarray, points: int = 50_000) -> np.ndarray:
    """``ks_exact`` of many rows: blocks of rows walk their diagonals together, each along its
    smaller sample (the recursion is symmetric). A row whose diagonal fills a block by itself
    goes alone, inside its band."""
    out = np.empty(len(d))
    limit = np.rint(d * n * m).astype(np.int64)
    n, m = np.minimum(n, m), np.maximum(n, m)
    order = np.lexsort((n + m, n))
    start = 0
    while start < len(order):
        # of the sorted rows the last one of a block has the longest diagonal
        size = min(max(points // (int(n[order[start]]) + 2), 1), len(order) - start)
        while size > 1 and size * (int(n[order[start + size - 1]]) + 2) > points:
            size //= 2
        block = order[start:start + size]
        start += size
        if size == 1:
            out[block[0]] = ks_exact(float(d[block[0]]), int(n[block[0]]), int(m[block[0]]))
            continue
        a, b, most = n[block], m[block], limit[block]
        i = np.arange(int(a.max()) + 1)
        touched = np.ones((size, len(i) + 1))  # place i + 1 holds point (i, s - i)
        touched[:, 1] = 0.0
        for s in range(1, int((a + b).max()) + 1):
            lo = np.maximum(np.maximum(0, s - b), (s * a - most) // (a + b) + 1)
            hi = np.minimum(np.minimum(a, s), -((-s * a - most) // (a + b)) - 1)
            inside = (i * touched[:, :-1] + (s - i) * touched[:, 1:]) / s
            touched[:, 1:] = np.where((i >= lo[:, None]) & (i <= hi[:, None]), inside, 1.0)
            done = np.flatnonzero(a + b == s)
            out[block[done]] = touched[done, a[done] + 1]
        out[block[most <= 0]] = 1.0
    return out


def kolmogorov_small(d: float, n: int) -> float:
    """P(D < d) of one sample of n rows, by the matrix form of Durbin's recursion."""
    k = int(n * d) + 1
    size, h = 2 * k - 1, k - n * d
    row, col = np.indices((size, size))
    step = np.where(row - col + 1 >= 0, 1.0, 0.0)
    power = h ** np.arange(1, size + 1)
    step[:, 0] -= power
    step[-1, :] -= power[::-1]
    step[-1, 0] += max(2 * h - 1, 0.0) ** size
    step /= np.array([math.factorial(max(e, 0)) for e in range(-size, size + 1)], dtype=float)[row - col + 1 + size]
    state = np.zeros(size)
    state[k - 1] = 1.0
    for i in range(1, n + 1):
        state = state @ step * (i / n)
    return float(state[k - 1])


def kolmogorov_large(d: float, n: int) -> float:
    """P(D < d) of one sample of n rows: the limit law with the three correction terms in
    1 / sqrt(n) of Pelz and Good; its error is below 1e-5 from 140 rows on."""
    z = d * math.sqrt(n)
    if z < 0.1:
        return 0.0
    whole = np.arange(-30, 31)
    a = (math.pi * (whole + 0.5)) ** 2
    b = (math.pi * whole) ** 2
    at_half, at_whole = np.exp(-a / (2 * z * z)), np.exp(-b / (2 * z * z))
    terms = (
        np.sum(at_half) / z,
        np.sum((a - z ** 2) * at_half) / (6 * z ** 4),
        np.sum((6 * z ** 6 + 2 * z ** 4 + (2 * z ** 4 - 5 * z ** 2) * a + (1 - 2 * z ** 2) * a ** 2) * at_half) / (72 * z ** 7)
        - np.sum(b * at_whole) / (36 * z ** 3),
        np.sum((a ** 3 * (5 - 30 * z ** 2) + a ** 2 * (212 * z ** 4 - 60 * z ** 2) + a * (135 * z ** 4 - 96 * z ** 6)
                - 30 * z ** 6 - 90 * z ** 8) * at_half) / (6480 * z ** 10)
        + np.sum((3 * b * z ** 2 - b ** 2) * at_whole) / (108 * z ** 6))
    return math.sqrt(math.pi / 2) * sum(float(t) / n ** (e / 2) for e, t in enumerate(terms))


def ks_two_sample(d: float, n: int, m: int) -> float:
    """Two-sided p-value of the two-sample KS statistic; 1 where a sample is empty."""
    if n <= 0 or m <= 0 or d <= 0:
        return 1.0
    if max(n, m) <= EXACT_LIMIT:
        return ks_exact(d, n, m)
    size = max(round(n * m / (n + m)), 1)
    if d >= 1:
        return 0.0
    below = kolmogorov_small(d, size) if size <= SMALL_SIZE else kolmogorov_large(d, size)
    return min(max(1.0 - below, 0.0), 1.0)


@F.pandas_udf(T.DoubleType())
def ks_pvalue(d: pd.Series, n: pd.Series, m: pd.Series) -> pd.Series:
    """``ks_two_sample`` by row, NULL where an argument is. Each diagonal of the recursion is
    one array operation over a block of rows (there may be one row per store and feature),
    where a fold over SQL arrays would interpret every point (up to 10^8 at the limit)."""
    out = np.full(len(d), np.nan)
    given = (d.notna() & n.notna() & m.notna()).to_numpy()
    x, a, b = (s.to_numpy(dtype="float64", na_value=np.nan) for s in (d, n, m))
    exact = given & (x > 0) & (a > 0) & (b > 0) & (np.fmax(a, b) <= EXACT_LIMIT)
    out[exact] = ks_exact_many(x[exact], a[exact].astype(np.int64), b[exact].astype(np.int64))
    for k in np.flatnonzero(given & ~exact):
        out[k] = ks_two_sample(float(x[k]), int(a[k]), int(b[k]))
    return pd.Series(out).where(given, None).astype("float64")


def ln_gamma(a: Column) -> Column:
    """Logarithm of the gamma function for a > 0: Stirling's series at a + 16, shifted down."""
    z = a + 16.0
    shift = F.ln(a)
    for i in range(1, 16):
        shift = shift + F.ln(a + float(i))
    inv = 1.0 / z
    tail = inv / 12.0 - inv * inv * inv / 360.0 + F.pow(inv, 5) / 1260.0 - F.pow(inv, 7) / 1680.0
    return (z - 0.5) * F.ln(z) - z + 0.5 * math.log(2 * math.pi) + tail - shift


def chi2_sf(x: Column, dof: Column) -> Column:
    """Upper tail of the chi-square distribution for dof > 0: the regularised incomplete
    gamma function Q(dof / 2, x / 2).

    Below dof / 2 + 1 by the power series of P, above by Lentz's continued fraction of Q.
    The prefactor is applied as a logarithm, so nothing overflows; the number of terms
    grows with the square root of dof.
    """
    a, h = dof.cast("double") / 2.0, x.cast("double") / 2.0
    steps = F.sequence(F.lit(1), (F.lit(60) + F.ceil(10 * F.sqrt(a))).cast("int"))
    front = a * F.ln(h) - h - ln_gamma(a)
    series = F.aggregate(
        steps, F.struct((1.0 / a).alias("t"), (1.0 / a).alias("s")),
        lambda acc, i: F.struct((acc["t"] * h / (a + i)).alias("t"), (acc["s"] + acc["t"] * h / (a + i)).alias("s")),
        lambda acc: acc["s"])
    b0 = h + 1.0 - a

    def lentz(acc: Column, i: Column) -> Column:
        an, b = -i * (i - a), acc["b"] + 2.0
        d = 1.0 / (an * acc["d"] + b)
        c = b + an / acc["c"]
        return F.struct(b.alias("b"), c.alias("c"), d.alias("d"), (acc["q"] * d * c).alias("q"))

    fraction = F.aggregate(
        steps, F.struct(b0.alias("b"), F.lit(1e300).alias("c"), (1.0 / b0).alias("d"), (1.0 / b0).alias("q")),
        lentz, lambda acc: acc["q"])
    p = (F.when(h <= 0, F.lit(1.0)).when(h < a + 1.0, 1.0 - F.exp(front + F.ln(series)))
         .otherwise(F.exp(front + F.ln(fraction))))
    return F.when(a > 0, F.least(F.greatest(p, F.lit(0.0)), F.lit(1.0)))
