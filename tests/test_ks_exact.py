"""Two-sample KS p-values against all lattice paths, published values and the limit law."""

import itertools
import math

import pytest
from pyspark.sql import functions as F

from panelcast.functions import stats


def _paths(n: int, m: int) -> dict[int, float]:
    """Share of merged orders for each largest |i m - j n|."""
    found: dict[int, int] = {}
    for firsts in itertools.combinations(range(n + m), n):
        i = j = largest = 0
        for place in range(n + m):
            i, j = (i + 1, j) if place in firsts else (i, j + 1)
            largest = max(largest, abs(i * m - j * n))
        found[largest] = found.get(largest, 0) + 1
    total = sum(found.values())
    return {k: v / total for k, v in found.items()}


@pytest.mark.parametrize("n,m", [(1, 1), (1, 6), (3, 4), (5, 5), (6, 4), (7, 3)])
def test_exact_equals_all_orders(n, m):
    shares = _paths(n, m)
    for k in shares:
        expected = sum(share for other, share in shares.items() if other >= k)
        assert stats.ks_exact(k / (n * m), n, m) == pytest.approx(expected, rel=1e-12)


def test_equal_sizes_have_a_closed_form():
    # D >= k / n for equal sizes: reflections of the path at both borders.
    n, k = 400, 40
    log_all = math.lgamma(2 * n + 1) - 2 * math.lgamma(n + 1)
    closed = 0.0
    for r in range(1, n // k + 1):
        closed += 2 * (-1) ** (r + 1) * math.exp(
            math.lgamma(2 * n + 1) - math.lgamma(n + r * k + 1) - math.lgamma(n - r * k + 1) - log_all)
    assert stats.ks_exact(k / n, n, n) == pytest.approx(closed, rel=1e-9)


def test_one_sample_forms():
    # Published value for ten rows; both forms meet where one takes over from the other.
    assert stats.kolmogorov_small(0.274, 10) == pytest.approx(0.6284796154565, abs=1e-12)
    for z in (0.5, 0.8, 1.2, 1.6, 2.0):
        d = z / math.sqrt(stats.SMALL_SIZE)
        assert abs(stats.kolmogorov_small(d, stats.SMALL_SIZE) - stats.kolmogorov_large(d, stats.SMALL_SIZE)) < 1e-5


def test_edges_and_continuity_at_the_limit():
    assert stats.ks_two_sample(0.3, 0, 9) == stats.ks_two_sample(0.0, 9, 9) == 1.0
    assert stats.ks_two_sample(1.0, 20_000, 5) == 0.0
    assert stats.ks_exact(1.0, 3, 3) == pytest.approx(2 / 20)
    below, above = stats.ks_two_sample(0.02, 10_000, 10_000), stats.ks_two_sample(0.02, 10_001, 10_000)
    assert abs(below - above) < 1e-3


def test_column_form(spark):
    rows = [(0.75, 4, 4), (None, 4, 4), (1.36 / math.sqrt(1e6), 2_000_000, 2_000_000)]
    df = spark.createDataFrame(rows, "d double, n long, m long")
    p = [r[0] for r in df.select(stats.ks_pvalue(F.col("d"), F.col("n"), F.col("m"))).collect()]
    assert p[0] == pytest.approx(16 / 70) and p[1] is None and abs(p[2] - 0.0494) < 1e-3


def test_many_rows_at_once_equal_row_by_row():
    import numpy as np
    rng = np.random.default_rng(3)
    n, m = rng.integers(1, 90, 300), rng.integers(1, 40, 300)
    d = np.array([rng.integers(0, a * b + 1) / (a * b) for a, b in zip(n, m)])
    one = [stats.ks_exact(float(x), int(a), int(b)) for x, a, b in zip(d, n, m)]
    for points in (50_000, 500, 1):
        assert np.array_equal(stats.ks_exact_many(d, n, m, points), one)


def test_column_form_takes_exact_rows_together(spark, monkeypatch):
    import pandas as pd
    monkeypatch.setattr(stats, "ks_exact", lambda *a: pytest.fail("one row at a time"))
    p = stats.ks_pvalue.func(pd.Series([0.75, 0.5, None]), pd.Series([4, 4, 4]), pd.Series([4, 4, 4]))
    assert p[0] == pytest.approx(16 / 70) and 0 < p[1] <= 1 and pd.isna(p[2])
