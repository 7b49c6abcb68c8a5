"""Statistical scalar expressions (PSI terms, bin search, Kolmogorov p-value)."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The smallest share used inside PSI, the row and edge counts
# below which numeric PSI is 0, and the sample size up to which the KS p-value
# is the exact one.
SHARE_FLOOR = 1e-6
MIN_PSI_ROWS = 20
MIN_PSI_EDGES = 3
EXACT_KS_MAX_N = 10_000


def psi_term(expected: Column, actual: Column) -> Column:
    return (expected - actual) * F.log(expected / actual)


def clipped_share(count: Column, total: Column) -> Column:
    """Share with a lower bound; the form numeric PSI uses."""
    return F.greatest(count / F.greatest(total, F.lit(1)), F.lit(SHARE_FLOOR))


def padded_share(count: Column, total: Column) -> Column:
    """Share plus a constant; the form categorical PSI uses."""
    return count / F.greatest(total, F.lit(1)) + F.lit(SHARE_FLOOR)


def count_not_above(edges: Column, value: Column, max_edges: int) -> Column:
    """How many entries of the ascending array ``edges`` are <= ``value``.

    Binary search as a fold over halving steps, so 4096 entries cost 13
    comparisons. Reads past the end give NULL and count as "above".
    """
    steps = [1 << k for k in range(max(max_edges, 1).bit_length() - 1, -1, -1)]
    return F.aggregate(
        F.array(*[F.lit(s) for s in steps]),
        F.lit(0),
        lambda at, step: F.when(F.get(edges, at + step - 1) <= value, at + step).otherwise(at),
    )


def bin_number(edges: Column, value: Column, max_edges: int) -> Column:
    """Histogram bin 1..size-1: left-closed bins, the last closed on both ends.

    NULL when the value lies outside the edges.
    """
    inside = (value >= F.get(edges, F.lit(0))) & (value <= F.element_at(edges, -1))
    return F.when(inside, F.least(count_not_above(edges, value, max_edges), F.size(edges) - 1))


def kolmogorov_sf(z: Column, terms: int = 100) -> Column:
    """P(K >= z) of the Kolmogorov distribution.

    Two series of the same function: the alternating one converges fast for
    large z, its theta-function dual for small z.
    """
    ks = F.sequence(F.lit(1), F.lit(terms))
    zero = F.lit(0.0)
    direct = 2 * F.aggregate(
        ks, zero,
        lambda acc, k: acc + F.when(k % 2 == 1, 1.0).otherwise(-1.0) * F.exp(-2.0 * k * k * z * z),
    )
    safe = F.greatest(z, F.lit(1e-3))
    dual = 1 - (F.lit(math.sqrt(2 * math.pi)) / safe) * F.aggregate(
        ks, zero,
        lambda acc, k: acc + F.exp(-((2 * k - 1) * (2 * k - 1)) * F.lit(math.pi**2 / 8) / (safe * safe)),
    )
    p = F.when(z < 1.0, dual).otherwise(direct)
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), p))


def ks_p_asymptotic(d: Column, n: Column, m: Column) -> Column:
    """Two-sided p-value for large samples.

    The two-sample statistic is referred to a one-sample test of size
    round(nm/(n+m)); Vrbik's 2018 correction of the argument supplies the
    finite-size terms that the plain limit law lacks.
    """
    n, m = n.cast("double"), m.cast("double")
    size = F.greatest(F.rint(n * m / F.greatest(n + m, F.lit(1.0))), F.lit(1.0))
    root = F.sqrt(size)
    z = root * d
    corrected = z + 1 / (6 * root) + (z - 1) / (4 * size)
    return F.when(d <= 0, F.lit(1.0)).otherwise(kolmogorov_sf(F.greatest(corrected, F.lit(0.0))))


def exact_ks_p(d: float, n: int, m: int) -> float:
    """P(D >= d) under the null, from lattice paths that leave the band.

    A path from (0,0) to (n,m) is a merge of the two samples; it has left the
    band once |x/n - y/m| >= d at some step. The share of the paths to a point
    that have left is 1 outside the band, and inside a mean of the shares at
    the two points before it. Anti-diagonals follow from each other as whole
    arrays; only positive terms are added, so a small p keeps its digits.
    """
    n, m = min(n, m), max(n, m)
    g = math.gcd(n, m)
    step_x, step_y = m // g, n // g
    limit = round(d * step_x * n)
    if limit <= 0:
        return 1.0
    left = np.zeros(n + 2)  # left[x + 1] belongs to x on the current anti-diagonal
    for t in range(1, n + m + 1):
        lo, hi = max(0, t - m), min(n, t)
        x = np.arange(lo, hi + 1, dtype=np.int64)
        share = x / t
        new = share * left[lo:hi + 1] + (1 - share) * left[lo + 1:hi + 2]
        new[np.abs(x * step_x - (t - x) * step_y) >= limit] = 1.0
        left[lo + 1:hi + 2] = new
        left[:lo + 1] = left[hi + 2:] = 0.0
    return float(min(left[n + 1], 1.0))


def _exact_ks_p_batches(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for d, n, m in batches:
        yield pd.Series(
            [
                None if pd.isna(dd) else exact_ks_p(float(dd), int(nn), int(mm))
                for dd, nn, mm in zip(d, n, m)
            ],
            dtype="float64",
        )


def ks_p_value(d: Column, n: Column, m: Column, method: str = "auto") -> Column:
    """KS p-value; ``auto`` is exact up to 10,000 rows a side, else asymptotic.

    The exact branch is a Pandas UDF over the per-column metric rows only (one
    row per compared column), never over data rows.
    """
    if method == "asymp":
        return ks_p_asymptotic(d, n, m)
    if method != "auto":
        raise ValueError(f"unknown KS method {method!r}")
    small = F.greatest(n, m) <= EXACT_KS_MAX_N
    exact_udf = F.pandas_udf(_exact_ks_p_batches, T.DoubleType())
    exact = exact_udf(F.when(small, d), F.when(small, n), F.when(small, m))
    return F.when(small, exact).otherwise(ks_p_asymptotic(d, n, m))
