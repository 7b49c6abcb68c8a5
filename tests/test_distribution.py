import itertools
import math

import numpy as np
import pytest

from tidemark.functions.stats import exact_ks_p, ks_p_asymptotic
from tidemark.operators.columns import ComparedColumn
from tidemark.operators.distribution import (
    ks_two_sample, numeric_histogram, numeric_metrics, ordered_profile, psi_categorical, psi_numeric, quantile_edges,
)
from tidemark.operators.ordering import distinct_rank, running_totals
from tidemark.operators.tagging import numeric_value_counts


def frame(spark, values, kind="double"):
    return spark.createDataFrame([(v,) for v in values], f"x {kind}")


def numpy_psi(a, b, bins=10):
    """Independent form: sorted edges, searchsorted bins, clipped shares."""
    a, b = a[~np.isnan(a)], b[~np.isnan(b)]
    if min(len(a), len(b)) < 20:
        return 0.0
    edges = np.unique(np.quantile(a, np.linspace(0, 1, bins + 1)))
    if len(edges) < 3:
        return 0.0

    def shares(v):
        v = v[(v >= edges[0]) & (v <= edges[-1])]
        at = np.minimum(np.searchsorted(edges, v, side="right"), len(edges) - 1)
        n = np.bincount(at, minlength=len(edges))[1:]
        return np.maximum(n / max(n.sum(), 1), 1e-6)

    p, q = shares(a), shares(b)
    return float(((p - q) * np.log(p / q)).sum())


def numpy_ks(a, b):
    grid = np.unique(np.concatenate([a, b]))
    fa = np.searchsorted(np.sort(a), grid, side="right") / len(a)
    fb = np.searchsorted(np.sort(b), grid, side="right") / len(b)
    return float(np.abs(fa - fb).max())


CASES = {
    "normal": lambda r: (r.normal(0, 1, 1000), r.normal(0.3, 1.2, 900)),
    "ties": lambda r: (r.integers(0, 6, 800).astype(float), r.integers(1, 8, 700).astype(float)),
    "nan": lambda r: (np.where(r.random(500) < 0.2, np.nan, r.random(500)), r.random(400)),
    "outside": lambda r: (r.random(300), r.random(300) + 5),
    "hot_value": lambda r: (np.where(r.random(900) < 0.4, 7.0, r.normal(5, 3, 900)), r.normal(5, 3, 900)),
    "few": lambda r: (r.random(19), r.random(500)),
    "two_values": lambda r: (r.integers(0, 2, 400).astype(float), np.ones(400)),
    "grid_rank": lambda r: (np.arange(101.0), np.arange(101.0) + 0.5),
}


@pytest.mark.parametrize("case", CASES)
@pytest.mark.parametrize("n_buckets", [None, 5])
def test_metrics_match_numpy(spark, case, n_buckets):
    a, b = CASES[case](np.random.default_rng(7))
    ref, cur = frame(spark, map(float, a)), frame(spark, map(float, b))
    values = numeric_value_counts(ref, cur, [ComparedColumn("x", "numeric", 0)])
    row = numeric_metrics(values, ks_method="asymp", n_buckets=n_buckets).first()
    assert row["psi"] == pytest.approx(numpy_psi(a, b), abs=1e-9)
    assert row["ks_d"] == pytest.approx(numpy_ks(a[~np.isnan(a)], b[~np.isnan(b)]), abs=1e-12)


def test_edges_equal_numpy(spark):
    r = np.random.default_rng(3)
    v = r.normal(0, 1, 777)
    got = quantile_edges(frame(spark, map(float, v)), ["x"]).first()["edges"]
    assert got == list(np.unique(np.quantile(v, np.linspace(0, 1, 11))))


def test_all_values_missing(spark):
    ref, cur = frame(spark, [None] * 30), frame(spark, [1.0] * 30)
    row = ks_two_sample(ref, cur, "x").first()
    assert (row["ks_p"], row["ks_d"]) == (1.0, None)
    assert psi_numeric(ref, cur, "x").first()["psi"] == 0.0
    none = psi_categorical(frame(spark, [None], "string"), frame(spark, [None], "string"), "x")
    assert none.first()["psi"] == 0.0


def test_same_sample_has_no_drift(spark):
    v = frame(spark, [float(i % 17) for i in range(400)])
    assert psi_numeric(v, v, "x").first()["psi"] == 0.0
    row = ks_two_sample(v, v, "x").first()
    assert (row["ks_d"], row["ks_p"]) == (0.0, 1.0)


def test_shift_of_three_deviations(spark):
    r = np.random.default_rng(0)
    a = frame(spark, map(float, r.normal(0, 1, 1000)))
    same, moved = r.normal(0, 1, 1000), r.normal(3, 1, 1000)
    assert psi_numeric(a, frame(spark, map(float, same)), "x").first()["psi"] < 0.1
    assert psi_numeric(a, frame(spark, map(float, moved)), "x").first()["psi"] > 0.2


def test_categorical_flip(spark):
    a = frame(spark, ["A"] * 700 + ["B"] * 300, "string")
    b = frame(spark, ["A"] * 300 + ["B"] * 700, "string")
    there, back = psi_categorical(a, b, "x").first()["psi"], psi_categorical(b, a, "x").first()["psi"]
    assert there == pytest.approx(0.8 * math.log(7 / 3), abs=1e-4)
    assert there == pytest.approx(back, abs=1e-12)


def test_category_on_one_side(spark):
    a, b = frame(spark, ["A"] * 10, "string"), frame(spark, ["A"] * 5 + ["C"] * 5, "string")
    want = sum((p - q) * math.log(p / q) for p, q in [(1 + 1e-6, 0.5 + 1e-6), (1e-6, 0.5 + 1e-6)])
    assert psi_categorical(a, b, "x").first()["psi"] == pytest.approx(want, abs=1e-12)


def brute_ks_p(d, n, m):
    """Share of all interleavings whose distance reaches d."""
    hits = total = 0
    for chosen in itertools.combinations(range(n + m), n):
        mine, x, y, worst = set(chosen), 0, 0, 0.0
        for i in range(n + m):
            x, y = (x + 1, y) if i in mine else (x, y + 1)
            worst = max(worst, abs(x / n - y / m))
        total += 1
        hits += worst >= d - 1e-9
    return hits / total


@pytest.mark.parametrize("n,m", [(4, 4), (3, 6), (5, 7)])
def test_exact_p_by_enumeration(n, m):
    for k in range(1, n * m + 1):
        d = k / (n * m // math.gcd(n, m))
        if d <= 1:
            assert exact_ks_p(d, n, m) == pytest.approx(brute_ks_p(d, n, m), abs=1e-12)


def test_small_exact_p_keeps_its_digits():
    # Samples that do not overlap: two of the C(n + m, n) merges are as far apart.
    for n, m in [(60, 60), (150, 90), (500, 480)]:
        assert exact_ks_p(1.0, n, m) == pytest.approx(2 / math.comb(n + m, n), rel=1e-9)
    assert exact_ks_p(1.0, 60, 60) < 1e-34
    # One observation of the smaller sample may lie inside the other: still a count of few paths.
    assert exact_ks_p(1 - 1 / 50, 50, 50) == pytest.approx(2 * 100 / math.comb(100, 50), rel=1e-6)
    assert 0 < exact_ks_p(0.9, 2000, 1500) < 1e-300 or exact_ks_p(0.9, 2000, 1500) == 0.0


def test_asymptotic_p_is_near_exact(spark):
    from pyspark.sql import functions as F

    rows = [(d, n, m) for n, m in [(300, 400), (500, 500)] for d in (0.02, 0.05, 0.08, 0.12)]
    df = spark.createDataFrame(rows, "d double, n bigint, m bigint")
    for r in df.withColumn("p", ks_p_asymptotic(F.col("d"), F.col("n"), F.col("m"))).collect():
        assert r["p"] == pytest.approx(exact_ks_p(r["d"], r["n"], r["m"]), abs=0.02)


def test_auto_uses_the_exact_p(spark):
    a, b = [1.0, 2.0, 3.0, 4.0], [3.5, 5.0, 6.0, 7.0]
    row = ks_two_sample(frame(spark, a), frame(spark, b), "x", "auto").first()
    assert row["ks_p"] == pytest.approx(brute_ks_p(row["ks_d"], 4, 4), abs=1e-12)


def test_partitioning_does_not_matter(spark):
    r = np.random.default_rng(5)
    ref, cur = frame(spark, map(float, r.random(2000))), frame(spark, map(float, r.random(2000) ** 2))
    spec = [ComparedColumn("x", "numeric", 0)]
    one = ordered_profile(numeric_value_counts(ref.coalesce(1), cur.coalesce(1), spec)).first()
    many = ordered_profile(numeric_value_counts(ref.repartition(13), cur.repartition(7), spec), n_buckets=9).first()
    assert one == many


def test_histogram_of_constant_column(spark):
    rows = numeric_histogram(frame(spark, [4.0] * 9), ["x"], 30).collect()
    assert [(r["bin"], r["n"]) for r in rows] == [(15, 9)]


def test_running_totals_over_strings(spark):
    words = [f"common prefix {i:05d}" for i in range(3000)]
    values = spark.createDataFrame([(w, 1) for w in words], "w string, one bigint").repartition(6)
    got = {r["w"]: r["cum_one"] for r in running_totals(values, [], "w", ["one"], n_buckets=40).collect()}
    assert got == {w: i + 1 for i, w in enumerate(words)}
    ranks = distinct_rank(values.select("w"), [], "w").collect()
    assert {r["w"]: r["rank"] for r in ranks} == {w: i for i, w in enumerate(words)}
