"""Running totals with one window, with buckets and with buckets cut again."""

import random

import pytest

from tidemark.operators.ordering import bucket_cuts, running_totals


@pytest.mark.parametrize("how", [{}, {"n_buckets": 5}, {"rows_per_bucket": 20}, {"rows_per_bucket": 10, "max_cuts": 6}])
@pytest.mark.parametrize("kind", ["double", "string"])
def test_running_totals(spark, how, kind):
    rng = random.Random(1)
    values = sorted({round(rng.gauss(0, 9), 2) for _ in range(400)})
    key = (lambda v: v) if kind == "double" else (lambda v: f"{v + 1000:09.2f}")
    rows = [(g, key(v), rng.randrange(5)) for g in "ab" for v in values]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, f"g string, v {kind}, n long")
    want = {}
    for g in "ab":
        total = 0
        for _, v, n in sorted(r for r in rows if r[0] == g):
            total += n
            want[g, v] = total
    got = running_totals(df, ["g"], "v", ["n"], **how).collect()
    assert {(r.g, r.v): r.cum_n for r in got} == want and len(got) == len(rows)
    assert all(r.tot_n == sum(n for g, _, n in rows if g == r.g) for r in got)


def test_cuts_from_sketches_of_many_tasks(spark):
    """A tree of merges over 150 tasks gives even buckets; ends and repeated values do no harm."""
    values = spark.range(0, 60_000, numPartitions=150).selectExpr("CAST(pow(id, 3) AS DOUBLE) AS v")
    cuts = bucket_cuts(values, "v", 60_000, 40)
    assert len(cuts) == 39 and cuts == sorted(cuts)
    ranks = [c ** (1 / 3) for c in cuts]
    assert all(abs(r - (i + 1) * 1500) < 400 for i, r in enumerate(ranks))
    hot = spark.range(0, 5000, numPartitions=70).selectExpr("CASE WHEN id % 3 > 0 THEN 7 ELSE id END AS v")
    assert 7 in bucket_cuts(hot, "v", 5000, 10)
    assert bucket_cuts(values.where("false"), "v", 0, 4) == []
