"""Neighbours against a full sort of distances, exact and with a wanted recall."""

import numpy as np
import pytest

from tidemark.operators.neighbours import nearest_in_class, nearest_rows
from tidemark.plans.training import oversample_fit_report


def frame(spark, vectors, labels, queries=None):
    rows = [(str(lb), f"{i:06d}", [float(x) for x in v], queries is None or i in queries)
            for i, (v, lb) in enumerate(zip(vectors, labels))]
    return spark.createDataFrame(rows, "label string, id string, vec array<double>, is_query boolean").cache()


def truth(vectors, labels, queries, k):
    out = {}
    for i in queries:
        near = sorted((round(float(np.sqrt(((vectors[i] - vectors[j]) ** 2).sum())), 12), f"{j:06d}")
                      for j in range(len(vectors)) if j != i and labels[j] == labels[i])
        out[f"{i:06d}"] = near[:k]
    return out


def answer(df):
    out = {}
    for r in df.orderBy("qid", "rank").collect():
        out.setdefault(r["qid"], []).append((round(r["dist"], 12), r["nid"]))
    return out


@pytest.mark.parametrize("rows_per_cell,rows_per_block", [(10_000, 10_000), (40, 25)])
@pytest.mark.parametrize("grid", [False, True])
def test_exact(spark, rows_per_cell, rows_per_block, grid):
    r = np.random.default_rng(3)
    # On the grid distances tie by the hundred; ties go to the smaller id.
    vectors = np.unique(r.integers(0, 5, (500, 4)), axis=0).astype(float) if grid else r.normal(size=(420, 6))
    labels = np.arange(len(vectors)) % 3
    queries = set(range(0, len(vectors), 7))
    df = frame(spark, vectors, labels, queries)
    got = answer(nearest_in_class(df, 5, rows_per_block, 1.0, rows_per_cell))
    assert got == truth(vectors, labels, queries, 5)


def test_wanted_recall_is_reached_with_few_cells(spark, monkeypatch):
    from tidemark.operators import neighbours

    seen = []
    visits = neighbours._visits
    monkeypatch.setattr(neighbours, "_visits", lambda *a: seen.append(visits(*a)) or seen[-1])
    r = np.random.default_rng(4)
    centres = r.normal(scale=4, size=(60, 16))
    vectors = centres[r.integers(0, 60, 6000)] + r.normal(scale=0.3, size=(6000, 16))
    labels = np.zeros(6000, int)
    df = frame(spark, vectors, labels)
    got = answer(nearest_in_class(df, 5, rows_per_cell=60))
    some = range(0, 6000, 20)
    want = truth(vectors, labels, some, 5)
    recall = np.mean([len({n for _, n in got[q]} & {n for _, n in near}) / 5 for q, near in want.items()])
    assert recall >= 0.9
    assert seen[0]["0"] <= 30  # of 100 cells
    assert len(got) == 6000 and all(len(v) == 5 for v in got.values())


def test_small_and_odd_classes(spark):
    df = frame(spark, np.array([[0.0], [1.0], [5.0], [2.0]]), [0, 0, 0, 1])
    got = answer(nearest_in_class(df, 5))
    assert {q: [n for _, n in v] for q, v in got.items()} == {
        "000000": ["000001", "000002"], "000001": ["000000", "000002"], "000002": ["000001", "000000"]}
    assert nearest_in_class(df.where("false"), 5).collect() == []


def test_equal_points_are_at_zero():
    points = np.full((4, 3), 0.1) * 3
    q, p, dist = nearest_rows(np.array(["a"], object), points[:1], np.array(list("abcd"), object), points, 2)
    assert dist.tolist() == [0.0, 0.0] and p.tolist() == [1, 2]


@pytest.mark.parametrize("learner", ["forest", "boosted"])
def test_oversample_fit_report(spark, learner):
    r = np.random.default_rng(11)
    rows = []
    for i in range(500):
        y = int(r.random() < 0.2)
        rows.append((i, float(r.normal(1.5 * y)), "ab"[int(r.random() < 0.3 + 0.4 * y)], y))
    df = spark.createDataFrame(rows, "id bigint, x double, k string, y int")
    config = {"n_estimators": 10, "max_depth": 3, "learning_rate": 0.3}
    fit = oversample_fit_report(df, ["id"], "y", learner, config, trees=10)
    counts = {c["y"]: (c["n"], c["n_synthetic"]) for c in fit.class_counts.collect()}
    minority = sum(row[3] for row in rows)
    assert counts[0][0] == counts[1][0] and counts[0][1] == 0 and counts[1][1] > 100
    report = {c["label"]: c for c in fit.report.collect()}
    assert set(report) == {"0", "1", "accuracy", "macro avg", "weighted avg"}
    # The test rows have the class mix of the table, untouched by oversampling.
    assert report["1"]["support"] == round(0.2 * minority) and report["accuracy"]["f1"] > 0.6
    assert set(fit.model.binning.names) == {"x", "k_b"}
