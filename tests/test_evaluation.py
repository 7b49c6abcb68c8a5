import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators.evaluation import binary_metrics, classification_report, confusion_counts, confusion_matrix


def brute_auc(y, s):
    pos, neg = s[y == 1], s[y == 0]
    return float(((pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()) / (len(pos) * len(neg)))


def brute_ap(y, s):
    ap, last = 0.0, 0.0
    for t in sorted(set(s), reverse=True):
        said = s >= t
        recall = (said & (y == 1)).sum() / (y == 1).sum()
        ap += (recall - last) * ((said & (y == 1)).sum() / said.sum())
        last = recall
    return float(ap)


@pytest.mark.parametrize("n_buckets", [None, 7])
def test_metrics_with_ties(spark, n_buckets):
    r = np.random.default_rng(2)
    y = r.integers(0, 2, 500)
    s = np.round(np.clip(r.normal(0.4 + 0.15 * y, 0.2), 0, 1), 2)
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, s)], "y int, s double")
    row = binary_metrics(df, "y", "s", n_buckets=n_buckets).first()
    said = s >= 0.5
    tp, fp, fn = (said & (y == 1)).sum(), (said & (y == 0)).sum(), (~said & (y == 1)).sum()
    assert row["auc"] == pytest.approx(brute_auc(y, s), abs=1e-12)
    assert row["ap"] == pytest.approx(brute_ap(y, s), abs=1e-12)
    assert row["acc"] == pytest.approx((said == (y == 1)).mean())
    assert row["f1"] == pytest.approx(2 * tp / (2 * tp + fp + fn))


def test_average_precision_is_stepwise(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.8), (1, 0.7), (1, 0.6), (0, 0.5)], "y int, s double")
    row = binary_metrics(df, "y", "s").first()
    assert row["ap"] == pytest.approx((1 + 2 / 3 + 3 / 4) / 3)


def test_single_class_and_no_positive_prediction(spark):
    row = binary_metrics(spark.createDataFrame([(0, 0.1), (0, 0.9)], "y int, s double"), "y", "s").first()
    assert row["auc"] is None and row["ap"] == 0.0 and row["f1"] == 0.0
    row = binary_metrics(spark.createDataFrame([(0, 0.1), (1, 0.2)], "y int, s double"), "y", "s").first()
    assert row["auc"] == 1.0 and row["f1"] == 0.0 and row["acc"] == 0.5


def test_groups_are_separate(spark):
    rows = [("a", 1, 0.9), ("a", 0, 0.1), ("b", 1, 0.1), ("b", 0, 0.9)]
    got = {r["g"]: r["auc"] for r in binary_metrics(spark.createDataFrame(rows, "g string, y int, s double"), "y", "s", ["g"]).collect()}
    assert got == {"a": 1.0, "b": 0.0}


def test_report_and_matrix(spark):
    pairs = [("NO", "NO")] * 5 + [("NO", "YES")] * 1 + [("YES", "NO")] * 2 + [("YES", "YES")] * 2 + [("YES", "MAYBE")]
    df = spark.createDataFrame(pairs, "a string, p string")
    rows = {r["label"]: r for r in classification_report(df, "a", "p").collect()}
    assert rows["NO"]["precision"] == pytest.approx(5 / 7) and rows["NO"]["recall"] == pytest.approx(5 / 6)
    assert rows["MAYBE"]["precision"] == 0 and rows["MAYBE"]["support"] == 0
    assert rows["accuracy"]["f1"] == pytest.approx(7 / 11) and rows["accuracy"]["support"] == 11
    assert rows["macro avg"]["recall"] == pytest.approx((5 / 6 + 2 / 5 + 0) / 3)
    assert rows["weighted avg"]["recall"] == pytest.approx(7 / 11)
    matrix = {r["actual"]: r.asDict() for r in confusion_matrix(df, "a", "p").collect()}
    assert matrix["YES"] == {"actual": "YES", "MAYBE": 1, "NO": 2, "YES": 2}
    assert matrix["MAYBE"] == {"actual": "MAYBE", "MAYBE": 0, "NO": 0, "YES": 0}


def test_too_many_classes_for_columns_are_an_error(spark):
    df = spark.range(30).select("id", (F.col("id") + 1).alias("said"))
    with pytest.raises(ValueError, match="confusion_counts"):
        confusion_matrix(df, "id", "said", max_columns=20)
    assert confusion_counts(df, "id", "said").count() == 30
