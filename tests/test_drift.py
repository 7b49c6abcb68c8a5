import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators.columns import compared_columns, schema_difference
from tidemark.operators.drift import DriftOptions, detect_drift, drift_report, exploded_details, printed_report
from tidemark.operators.sampling import inject_drift
from tidemark.plans.refresh import drift_check
from tidemark.sources.reports import drifted_in_reports, read_reports


@pytest.fixture(scope="module")
def pair(spark):
    r = np.random.default_rng(11)
    rows = [
        (i, float(a), int(b), "xyz"[c], bool(d))
        for i, (a, b, c, d) in enumerate(
            zip(r.normal(0, 1, 600), r.integers(0, 9, 600), r.integers(0, 3, 600), r.integers(0, 2, 600))
        )
    ]
    df = spark.createDataFrame(rows, "id bigint, a double, b int, `c-d` string, flag boolean")
    return df.where("id % 2 = 0"), df.where("id % 2 = 1")


IGNORE = frozenset({"id"})


def test_report_order_and_kinds(pair):
    rows = drift_report(*pair, DriftOptions(ignore=IGNORE)).orderBy("pos").collect()
    assert [(r["column"], r["type"]) for r in rows] == [
        ("a", "numeric"), ("b", "numeric"), ("c-d", "categorical"), ("flag", "categorical"),
    ]
    assert not any(r["drift"] for r in rows)
    assert [r["ks_p"] is None for r in rows] == [False, False, True, True]


def test_injected_shift_triggers(pair):
    ref, cur = pair
    out = detect_drift(ref, inject_drift(cur, "b", 10), DriftOptions(ignore=IGNORE))
    s = out.summary.first()
    assert s["trigger_retrain"] and s["n_drifted"] == 1 and s["n_features"] == 4
    assert s["share_drifted"] == 0.25 and s["max_feature_psi"] > 1
    assert [d["column"] for d in s["details"] if d["drift"]] == ["b"]


def test_no_shift_no_trigger_and_force(pair):
    quiet = detect_drift(*pair, DriftOptions(ignore=IGNORE)).summary.first()
    assert not quiet["trigger_retrain"] and quiet["forced"] is None
    forced = detect_drift(*pair, DriftOptions(ignore=IGNORE), force=True).summary.first()
    assert forced["trigger_retrain"] and forced["forced"] and forced["n_features"] == 4


def test_critical_column_alone_triggers(pair):
    ref, cur = pair
    cur = cur.withColumn("c-d", F.when(F.col("`c-d`") == "x", "y").otherwise(F.col("`c-d`")))
    base = dict(ignore=IGNORE, any_feature_psi_thresh=99.0, feature_psi_thresh=99.0)
    assert not detect_drift(ref, cur, DriftOptions(**base)).summary.first()["trigger_retrain"]
    s = detect_drift(ref, cur, DriftOptions(**base, critical=frozenset({"c-d"}))).summary.first()
    assert s["trigger_retrain"] and s["critical_hits"] == ["c-d"] and s["n_drifted"] == 1


def test_prediction_gate_and_exclusion(pair):
    ref, cur = (d.withColumn("pred_proba", F.rand(5) * k) for d, k in zip(pair, (1.0, 0.4)))
    s = detect_drift(ref, cur, DriftOptions(ignore=IGNORE)).summary.first()
    assert s["pred_gate"] and s["trigger_retrain"] and s["n_features"] == 4 and s["pred_psi"] > 0.2
    assert "pred_proba" not in [d["column"] for d in s["details"]]
    one_side = detect_drift(ref, pair[1], DriftOptions(ignore=IGNORE)).summary.first()
    assert one_side["pred_psi"] is None and not one_side["pred_gate"]


def test_label_scores_blind_psi_but_not_ks(pair):
    ref, cur = (d.withColumn("pred_proba", (F.col("id") % 7 < k).cast("double")) for d, k in zip(pair, (3, 6)))
    blind = detect_drift(ref, cur, DriftOptions(ignore=IGNORE)).summary.first()
    assert blind["pred_psi"] == 0.0 and not blind["pred_gate"]
    seen = detect_drift(ref, cur, DriftOptions(ignore=IGNORE, pred_ks_p_thresh=0.01)).summary.first()
    assert seen["pred_gate"]


def test_baseline_decides_the_type(spark, pair):
    ref, cur = pair
    text = cur.withColumn("b", F.when(F.col("id") % 3 == 0, "bad").otherwise(F.col("b").cast("string")))
    columns = compared_columns(ref, text, IGNORE)
    assert [(c.name, c.kind) for c in columns][1] == ("b", "numeric")
    row = drift_report(ref, text, DriftOptions(ignore=IGNORE)).where("column = 'b'").first()
    assert row["type"] == "numeric" and row["psi"] < 0.2


def test_null_rate_shift_is_invisible(pair):
    ref, cur = pair
    holes = cur.withColumn("b", F.when(F.col("id") % 4 == 1, F.lit(None)).otherwise(F.col("b")))
    row = drift_report(ref, holes, DriftOptions(ignore=IGNORE)).where("column = 'b'").first()
    assert not row["drift"]


def test_no_common_columns(spark):
    a, b = spark.createDataFrame([(1,)], "p int"), spark.createDataFrame([(1,)], "q int")
    s = detect_drift(a, b).summary.first()
    assert s["n_features"] == 1 and s["n_drifted"] == 0 and s["details"] == [] and not s["trigger_retrain"]


def test_schema_difference(pair):
    ref, cur = pair
    assert [r["column"] for r in schema_difference(ref, cur.drop("a")).collect()] == ["a"]


def test_check_writes_report_and_refreshes(pair, tmp_path):
    ref, cur = pair
    seen = []
    out = drift_check(
        ref, inject_drift(cur, "b", 10), DriftOptions(ignore=IGNORE), report_path=str(tmp_path / "reports"),
        snapshot_path=str(tmp_path / "snap"), refresh=lambda df: seen.append(df.count()), keys=["id"],
        at=F.lit("2024-02-03 04:05:06").cast("timestamp"),
    )
    assert out.triggered and seen == [300]
    rows = drifted_in_reports(read_reports(ref.sparkSession, str(tmp_path / "reports"))).collect()
    assert [(r["run_ts"], r["column"]) for r in rows] == [("20240203T040506Z", "b")]
    scored = ref.sparkSession.read.parquet(str(tmp_path / "snap" / "ref"))
    assert "pred_proba" in scored.columns and scored.count() == 300


def test_printed_lines(pair):
    ref, cur = pair
    out = detect_drift(ref, inject_drift(cur, "b", 10), DriftOptions(ignore=IGNORE))
    lines = [r["line"] for r in printed_report(out.summary, 2).orderBy("line_no").collect()]
    assert lines[0] == "Drift detected: True" and lines[3] == "Features with drift: 1/4"
    assert lines[4].startswith("DRIFT b: PSI=") and len(lines) == 6
    assert exploded_details(out.summary).count() == 4
