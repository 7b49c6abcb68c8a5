import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators.drift import DriftOptions
from tidemark.plans.refresh import drift_check, refresh_model
from tidemark.plans.training import with_scores
from tidemark.plans.tuning import best_trial, fit_final, run_search, search_space, trial_runs, trials_by_folds
from tidemark.sources.models import export_model, load_model, load_promoted, save_model
from tidemark.sources.runs import CONFIG_SCHEMA, append_runs, read_config, read_runs
from tidemark.streaming.incremental import baseline_bins, check_new_files, late_rows, psi_per_window, stream_seen_rows, stream_windowed_psi, window_histogram


@pytest.fixture(scope="module")
def data(spark):
    r = np.random.default_rng(21)
    rows = []
    for i in range(400):
        x, k = float(r.normal()), "uvw"[int(r.integers(0, 3))]
        y = int(r.random() < 1 / (1 + np.exp(-(2 * x + (k == "u")))))
        rows.append((i, x, float(r.normal()), k, y))
    return spark.createDataFrame(rows, "id bigint, x double, z double, k string, y int").cache()


CONFIG = {"n_estimators": 4, "max_depth": 3, "learning_rate": 0.3, "subsample": 1.0, "colsample_bytree": 1.0,
          "min_child_weight": 1.0, "reg_alpha": 0.0, "reg_lambda": 1.0}


def small_trials(spark):
    names = [f.name for f in CONFIG_SCHEMA.fields]
    rows = [(t, tuple({**CONFIG, "n_estimators": n}[c] for c in names)) for t, n in enumerate((1, 4))]
    return spark.createDataFrame(rows, f"trial_id bigint, config {CONFIG_SCHEMA.simpleString()}")


def test_search_space_ranges(spark):
    rows = [r["config"] for r in search_space(spark, 300, 42).collect()]
    limits = {"n_estimators": (200, 899), "max_depth": (3, 10), "learning_rate": (1e-3, 3e-1), "subsample": (0.6, 1.0),
              "colsample_bytree": (0.6, 1.0), "min_child_weight": (0.1, 10), "reg_alpha": (1e-8, 1e-1), "reg_lambda": (1e-2, 10)}
    for k, (lo, hi) in limits.items():
        values = [r[k] for r in rows]
        assert lo <= min(values) and max(values) <= hi and len(set(values)) > 5
    assert trials_by_folds(search_space(spark, 3)).count() == 15


def test_search_then_final_fit(spark, data, tmp_path):
    found = run_search(data, ["id"], "y", small_trials(spark), k=3, exclude=("id",))
    rows = {r["trial_id"]: r for r in found.trials.collect()}
    assert found.fold_metrics.count() == 6 and rows[1]["val_auc"] > 0.7
    assert best_trial(found.trials).first()["config"].asDict() == found.best_config
    append_runs(trial_runs(found.trials), str(tmp_path / "runs"))
    assert read_runs(spark, str(tmp_path / "runs")).first()["metrics"].keys() == {"val_auc", "val_ap", "val_acc", "val_f1"}
    final = fit_final(data.where("id < 300"), data.where("id >= 300"), "y", CONFIG, ("id",))
    assert final.metrics["test_auc"] > 0.7 and set(final.metrics) == {"test_auc", "test_ap", "test_acc", "test_f1"}
    save_model(spark, final.model, str(tmp_path / "m"))
    export_model(spark, str(tmp_path / "m"), str(tmp_path / "copy"))
    a, b = (with_scores(m, data).agg(F.sum("pred_proba")).first()[0] for m in (final.model, load_model(spark, str(tmp_path / "copy"))))
    assert a == pytest.approx(b)


def test_check_refreshes_and_promotes(spark, data, tmp_path):
    store = str(tmp_path / "store")
    outcome = drift_check(
        data, data.withColumn("x", F.col("x") + 4), DriftOptions(ignore=frozenset({"id", "y"})), keys=["id"],
        refresh=lambda cur: refresh_model(
            cur, ["id"], "y", store, "readmission", trials=small_trials(spark), k=2, exclude=("id",)
        ),
    )
    assert outcome.triggered
    model = load_promoted(spark, f"{store}/pointers", "readmission")
    assert with_scores(model, data).count() == 400  # the promoted model scores raw rows
    assert read_config(spark, f"{store}/configs").first()["n_estimators"] in (1, 4)
    assert read_runs(spark, f"{store}/runs").count() == 3
    quiet = drift_check(data, data, DriftOptions(ignore=frozenset({"id", "y"})), keys=["id"], model=model)
    assert not quiet.triggered and quiet.refreshed is None


def test_new_files_are_checked_once(spark, data, tmp_path):
    incoming, seen = tmp_path / "in", []
    options = DriftOptions(ignore=frozenset({"id", "y"}), ks_method="asymp")

    def run():
        check_new_files(spark, data, str(incoming), data.schema, str(tmp_path / "rep"), str(tmp_path / "ck"), options,
                        lambda s: seen.append(s.first()["trigger_retrain"]))

    data.write.parquet(str(incoming / "a"))
    incoming_glob = incoming
    incoming = incoming_glob / "*"
    run()
    data.withColumn("x", F.col("x") + 9).write.parquet(str(incoming_glob / "b"))
    run()
    run()
    assert seen == [False, True]


def test_windowed_psi_stream_equals_batch(spark, tmp_path):
    r = np.random.default_rng(8)
    day = dt.datetime(2024, 1, 1)
    rows = [(day + dt.timedelta(minutes=15 * i), float(r.normal(3 if i > 250 else 0))) for i in range(480)]
    events = spark.createDataFrame(rows, "ts timestamp, v double")
    ref = events.where("ts < timestamp'2024-01-03'")
    baseline = baseline_bins(ref, ["v"]).cache()
    src = str(tmp_path / "src")
    events.coalesce(1).write.parquet(src)
    stream = spark.readStream.schema(events.schema).parquet(src)
    stream_windowed_psi(stream, baseline, ["v"], "ts", str(tmp_path / "out"), str(tmp_path / "ck"), delay="1 hour")
    done = psi_per_window(spark.read.parquet(str(tmp_path / "out")), baseline)
    whole = psi_per_window(window_histogram(events, baseline.select("column", "edges").distinct(), ["v"], "ts"), baseline)
    got = {r["window_start"]: round(r["psi"], 9) for r in done.collect()}
    want = {r["window_start"]: round(r["psi"], 9) for r in whole.collect()}
    assert len(want) == 5 and len(got) >= 4 and all(want[k] == v for k, v in got.items())
    assert want[dt.datetime(2024, 1, 4)] > 0.2 > want[dt.datetime(2024, 1, 1)]


def test_late_rows_of_a_stream_are_counted(spark, tmp_path):
    r = np.random.default_rng(9)
    day = dt.datetime(2024, 1, 1)
    rows = [(day + dt.timedelta(minutes=30 * i), float(r.normal())) for i in range(240)]
    late = [(day + dt.timedelta(hours=h), 0.0) for h in (1, 2, 26)] + [(day + dt.timedelta(days=5), 0.0)]
    events = spark.createDataFrame(rows, "ts timestamp, v double")
    baseline = baseline_bins(events, ["v"]).cache()
    src = tmp_path / "src"
    # A batch judges lateness by the watermark of the batch before it: one lies between.
    between = [(day + dt.timedelta(days=4, hours=23, minutes=45), 0.0)]
    for i, part in enumerate((events, spark.createDataFrame(between, events.schema), spark.createDataFrame(late, events.schema))):
        part.coalesce(1).write.mode("append").parquet(str(src))
        for f in src.glob("*.parquet"):  # files in the order of their batches
            if not f.name.startswith("batch"):
                f.rename(src / f"batch{i}.parquet")
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(str(src))
    stream_windowed_psi(stream, baseline, ["v"], "ts", str(tmp_path / "out"), str(tmp_path / "ck"), delay="1 hour")
    stream_seen_rows(stream, baseline, ["v"], "ts", str(tmp_path / "seen"), str(tmp_path / "ck2"))
    got = {x["window_start"].day: x["n_late"] for x in late_rows(
        spark.read.parquet(str(tmp_path / "seen")), spark.read.parquet(str(tmp_path / "out"))).collect()}
    assert got[1] == 2 and got[2] == 1 and all(n == 0 for d, n in got.items() if d > 2) and len(got) >= 4
