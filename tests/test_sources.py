import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tidemark.functions.text import uri_to_path, utc_stamp
from tidemark.sources.models import load_promoted, read_pointers, swap_pointer
from tidemark.sources.payloads import attach_predictions, normalised_scores, parse_payloads, read_payloads, rejected_payloads
from tidemark.sources.people import people_messages, read_people
from tidemark.sources.reports import read_report_files
from tidemark.sources.runs import (
    MODEL_SCHEMA, append_runs, current_model, exported_params, first_runs, latest_run, promote, read_config, read_run_store, read_runs,
    read_trial_progress, read_trial_results, runs_frame, runs_named, write_config,
)
from tidemark.plans.tuning import best_trial
from tidemark.sources.tables import encounter_schema, read_table_csv, write_table_csv


def test_csv_nulls_types_and_header(spark, tmp_path):
    names = [f.name for f in encounter_schema().fields]
    row = ["7"] * len(names)
    row[names.index("weight")] = "?"
    row[names.index("max_glu_serum")] = "None"
    row[names.index("A1Cresult")] = ""
    row[names.index("number_inpatient")] = "NA"
    row[names.index("diag_1")] = "250.83"
    (tmp_path / "t.csv").write_text(",".join(names) + "\n" + ",".join(row) + "\n")
    got = read_table_csv(spark, str(tmp_path / "t.csv"))
    r = got.first().asDict()
    assert got.columns == names and len(names) == 50
    assert (r["weight"], r["max_glu_serum"], r["A1Cresult"], r["number_inpatient"]) == ("?", None, None, None)
    assert r["diag_1"] == "250.83" and r["encounter_id"] == 7 and r["glyburide-metformin"] == "7"
    write_table_csv(got, str(tmp_path / "out"))
    assert read_table_csv(spark, str(tmp_path / "out")).exceptAll(got).count() == 0


PAYLOADS = [
    ("[0.7, 0.1]", [0.7, 0.1]),
    ('{"predictions": [1, 0]}', [1.0, 0.0]),
    (" [[0.7, 9], [0.1]]\n", [0.7, 0.1]),
    ('[{"pred_proba": 0.73, "label": "YES"}, {"pred_proba": "0.2"}]', [0.73, 0.2]),
    ('[{"label": "a", "1": [0.4, 1]}, {"label": "b", "1": [0.5]}]', [0.4, 0.5]),
    ('[{"YES": 0.6, "NO": 0.4}]', [0.6]),
    ('["YES", "NO"]', [1.0, 0.0]),
    ('[{"score": "YES"}, {"score": "NO"}]', [1.0, 0.0]),
    ("[true, false]", [1.0, 0.0]),
    ("[]", []),
    ('{"predictions": []}', []),
    ("<html>busy</html>", None),
    ("5", None),
    ('{"scores": [1]}', None),
    ('[{"other": 1}]', None),
    ("[null]", None),
    ('[0.5, "x"]', None),
]


def test_payload_shapes(spark):
    df = spark.createDataFrame([(i, p) for i, (p, _) in enumerate(PAYLOADS)], "id int, p string")
    parsed = parse_payloads(df, "id", "p", positive_class="YES").cache()
    got = {r["id"]: (r["scores"], r["error"]) for r in parsed.collect()}
    for i, (text, want) in enumerate(PAYLOADS):
        assert got[i][0] == want, text
        assert (got[i][1] is None) == (want is not None), text
    assert got[11][1].endswith("<html>busy</html>")
    assert rejected_payloads(parsed, "id").count() == sum(w is None for _, w in PAYLOADS)
    assert normalised_scores(parsed, "id").count() == sum(len(w or []) for _, w in PAYLOADS)


def test_payload_options(spark):
    df = spark.createDataFrame([(0, '["YES"]'), (1, '[{"mine": 3}]'), (2, "x" * 500)], "id int, p string")
    got = {r["id"]: r for r in parse_payloads(df, "id", "p", pred_key="mine").collect()}
    assert got[0]["scores"] is None and "positive class" in got[0]["error"]
    assert got[1]["scores"] == [3.0]
    assert got[2]["error"] == "non-JSON text: " + "x" * 200


def test_payload_files(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"predictions":\n [0.5]}\n')
    (tmp_path / "b.json").write_text("busy")
    parsed = parse_payloads(read_payloads(spark, str(tmp_path)), "source", "payload")
    assert {r["source"]: r["scores"] for r in parsed.collect()} == {"a.json": [0.5], "b.json": None}


def test_attach_checks_the_length(spark):
    rows = spark.createDataFrame([(1,), (2,)], "id int")
    scores = spark.createDataFrame([(1, 0.5), (2, 0.6)], "id int, score double")
    assert {r["p"] for r in attach_predictions(rows, scores, "id", "p").collect()} == {0.5, 0.6}
    with pytest.raises(ValueError, match="length 1 != number of rows 2"):
        attach_predictions(rows, scores.limit(1), "id", "p")


def test_people(spark, tmp_path):
    stand_in = read_people(spark, str(tmp_path / "absent.json"))
    assert stand_in.first()["number"] == 12 and people_messages(stand_in).count() == 12
    (tmp_path / "p.json").write_text(json.dumps({"number": 1, "people": [{"craft": "C", "name": "N"}]}))
    line = people_messages(read_people(spark, str(tmp_path / "p.json"))).first()["message"]
    assert line == "N is currently in space flying on the C! Hello! :)"


def test_uri_and_stamp(spark):
    uris = ["file:///a/b", "file:/a/b", "file://host/a", "/plain", "", None]
    df = spark.createDataFrame([(u,) for u in uris], "u string")
    assert [r[0] for r in df.select(uri_to_path(F.col("u"))).collect()] == ["/a/b", "/a/b", "/host/a", "/plain", "", ""]
    at = spark.sql("SELECT timestamp'2025-10-09 20:59:47' AS t").select(utc_stamp(F.col("t"))).first()[0]
    assert at == "20251009T205947Z"


@pytest.fixture()
def store(tmp_path):
    """A small file-tree run store: two final runs, a failed trial and an unfinished one."""
    exp = tmp_path / "store" / "77"
    exp.mkdir(parents=True)
    (exp / "meta.yaml").write_text("experiment_id: '77'\nname: xgb_diabetic_readmission_hpo\n")
    runs = [
        ("r1", "best_model_full_train", 3, 100, {"test_auc": "5 0.1 0\n6 0.74 0\n"}),
        ("r2", "best_model_full_train", 3, 200, {"test_auc": "6 0.73 0\n"}),
        ("r3", "trial", 4, 300, {"val_auc": "6 0.70 0"}),
        ("r4", "trial", 1, 400, {}),
    ]
    for run, name, status, start, metrics in runs:
        d = exp / run
        for kind in ("params", "metrics", "tags"):
            (d / kind).mkdir(parents=True)
        end = "null" if status == 1 else str(start + 50)
        (d / "meta.yaml").write_text(
            f"end_time: {end}\nexperiment_id: '77'\nrun_id: {run}\nrun_name: {name}\nstart_time: {start}\nstatus: {status}\n"
        )
        (d / "params" / "max_depth").write_text("3")
        (d / "params" / "min_child_weight").write_text("0.5")
        (d / "tags" / "mlflow.runName").write_text(name)
        for k, v in metrics.items():
            (d / "metrics" / k).write_text(v)
    return str(tmp_path / "store")


def test_run_store(spark, store, tmp_path):
    runs = read_run_store(spark, store).cache()
    by_id = {r["run_id"]: r for r in runs.collect()}
    assert len(by_id) == 4 and by_id["r1"]["metrics"] == {"test_auc": 0.74}
    assert by_id["r4"]["metrics"] is None and by_id["r4"]["end_time"] is None and by_id["r3"]["status"] == 4
    finals = runs_named(runs)
    assert latest_run(finals).first()["run_id"] == "r2"
    assert [r["run_id"] for r in first_runs(finals).collect()] == ["r1", "r2"]
    kept = finals.select(exported_params(F.col("params")).alias("p")).first()["p"]
    assert kept == {"max_depth": "3"}
    artifacts = spark.createDataFrame([("r1", "/m/1"), ("r2", "/m/2")], "run_id string, path string")
    pointer = promote(runs, artifacts, "m")
    assert pointer.first()["path"] == "/m/2" and current_model(pointer, "m").first()["run_id"] == "r2"
    assert promote(runs, artifacts, "m", name="no such").count() == 0
    append_runs(runs, str(tmp_path / "table"))
    append_runs(runs_frame(spark, [{"run_id": "r5", "metrics": {"val_auc": 0.9}}]), str(tmp_path / "table"))
    assert read_runs(spark, str(tmp_path / "table")).count() == 5


def test_run_store_lists_matching_folders_only(spark, store):
    import pathlib

    other = pathlib.Path(store) / "88"
    (other / "x" / "tags").mkdir(parents=True)
    (other / "meta.yaml").write_text("experiment_id: '88'\nname: other\n")
    (other / "x" / "meta.yaml").write_text("experiment_id: '88'\nrun_id: x\nrun_name: n\nstart_time: 1\nstatus: 3\n")
    (other / "x" / "tags" / "mlflow.runName").write_text("best_model_full_train")
    whole = read_run_store(spark, store)
    assert whole.count() == 5
    named = read_run_store(spark, store, "xgb_diabetic_readmission_hpo", "best_model_full_train")
    want = runs_named(whole)
    assert sorted(map(str, named.collect())) == sorted(map(str, want.collect())) and named.count() == 2
    read = " ".join(named.inputFiles())
    assert "/88/x/" not in read and "/r3/" not in read and "/r1/" in read
    wide = read_run_store(spark, store, "xgb_diabetic_readmission_hpo", "best_model_full_train", max_folders=1)
    assert sorted(map(str, wide.collect())) == sorted(map(str, want.collect()))
    assert read_run_store(spark, store, "none such").count() == 0


def test_two_promotions_leave_one_winner(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    path = str(tmp_path / "pointers")
    row = lambda r: spark.createDataFrame([("m", r, f"/models/{r}", dt.datetime(2025, 1, 1))], MODEL_SCHEMA)
    assert read_pointers(spark, path).count() == 0 and load_promoted(spark, path, "m") is None
    assert swap_pointer(spark, row("first"), path) == 1
    with ThreadPoolExecutor(4) as pool:  # all saw version 1
        won = list(pool.map(lambda i: swap_pointer(spark, row(f"r{i}"), path, expected=1), range(4)))
    assert sorted(v for v in won if v) == [2] and won.count(None) == 3
    pointers = read_pointers(spark, path)
    assert pointers.count() == 2 and current_model(pointers, "m").first()["run_id"] == f"r{won.index(2)}"
    assert not [p.name for p in (tmp_path / "pointers").iterdir() if p.name.startswith("_staged")]
    assert swap_pointer(spark, row("next"), path) == 3


def test_trial_files_and_config(spark, tmp_path):
    config = {"n_estimators": 300, "max_depth": 4, "learning_rate": 0.1, "subsample": 0.9, "colsample_bytree": 0.8,
              "min_child_weight": 1.5, "reg_alpha": 1e-3, "reg_lambda": 2.0}
    for i, (auc, header) in enumerate([(0.7, "val_auc,trial_id"), (0.8, "trial_id,val_auc"), (None, "trial_id")]):
        d = tmp_path / "exp" / f"trial_{i}_lr=0.1,depth=4"
        d.mkdir(parents=True)
        body = {"trial_id": f"t{i}", "config": config} | ({} if auc is None else {"val_auc": auc})
        (d / "result.json").write_text(json.dumps(body) + "\n")
        values = {"val_auc": str(auc), "trial_id": f"t{i}"}
        (d / "progress.csv").write_text(header + "\n" + ",".join(values[c] for c in header.split(",")) + "\n")
    trials = read_trial_results(spark, str(tmp_path / "exp"))
    assert trials.count() == 3
    best = best_trial(trials).first()
    assert best["trial_id"] == "t1" and best["config"].asDict() == config
    progress = {r["trial_id"]: r["val_auc"] for r in read_trial_progress(spark, str(tmp_path / "exp")).collect()}
    assert progress == {"t0": 0.7, "t1": 0.8, "t2": None}
    write_config(best_trial(trials).select("config.*"), str(tmp_path / "best"))
    assert read_config(spark, str(tmp_path / "best")).first().asDict() == config
    (tmp_path / "c.json").write_text(json.dumps(config, indent=2))
    assert read_config(spark, str(tmp_path / "c.json")).first().asDict() == config


def test_report_files(spark, tmp_path):
    body = {"share_drifted": 0.5, "n_drifted": 1, "details": [{"column": "a", "type": "numeric", "psi": 1.5, "ks_p": 0.0, "drift": True}]}
    (tmp_path / "drift_summary_20251009T205947Z.json").write_text(json.dumps(body, indent=2))
    row = read_report_files(spark, str(tmp_path)).first()
    assert row["run_ts"] == "20251009T205947Z" and row["details"][0]["column"] == "a" and row["critical_hits"] is None
