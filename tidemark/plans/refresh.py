"""The drift check as one job: score, compare, report and, if needed, refresh."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.drift import DriftOptions, DriftResult, detect_drift
from ..operators.sampling import mock_predictions
from ..sources.models import save_model, swap_pointer
from ..sources.profiles import BaselineProfile
from ..sources.reports import write_report
from ..sources.runs import CONFIG_SCHEMA, append_runs, promote, read_runs, write_config
from ..sources.tables import write_snapshot
from .ensembles import TreeModel
from .training import with_scores
from .tuning import trial_runs, tune_and_fit


@dataclass
class CheckOutcome:
    triggered: bool
    drift: DriftResult
    refreshed: object | None = None


def score_both(
    ref: DataFrame, cur: DataFrame, model: TreeModel | None, pred_col: str,
    mode: str = "probability", keys: list[str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Scores both tables with one model, so their scores are comparable.

    Without a model the scores are synthetic, with one seed per side.
    """
    if model is None:
        if not keys:
            raise ValueError("synthetic scores need row keys")
        return mock_predictions(ref, keys, 42, pred_col), mock_predictions(cur, keys, 123, pred_col)
    return with_scores(model, ref, pred_col, mode), with_scores(model, cur, pred_col, mode)


def drift_check(
    ref: DataFrame | BaselineProfile, cur: DataFrame, options: DriftOptions = DriftOptions(), model: TreeModel | None = None,
    report_path: str | None = None, snapshot_path: str | None = None, force: bool = False,
    refresh: Callable[[DataFrame], object] | None = None, keys: list[str] | None = None,
    mode: str = "probability", at: Column | None = None,
) -> CheckOutcome:
    """Scores, compares, writes the report and calls ``refresh(cur)`` on a trigger.

    Tables that already carry the prediction column are not scored again. A
    forced run computes everything too; only its decision is fixed. ``refresh``
    gets the current table as it came, without scores added here. A stored
    profile in place of the baseline spares its scan; it is of scored rows if
    scores are to be compared, and only the current table is scored then.
    """
    raw = cur
    if isinstance(ref, BaselineProfile):
        if snapshot_path:
            raise ValueError("a profile has no rows to keep a snapshot of")
        if options.pred_col in ref.columns and options.pred_col not in cur.columns:
            cur = mock_predictions(cur, keys, 123, options.pred_col) if model is None else with_scores(model, cur, options.pred_col, mode)
    elif not (options.pred_col in ref.columns and options.pred_col in cur.columns):
        ref, cur = score_both(ref, cur, model, options.pred_col, mode, keys)
    if snapshot_path:
        spark = ref.sparkSession
        write_snapshot(ref, f"{snapshot_path}/ref")
        write_snapshot(cur, f"{snapshot_path}/cur")
        ref, cur = spark.read.parquet(f"{snapshot_path}/ref"), spark.read.parquet(f"{snapshot_path}/cur")
    result = detect_drift(ref, cur, options, force)
    if report_path:
        write_report(result.summary, report_path, at)
    triggered = bool(result.summary.first()["trigger_retrain"])
    refreshed = refresh(raw) if triggered and refresh else None
    return CheckOutcome(triggered, result, refreshed)


def refresh_model(
    current: DataFrame, keys: list[str], label: str, store: str, model_name: str,
    n_trials: int = 15, seed: int = 123, pred_col: str = "pred_proba", **search,
) -> DataFrame:
    """Tunes on the current table, stores trials, run, config and model, promotes it.

    Returns the pointer row. ``store`` holds ``runs``, ``models``, ``configs``
    and ``pointers`` side by side. A score of an earlier model is no feature.
    """
    spark = current.sparkSession
    found, final = tune_and_fit(current.drop(pred_col), keys, label, n_trials, seed=seed, **search)
    append_runs(trial_runs(found.trials), f"{store}/runs")
    write_config(found.trials.sparkSession.createDataFrame([tuple(found.best_config[f.name] for f in CONFIG_SCHEMA.fields)],
                                                           CONFIG_SCHEMA), f"{store}/configs")
    run_id = final.run.first()["run_id"]
    path = f"{store}/models/{run_id}"
    save_model(spark, final.model, path)
    append_runs(final.run, f"{store}/runs")
    artifacts = spark.createDataFrame([(run_id, path)], "run_id string, path string")
    pointer = promote(read_runs(spark, f"{store}/runs"), artifacts, model_name)
    while swap_pointer(spark, pointer, f"{store}/pointers") is None:
        # Another job promoted meanwhile: the newest run decides again.
        pointer = promote(read_runs(spark, f"{store}/runs"), artifacts, model_name)
        if pointer.isEmpty():
            break
    return pointer
