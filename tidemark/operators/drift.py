"""Per-column verdicts, the gates over them and the retrain decision."""

from __future__ import annotations

from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field as dc_field
from functools import partial

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .columns import column_table, compared_columns
from .distribution import PSI_BINS, categorical_metrics, numeric_metrics
from .tagging import category_counts_by_side, numeric_value_counts


@dataclass(frozen=True)
class DriftOptions:
    """Thresholds of the decision. Defaults are those of the controller."""

    feature_psi_thresh: float = 0.2
    ks_p_thresh: float = 0.01
    drift_share_thresh: float = 0.30
    pred_psi_thresh: float = 0.2
    pred_ks_p_thresh: float = 0.0
    any_feature_psi_thresh: float = 1.0
    critical_psi_thresh: float = 0.5
    pred_col: str = "pred_proba"
    ignore: frozenset[str] = dc_field(default_factory=frozenset)
    critical: frozenset[str] = dc_field(default_factory=frozenset)
    ks_method: str = "auto"
    n_buckets: int | None = None

    @classmethod
    def demo(cls, **changes) -> DriftOptions:
        """The stricter thresholds of the demonstration monitors."""
        base = dict(
            feature_psi_thresh=0.1, ks_p_thresh=0.05, drift_share_thresh=0.3,
            pred_psi_thresh=0.1, pred_col="pred_readmit",
        )
        return cls(**{**base, **changes})


@dataclass(frozen=True)
class DriftResult:
    details: DataFrame
    summary: DataFrame


def column_metrics(ref, cur: DataFrame, options: DriftOptions = DriftOptions()) -> DataFrame:
    """(pos, column, kind, psi, ks_d, ks_p, n_ref, n_cur), unrounded.

    Numeric and categorical columns are disjoint sets of the scan, so the two
    branches together read each column once per side. ``ref`` is the baseline
    or its stored profile, which spares its scan.
    """
    profiled = not isinstance(ref, DataFrame)
    columns = compared_columns(ref.frame if profiled else ref, cur, options.ignore, options.pred_col)
    value_counts = ref.value_counts if profiled else partial(numeric_value_counts, ref)
    category_counts = ref.category_counts if profiled else partial(category_counts_by_side, ref)
    spark = cur.sparkSession
    numeric = [c for c in columns if c.kind != "categorical"]
    categorical = [c for c in columns if c.kind == "categorical"]
    branches = []
    if numeric:
        branches.append(lambda: numeric_metrics(
            value_counts(cur, numeric), PSI_BINS, options.ks_method, options.n_buckets
        ))
    if categorical:
        branches.append(lambda: categorical_metrics(category_counts(cur, categorical)).select(
            "pos", "n_ref", "n_cur", "psi",
            F.lit(None).cast("double").alias("ks_d"), F.lit(None).cast("double").alias("ks_p"),
        ))
    # Independent jobs over disjoint columns: submit both, let the cluster share.
    with ThreadPoolExecutor(max_workers=2) as pool:
        parts = [f.result() for f in [pool.submit(inheritable_thread_target(spark)(b)) for b in branches]]
    names = column_table(spark, columns)
    if not parts:
        empty = [F.lit(None).cast(t).alias(c) for c, t in
                 (("psi", "double"), ("ks_d", "double"), ("ks_p", "double"), ("n_ref", "bigint"), ("n_cur", "bigint"))]
        return names.select("*", *empty)
    metrics = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    joined = names.join(F.broadcast(metrics), "pos", "left")
    is_numeric = F.col("kind") != "categorical"
    return joined.select(
        "pos", "column", "kind",
        F.coalesce("psi", F.lit(0.0)).alias("psi"),
        "ks_d",
        F.when(is_numeric, F.coalesce("ks_p", F.lit(1.0))).alias("ks_p"),
        F.coalesce("n_ref", F.lit(0)).alias("n_ref"),
        F.coalesce("n_cur", F.lit(0)).alias("n_cur"),
    )


def _is_in(column: Column, names: Iterable[str]) -> Column:
    names = list(names)
    return column.isin(names) if names else F.lit(False)


def feature_verdicts(metrics: DataFrame, options: DriftOptions) -> DataFrame:
    """Adds ``drift`` and ``critical_hit``; decisions use unrounded metrics."""
    features = metrics.where(F.col("kind") != "prediction")
    hit = _is_in(F.col("column"), options.critical) & (F.col("psi") >= options.critical_psi_thresh)
    by_ks = F.coalesce(F.col("ks_p") <= options.ks_p_thresh, F.lit(False))
    return features.withColumn("critical_hit", hit).withColumn(
        "drift", (F.col("psi") >= options.feature_psi_thresh) | by_ks | hit
    )


def drift_report(ref, cur: DataFrame, options: DriftOptions = DriftOptions()) -> DataFrame:
    """One row per feature in report order: column, type, psi, ks_p, drift."""
    verdicts = feature_verdicts(column_metrics(ref, cur, options), options)
    return _details(verdicts)


def _details(verdicts: DataFrame) -> DataFrame:
    return verdicts.select(
        "pos", "column", F.col("kind").alias("type"), F.round("psi", 4).alias("psi"), "ks_p", "drift"
    )


def detect_drift(
    ref, cur: DataFrame, options: DriftOptions = DriftOptions(), force: bool = False
) -> DriftResult:
    """Details and the one-row nested summary that the report sink writes."""
    metrics = column_metrics(ref, cur, options)
    return DriftResult(_details(feature_verdicts(metrics, options)), summarise(metrics, options, force))


def summarise(metrics: DataFrame, options: DriftOptions, force: bool = False) -> DataFrame:
    """Roll-up and trigger over the per-column table (one row per column)."""
    is_feature = F.col("kind") != "prediction"
    hit = is_feature & _is_in(F.col("column"), options.critical) & (F.col("psi") >= options.critical_psi_thresh)
    by_ks = F.coalesce(F.col("ks_p") <= options.ks_p_thresh, F.lit(False))
    drift = is_feature & ((F.col("psi") >= options.feature_psi_thresh) | by_ks | hit)
    detail = F.struct(
        "pos", "column", F.col("kind").alias("type"), F.round("psi", 4).alias("psi"), "ks_p", drift.alias("drift")
    )
    rolled = metrics.agg(
        F.greatest(F.count_if(is_feature), F.lit(1)).alias("n_features"),
        F.count_if(drift).alias("n_drifted"),
        F.coalesce(F.max(F.when(is_feature, F.col("psi"))), F.lit(0.0)).alias("_max_psi"),
        F.array_sort(F.collect_set(F.when(hit, F.col("column")))).alias("critical_hits"),
        F.max(F.when(~is_feature, F.col("psi"))).alias("_pred_psi"),
        F.max(F.when(~is_feature, F.col("ks_p"))).alias("pred_ks_p"),
        F.array_sort(F.collect_list(F.when(is_feature, detail))).alias("_details"),
    )
    pred_gate = F.coalesce(
        (F.col("_pred_psi") >= options.pred_psi_thresh)
        | (F.lit(options.pred_ks_p_thresh > 0) & (F.col("pred_ks_p") <= options.pred_ks_p_thresh)),
        F.lit(False),
    )
    share = F.col("n_drifted") / F.col("n_features")
    trigger = (
        (share >= options.drift_share_thresh)
        | (F.col("_max_psi") >= options.any_feature_psi_thresh)
        | (F.size("critical_hits") > 0)
        | pred_gate
    )
    return rolled.select(
        (F.lit(True) if force else trigger).alias("trigger_retrain"),
        F.round(share, 4).alias("share_drifted"),
        "n_features",
        "n_drifted",
        F.round("_max_psi", 4).alias("max_feature_psi"),
        F.lit(options.any_feature_psi_thresh).alias("any_feature_psi_thresh"),
        "critical_hits",
        F.lit(options.critical_psi_thresh).alias("critical_psi_thresh"),
        F.round("_pred_psi", 4).alias("pred_psi"),
        "pred_ks_p",
        pred_gate.alias("pred_gate"),
        F.lit(options.feature_psi_thresh).alias("feature_psi_thresh"),
        F.lit(options.ks_p_thresh).alias("ks_p_thresh"),
        F.lit(options.drift_share_thresh).alias("drift_share_thresh"),
        F.lit(options.pred_psi_thresh).alias("pred_psi_thresh"),
        F.lit(options.pred_ks_p_thresh).alias("pred_ks_p_thresh"),
        F.lit(True if force else None).cast("boolean").alias("forced"),
        F.transform("_details", lambda d: d.dropFields("pos")).alias("details"),
    )


def top_columns(report: DataFrame, k: int = 5) -> DataFrame:
    """The ``k`` columns with the largest PSI; ties by name."""
    return report.orderBy(F.desc("psi"), "column").limit(k)


def drifted_columns(report: DataFrame) -> DataFrame:
    return report.where("drift")


def exploded_details(summary: DataFrame) -> DataFrame:
    """Back from a nested report to one row per column."""
    return summary.select(F.posexplode("details").alias("pos", "d")).select("pos", "d.*")


def printed_report(summary: DataFrame, k: int = 5) -> DataFrame:
    """(line_no, line): the text a monitor run prints."""
    details = F.col("details")
    ranked = F.slice(
        F.array_sort(
            details,
            lambda a, b: F.when(a["psi"] > b["psi"], -1).when(a["psi"] < b["psi"], 1)
            .when(a["column"] < b["column"], -1).when(a["column"] > b["column"], 1).otherwise(0),
        ),
        1, k,
    )
    n_drift = F.size(F.filter(details, lambda d: d["drift"]))
    yes_no = lambda c, yes, no: F.when(c, yes).otherwise(no)
    lines = F.flatten(
        F.array(
            F.array(
                F.format_string("Drift detected: %s", yes_no(F.col("trigger_retrain"), "True", "False")),
                F.format_string("Feature drift share: %.1f%%", F.col("share_drifted") * 100),
                F.format_string("Max PSI: %.3f", F.col("max_feature_psi")),
                F.format_string("Features with drift: %d/%d", n_drift, F.size(details)),
            ),
            F.transform(
                ranked,
                lambda d: F.format_string("%s %s: PSI=%.3f", yes_no(d["drift"], "DRIFT", "OK"), d["column"], d["psi"]),
            ),
            F.when(
                F.col("pred_psi").isNotNull(),
                F.array(
                    F.format_string("Prediction PSI: %.3f", F.col("pred_psi")),
                    F.format_string("Prediction gate: %s", yes_no(F.col("pred_gate"), "TRIGGERED", "OK")),
                ),
            ).otherwise(F.array().cast("array<string>")),
        )
    )
    return summary.select(F.posexplode(lines).alias("line_no", "line"))
