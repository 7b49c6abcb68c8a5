"""Drift decision queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.columns import compared_columns, drop_targets, field, numeric_columns, schema_difference, typed_partition
from ..operators.drift import (
    DriftOptions,
    detect_drift,
    drift_report,
    drifted_columns,
    exploded_details,
    printed_report,
    top_columns,
)
from ..operators.sampling import inject_drift, mock_predictions
from .registry import register, table
from .samples import (
    EVENT_CUT,
    LINE_CATEGORICAL,
    LINE_NUMERIC,
    beta_sql,
    events_pair,
    lineitem_metrics_sql,
    lineitem_pair,
    metrics_sql,
)

_OPTIONS = DriftOptions(
    ignore=frozenset({"l_orderkey"}), critical=frozenset({"l_quantity", "l_tax"}), ks_method="asymp"
)
_DRIFT = "(psi >= 0.2 OR coalesce(ks_p <= 0.01, false) OR (column_name IN ('l_quantity', 'l_tax') AND psi >= 0.5))"


def line_report(spark, sf_dir):
    return drift_report(*lineitem_pair(spark, sf_dir), _OPTIONS)


def report_columns(report):
    return report.select(
        "pos", F.col("column").alias("column_name"), "type", "psi", F.round("ks_p", 9).alias("ks_p"), "drift"
    )


_REPORT_SQL = (
    lineitem_metrics_sql()
    + f" SELECT pos, column_name, kind AS type, round(psi, 4) AS psi, round(ks_p, 9) AS ks_p, {_DRIFT} AS drift FROM metrics"
)


@register("drift_report", _REPORT_SQL)
def _report(spark, sf_dir):
    return report_columns(line_report(spark, sf_dir))


@register("drift_top5", f"SELECT * FROM ({_REPORT_SQL}) ORDER BY psi DESC, column_name LIMIT 5")
def _top5(spark, sf_dir):
    return report_columns(top_columns(line_report(spark, sf_dir), 5))


@register("drifted_only", f"SELECT * FROM ({_REPORT_SQL}) WHERE drift")
def _drifted(spark, sf_dir):
    return report_columns(drifted_columns(line_report(spark, sf_dir)))


@register("report_details", f"SELECT * FROM ({_REPORT_SQL})")
def _details(spark, sf_dir):
    summary = detect_drift(*lineitem_pair(spark, sf_dir), _OPTIONS).summary
    return report_columns(exploded_details(summary))


_SUMMARY_COLUMNS = [
    "trigger_retrain", "share_drifted", "n_features", "n_drifted", "max_feature_psi", "critical_hits",
    "pred_psi", "pred_ks_p", "pred_gate",
]


def summary_columns(summary):
    return summary.select(*_SUMMARY_COLUMNS).withColumns(
        {"critical_hits": F.array_join("critical_hits", ","), "pred_ks_p": F.round("pred_ks_p", 9)}
    )


def _summary_sql(metrics: str, drift: str, critical: str, pred_psi: str, pred_gate: str, thresholds: tuple) -> str:
    share, any_psi = thresholds
    return metrics + f""", f AS (SELECT *, {drift} AS drift FROM metrics WHERE kind <> 'prediction'),
    g AS (SELECT greatest(count(*), 1) AS n_features, count(*) FILTER (drift) AS n_drifted, max(psi) AS max_psi,
      list_sort(list(column_name) FILTER ({critical})) AS hits FROM f),
    p AS (SELECT max(psi) FILTER (kind = 'prediction') AS pp, max(ks_p) FILTER (kind = 'prediction') AS pk FROM metrics)
    SELECT (n_drifted / n_features >= {share} OR max_psi >= {any_psi} OR coalesce(len(hits), 0) > 0 OR {pred_gate}) AS trigger_retrain,
      round(n_drifted / n_features, 4) AS share_drifted, n_features, n_drifted, round(max_psi, 4) AS max_feature_psi,
      coalesce(array_to_string(hits, ','), '') AS critical_hits, {pred_psi} AS pred_psi, round(pk, 9) AS pred_ks_p,
      {pred_gate} AS pred_gate FROM g, p"""


@register(
    "drift_summary",
    _summary_sql(
        lineitem_metrics_sql(), _DRIFT, "column_name IN ('l_quantity', 'l_tax') AND psi >= 0.5",
        "round(pp, 4)", "coalesce(pp >= 0.2, false)", (0.3, 1.0),
    ),
)
def _summary(spark, sf_dir):
    return summary_columns(detect_drift(*lineitem_pair(spark, sf_dir), _OPTIONS).summary)


_EVENTS_SCORED = f"""
tagged AS (
  SELECT ts >= TIMESTAMP '{EVENT_CUT}' AS is_cur, event_id, user_id, event_type, value, props,
         CASE WHEN ts >= TIMESTAMP '{EVENT_CUT}' THEN {beta_sql("event_id", 123)} ELSE {beta_sql("event_id", 42)} END AS pred
  FROM events)"""
_EVENT_METRICS = metrics_sql(
    _EVENTS_SCORED, [(0, "user_id", "user_id"), (1, "value", "value"), (4, "pred_readmit", "pred")],
    [(2, "event_type", "event_type"), (3, "props", "props")],
).replace(
    "metrics AS (SELECT * FROM num_metrics",
    "metrics AS (SELECT * REPLACE (CASE WHEN pos = 4 THEN 'prediction' ELSE kind END AS kind) FROM num_metrics",
)


# Demo thresholds with the KS test on predictions switched on.
EVENT_OPTIONS = DriftOptions.demo(ignore=frozenset({"event_id"}), ks_method="asymp", pred_ks_p_thresh=0.05)
SCORED_SUMMARY_SQL = _summary_sql(
    _EVENT_METRICS, "(psi >= 0.1 OR coalesce(ks_p <= 0.05, false))", "false", "round(pp, 4)",
    "coalesce(pp >= 0.1 OR pk <= 0.05, false)", (0.3, 1.0),
)


@register("drift_summary_scored", SCORED_SUMMARY_SQL)
def _summary_scored(spark, sf_dir):
    ref, cur = events_pair(spark, sf_dir)
    ref, cur = mock_predictions(ref, ["event_id"], 42), mock_predictions(cur, ["event_id"], 123)
    return summary_columns(detect_drift(ref, cur, EVENT_OPTIONS).summary)


@register(
    "printed_report",
    "WITH s AS ("
    + _summary_sql(
        lineitem_metrics_sql(), _DRIFT, "column_name IN ('l_quantity', 'l_tax') AND psi >= 0.5",
        "round(pp, 4)", "coalesce(pp >= 0.2, false)", (0.3, 1.0),
    )
    + f"), d AS ({_REPORT_SQL}), k AS (SELECT *, row_number() OVER (ORDER BY psi DESC, column_name) AS r FROM d) "
    + """SELECT CAST(0 AS INTEGER) AS line_no, printf('Drift detected: %s', CASE WHEN trigger_retrain THEN 'True' ELSE 'False' END) AS line FROM s
    UNION ALL SELECT 1, printf('Feature drift share: %.1f%%', share_drifted * 100) FROM s
    UNION ALL SELECT 2, printf('Max PSI: %.3f', round(max_feature_psi, 3)) FROM s
    UNION ALL SELECT 3, printf('Features with drift: %d/%d', n_drifted, n_features) FROM s
    UNION ALL SELECT CAST(3 + r AS INTEGER), printf('%s %s: PSI=%.3f', CASE WHEN drift THEN 'DRIFT' ELSE 'OK' END, column_name, round(psi, 3))
    FROM k WHERE r <= 5""",
)
def _printed(spark, sf_dir):
    return printed_report(detect_drift(*lineitem_pair(spark, sf_dir), _OPTIONS).summary)


@register(
    "drift_inject",
    "SELECT l_orderkey, l_linenumber, l_partkey, l_quantity + 10 AS l_quantity FROM lineitem",
)
def _inject(spark, sf_dir):
    shifted = inject_drift(table(spark, sf_dir, "lineitem"), "l_quantity", 10)
    return shifted.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")


@register(
    "schema_diff",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count({c}) AS n_values FROM lineitem"
        for c in ("l_partkey", "l_suppkey", "l_returnflag", "l_linestatus")
    ),
)
def _schema_diff(spark, sf_dir):
    """Columns the current table lacks, with the baseline values that go uncompared."""
    ref = table(spark, sf_dir, "lineitem")
    cur = ref.drop("l_partkey", "l_suppkey", "l_returnflag", "l_linestatus")
    missing = [r["column"] for r in schema_difference(ref, cur).collect()]
    counted = ref.agg(*[F.count(field(c)).alias(c) for c in missing])
    return counted.unpivot([], missing, "column_name", "n_values")


@register(
    "column_kinds",
    " UNION ALL ".join(
        [f"SELECT '{c}' AS column_name, 'numeric' AS kind, count({c}) AS n_values FROM lineitem"
         for c in ["l_orderkey", *LINE_NUMERIC]]
        + [f"SELECT '{c}' AS column_name, 'categorical' AS kind, count({c}) AS n_values FROM lineitem" for c in LINE_CATEGORICAL]
    ),
)
def _kinds(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem")
    kinds = typed_partition(rows)
    names = [r["column"] for r in kinds.collect()]
    counts = rows.agg(*[F.count(field(c)).alias(c) for c in names]).unpivot([], names, "column", "n_values")
    return counts.join(F.broadcast(kinds), "column").select(F.col("column").alias("column_name"), "kind", "n_values")


@register(
    "compared_columns",
    """SELECT 0 AS pos, 'user_id' AS column_name, 'numeric' AS kind, count(user_id) AS n_values FROM events
    UNION ALL SELECT 1, 'value', 'numeric', count(value) FROM events
    UNION ALL SELECT 2, 'event_type', 'categorical', count(event_type) FROM events
    UNION ALL SELECT 3, 'props', 'categorical', count(props) FROM events""",
)
def _compared(spark, sf_dir):
    ref, cur = events_pair(spark, sf_dir)
    columns = compared_columns(ref, cur.withColumn("extra", F.lit(1)), {"event_id"})
    both = ref.unionByName(cur)
    counts = both.agg(*[F.count(c.name).alias(c.name) for c in columns]).unpivot(
        [], [c.name for c in columns], "column_name", "n_values"
    )
    specs = spark.createDataFrame([(c.position, c.name, c.kind) for c in columns], "pos int, column_name string, kind string")
    return counts.join(F.broadcast(specs), "column_name").select("pos", "column_name", "kind", "n_values")


@register(
    "table_shape",
    "SELECT count(*) AS n_rows, CAST(11 AS INTEGER) AS n_columns, CAST(8 AS INTEGER) AS n_numeric FROM lineitem",
)
def _shape(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem")
    return rows.agg(
        F.count(F.lit(1)).alias("n_rows"), F.lit(len(rows.columns)).alias("n_columns"),
        F.lit(len(numeric_columns(rows))).alias("n_numeric"),
    )


@register("targets_dropped", "SELECT DISTINCT doc_id, l.toxic IS NULL AS unmarked, 3::BIGINT AS n_before, 2::BIGINT AS n_after FROM labels l")
def _targets_dropped(spark, sf_dir):
    """A frame that still carries the target under its usual name loses it, and nothing else."""
    rows = table(spark, sf_dir, "labels").select(
        "doc_id", F.col("quality").alias("readmitted"), F.col("toxic").isNull().alias("unmarked"))
    kept = drop_targets(rows)
    counted = {"n_before": F.lit(len(rows.columns)).cast("bigint"), "n_after": F.lit(len(kept.columns)).cast("bigint")}
    return kept.withColumns(counted).distinct()
