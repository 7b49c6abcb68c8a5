"""Drift report sink and source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import utc_stamp

REPORT_SCHEMA = (
    "trigger_retrain boolean, share_drifted double, n_features bigint, n_drifted bigint, "
    "max_feature_psi double, any_feature_psi_thresh double, critical_hits array<string>, "
    "critical_psi_thresh double, pred_psi double, pred_ks_p double, pred_gate boolean, "
    "feature_psi_thresh double, ks_p_thresh double, drift_share_thresh double, "
    "pred_psi_thresh double, pred_ks_p_thresh double, forced boolean, "
    "details array<struct<column:string,type:string,psi:double,ks_p:double,drift:boolean>>"
)


def write_report(summary: DataFrame, path: str, at: Column | None = None, key: str | None = None) -> None:
    """Appends the one-row summary as JSON under ``run_ts=<UTC stamp>``.

    ``at`` is a UTC wall-clock time; by default the current one. With a ``key``
    the report replaces an earlier one of that key, so a job may be repeated.
    """
    now = F.to_utc_timestamp(F.current_timestamp(), F.current_timezone())
    stamped = summary.withColumn("run_ts", utc_stamp(now if at is None else at))
    if key is not None:
        stamped.write.mode("overwrite").json(f"{path}/key={key}")
    else:
        stamped.write.mode("append").partitionBy("run_ts").json(path)


def read_reports(spark: SparkSession, path: str) -> DataFrame:
    """Reports written by ``write_report``, with ``run_ts`` as text."""
    return spark.read.schema(REPORT_SCHEMA + ", run_ts string").json(path)


def read_report_files(spark: SparkSession, path: str) -> DataFrame:
    """Pretty-printed single-object report files; absent keys are NULL.

    The stamp is taken from the file name ``drift_summary_<stamp>.json``.
    """
    rows = spark.read.schema(REPORT_SCHEMA).option("multiLine", True).json(path)
    name = F.regexp_extract(F.col("_metadata.file_path"), r"drift_summary_([0-9TZ]+)\.json", 1)
    return rows.withColumn("run_ts", name)


def drifted_in_reports(reports: DataFrame) -> DataFrame:
    """(run_ts, column, type, psi, ks_p) of every drifted column."""
    rows = reports.select("run_ts", F.explode("details").alias("d")).select("run_ts", "d.*")
    return rows.where("drift").drop("drift")
