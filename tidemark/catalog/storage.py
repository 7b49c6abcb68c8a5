"""Sinks read back: each query writes under the checkpoint folder and reads again."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators.drift import detect_drift, drift_report, exploded_details
from ..operators.sampling import inject_drift, mock_predictions
from ..plans.refresh import drift_check
from ..plans.training import train_boosted, with_scores
from ..session import checkpoint_dir
from ..sources.models import export_model, load_model, save_model
from ..sources.payloads import normalised_scores, parse_payloads, read_payloads
from ..sources.people import people_messages, read_people
from ..sources.profiles import read_profile, write_profile
from ..sources.reports import drifted_in_reports, read_reports, write_report
from ..sources.runs import append_runs, read_config, read_runs, write_config
from ..sources.tables import read_snapshot, read_table_csv, write_snapshot, write_table_csv
from ..streaming.incremental import check_new_files
from .controls import _OPTIONS, _REPORT_SQL, EVENT_OPTIONS, SCORED_SUMMARY_SQL, report_columns, summary_columns
from .experiments import _FOLDS, fold_metrics
from .models import FIRST_TREE, FIRST_TREE_SQL, labelled_documents
from .registry import register, table
from .samples import beta_sql, events_pair, lineitem_pair


def _scratch(spark, what: str) -> str:
    return f"{checkpoint_dir(spark)}/{what}-{uuid.uuid4().hex}"


@register("csv_round_trip", "SELECT o_orderkey, o_custkey, o_orderstatus, round(o_totalprice, 2) AS o_totalprice, o_orderdate, o_orderpriority FROM orders")
def _csv(spark, sf_dir):
    path = _scratch(spark, "csv")
    orders = table(spark, sf_dir, "orders")
    write_table_csv(orders, path)
    return read_table_csv(spark, path, orders.schema).withColumn("o_totalprice", F.round("o_totalprice", 2))


@register(
    "csv_free_text",
    "SELECT doc_id, '  \"' || text || '\", \"\"' || chr(10) || text || ' ' AS text, CAST(NULL AS VARCHAR) AS nothing FROM documents",
)
def _csv_text(spark, sf_dir):
    """Cells with padding, quotes, delimiters and line breaks come back as they were."""
    path = _scratch(spark, "csv-text")
    text = F.concat(F.lit('  "'), F.col("text"), F.lit('", ""\n'), F.col("text"), F.lit(" "))
    docs = table(spark, sf_dir, "documents").select("doc_id", text.alias("text"), F.lit(None).cast("string").alias("nothing"))
    write_table_csv(docs, path)
    return read_table_csv(spark, path, docs.schema)


@register(
    "drift_dataset_round_trip",
    "SELECT l_orderkey, l_linenumber, l_quantity + 10 AS l_quantity, l_returnflag FROM lineitem",
)
def _drift_dataset(spark, sf_dir):
    """A full copy with one shifted column, written and read as CSV."""
    path = _scratch(spark, "drift")
    lines = table(spark, sf_dir, "lineitem").drop("l_shipdate")
    write_table_csv(inject_drift(lines, "l_quantity", 10), path)
    return read_table_csv(spark, path, lines.schema).select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag")


@register("scored_snapshot", f"SELECT event_id, value, round({beta_sql('event_id', 42)}, 9) AS pred FROM events")
def _snapshot(spark, sf_dir):
    path = _scratch(spark, "snapshot")
    scored = mock_predictions(table(spark, sf_dir, "events").select("event_id", "value"), ["event_id"], 42, "pred")
    write_snapshot(scored, path)
    return read_snapshot(spark, path).withColumn("pred", F.round("pred", 9))


@register("report_round_trip", f"SELECT '20240131T000000Z' AS run_ts, column_name, type, psi, ks_p FROM ({_REPORT_SQL}) WHERE drift")
def _report(spark, sf_dir):
    path = _scratch(spark, "report")
    summary = detect_drift(*lineitem_pair(spark, sf_dir), _OPTIONS).summary
    write_report(summary, path, F.lit("2024-01-31 00:00:00").cast("timestamp"))
    rows = drifted_in_reports(read_reports(spark, path))
    return rows.select("run_ts", F.col("column").alias("column_name"), "type", "psi", F.round("ks_p", 9).alias("ks_p"))


@register("drift_report_profiled", _REPORT_SQL)
def _report_profiled(spark, sf_dir):
    """The baseline's profile is stored and read back; the check reads it in the baseline's place."""
    path = _scratch(spark, "profile")
    ref, cur = lineitem_pair(spark, sf_dir)
    write_profile(ref, path)
    return report_columns(drift_report(read_profile(spark, path), cur, _OPTIONS))


@register("new_files_report", _REPORT_SQL)
def _new_files(spark, sf_dir):
    """Files that landed in a folder are checked once; the report of the batch is read back."""
    path = _scratch(spark, "landed")
    ref, cur = lineitem_pair(spark, sf_dir)
    cur.write.parquet(f"{path}/in/first")
    for _ in range(2):  # nothing new the second time
        check_new_files(spark, ref, f"{path}/in/*", cur.schema, f"{path}/reports", f"{path}/checkpoint", _OPTIONS)
    return report_columns(exploded_details(read_reports(spark, f"{path}/reports")))


@register(
    "payload_files",
    "SELECT c_mktsegment AS segment, count(*) AS n, round(sum(c_acctbal), 4) AS total FROM customer GROUP BY 1",
)
def _payload_files(spark, sf_dir):
    """Stored answers for a hundred rows at most, one per file, read whole and brought to scores."""
    path = _scratch(spark, "payloads")
    request = F.concat_ws("-", "c_mktsegment", F.floor(F.col("c_custkey") / 100).cast("string")).alias("request")
    rows = table(spark, sf_dir, "customer").groupBy(request).agg(F.collect_list("c_acctbal").alias("v"))
    body = F.to_json(F.struct(F.col("v").alias("predictions")))
    rows.select("request", body.alias("value")).write.partitionBy("request").text(path)
    payloads = read_payloads(spark, f"{path}/*").withColumn("segment", F.regexp_extract("path", "/request=([^/]+)-[0-9]+/", 1))
    scores = normalised_scores(parse_payloads(payloads, "path", "payload"), "path").join(payloads.select("path", "segment"), "path")
    return scores.groupBy("segment").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("score"), 4).alias("total"))


@register(
    "people_file",
    "SELECT s_name AS name, n_name AS craft, s_name || ' is currently in space flying on the ' || n_name || '! Hello! :)' AS message "
    "FROM supplier JOIN nation ON s_nationkey = n_nationkey",
)
def _people_file(spark, sf_dir):
    """Stored lists with their counts, one file for each nation, read back and fanned out; the stand-in is not used."""
    path = _scratch(spark, "people")
    rows = table(spark, sf_dir, "supplier").join(F.broadcast(table(spark, sf_dir, "nation")), F.col("s_nationkey") == F.col("n_nationkey"))
    entry = F.struct(F.col("n_name").alias("craft"), F.col("s_name").alias("name"))
    rows.groupBy(F.col("n_nationkey").alias("nation")).agg(
        F.count(F.lit(1)).cast("int").alias("number"), F.collect_list(entry).alias("people")).write.partitionBy("nation").json(path)
    return people_messages(read_people(spark, path))


@register("stored_model_scores", FIRST_TREE_SQL + " SELECT doc_id, round(1 / (1 + exp(-value)), 9) AS pred_proba FROM r2 JOIN nodes USING (path)")
def _stored_model(spark, sf_dir):
    """A model saved, exported, loaded again and used on raw rows."""
    path = _scratch(spark, "model")
    rows = labelled_documents(spark, sf_dir)
    save_model(spark, train_boosted(rows, "quality", FIRST_TREE, ("doc_id",), keys=["doc_id"]), f"{path}/run")
    export_model(spark, f"{path}/run", f"{path}/export")
    scored = with_scores(load_model(spark, f"{path}/export"), rows.where("quality IS NOT NULL"))
    return scored.select("doc_id", F.round("pred_proba", 9).alias("pred_proba"))


@register("drift_check_job", SCORED_SUMMARY_SQL)
def _check_job(spark, sf_dir):
    """The whole check: score both sides, snapshot, compare, write the report, read it back."""
    path = _scratch(spark, "check")
    drift_check(
        *events_pair(spark, sf_dir), EVENT_OPTIONS, keys=["event_id"], report_path=f"{path}/reports",
        snapshot_path=f"{path}/scored",
    )
    return summary_columns(read_reports(spark, f"{path}/reports"))


@register(
    "run_store_round_trip",
    f"WITH {_FOLDS} SELECT 'trial-' || trial_id || '-' || fold AS run_id, round(auc, 9) AS auc, CAST(fold AS VARCHAR) AS fold FROM folds",
)
def _runs(spark, sf_dir):
    path = _scratch(spark, "runs")
    rows = fold_metrics(spark, sf_dir)
    run_id = F.concat_ws("-", F.lit("trial"), F.col("trial_id").cast("string"), F.col("fold").cast("string"))
    runs = rows.select(
        F.lit("0").alias("experiment_id"), F.lit("lines").alias("experiment"), run_id.alias("run_id"),
        run_id.alias("run_name"), F.lit(4).alias("status"), F.lit(0).cast("bigint").alias("start_time"),
        F.lit(None).cast("bigint").alias("end_time"),
        F.create_map(F.lit("fold"), F.col("fold").cast("string")).alias("params"),
        F.create_map(F.lit("val_auc"), F.col("auc")).alias("metrics"),
        F.create_map(F.lit("kind"), F.lit("trial")).alias("tags"),
    )
    append_runs(runs, path)
    back = read_runs(spark, path)
    return back.select("run_id", F.round(back.metrics["val_auc"], 9).alias("auc"), back.params["fold"].alias("fold"))


@register(
    "best_config_round_trip",
    """SELECT CAST(200 + l_suppkey AS INTEGER) AS n_estimators, CAST(3 AS INTEGER) AS max_depth, round(avg(l_discount), 9) AS learning_rate
    FROM lineitem GROUP BY l_suppkey ORDER BY 3 DESC, 1 LIMIT 1""",
)
def _config(spark, sf_dir):
    path = _scratch(spark, "config")
    mean = table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(F.round(F.avg("l_discount"), 9).alias("learning_rate"))
    config = mean.select(
        (F.col("l_suppkey") + 200).cast("int").alias("n_estimators"), F.lit(3).alias("max_depth"), "learning_rate"
    )
    write_config(config.orderBy(F.desc("learning_rate"), "n_estimators").limit(1), path)
    return read_config(spark, path).select("n_estimators", "max_depth", "learning_rate")
