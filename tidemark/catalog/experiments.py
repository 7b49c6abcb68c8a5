"""Trial and run selection. Trials and runs are derived from the order tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.draws import log_uniform, random_integer, uniform, uniform_between
from ..plans.tuning import best_trial, fold_means, trials_by_folds
from ..sources.runs import RUN_NAME_TAG, exported_params, first_runs, latest_run, promote, runs_named
from .registry import register, table
from .samples import uniform_sql


def fold_metrics(spark, sf_dir):
    """One trial per supplier, one fold per line number, four averages as metrics."""
    lines = table(spark, sf_dir, "lineitem")
    return lines.groupBy(F.col("l_suppkey").alias("trial_id"), (F.col("l_linenumber") % 5).alias("fold")).agg(
        F.avg("l_discount").alias("auc"), F.avg("l_tax").alias("ap"),
        F.avg(F.col("l_quantity") / 50).alias("acc"), F.avg(F.col("l_extendedprice") / 100000).alias("f1"),
    )


_FOLDS = """folds AS (SELECT l_suppkey AS trial_id, l_linenumber % 5 AS fold, avg(l_discount) AS auc, avg(l_tax) AS ap,
  avg(l_quantity / 50) AS acc, avg(l_extendedprice / 100000) AS f1 FROM lineitem GROUP BY 1, 2)"""
_MEANS = f"""{_FOLDS}, means AS (SELECT trial_id, round(avg(auc), 9) AS val_auc, round(avg(ap), 9) AS val_ap,
  round(avg(acc), 9) AS val_acc, round(avg(f1), 9) AS val_f1 FROM folds GROUP BY trial_id)"""


def _means(spark, sf_dir):
    means = fold_means(fold_metrics(spark, sf_dir))
    return means.select("trial_id", *[F.round(c, 9).alias(c) for c in means.columns if c != "trial_id"])


@register("trial_mean", f"WITH {_MEANS} SELECT * FROM means")
def _trial_mean(spark, sf_dir):
    return _means(spark, sf_dir)


@register("best_trial", f"WITH {_MEANS} SELECT * FROM means ORDER BY val_auc DESC, trial_id LIMIT 1")
def _best(spark, sf_dir):
    return best_trial(_means(spark, sf_dir))


@register("trials_by_folds", "SELECT s_suppkey AS trial_id, CAST(i AS INTEGER) AS fold FROM supplier, range(5) f(i)")
def _by_folds(spark, sf_dir):
    trials = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("trial_id"))
    return trials_by_folds(trials, 5)


@register(
    "trial_configs",
    f"""SELECT p_partkey AS trial_id, CAST(200 + floor({uniform_sql('p_partkey', 42, 0)} * 700) AS INTEGER) AS n_estimators,
    CAST(3 + floor({uniform_sql('p_partkey', 42, 1)} * 8) AS INTEGER) AS max_depth,
    round(exp(ln(1e-3) + {uniform_sql('p_partkey', 42, 2)} * (ln(3e-1) - ln(1e-3))), 9) AS learning_rate,
    round(0.6 + {uniform_sql('p_partkey', 42, 3)} * (1.0 - 0.6), 9) AS subsample,
    round(0.6 + {uniform_sql('p_partkey', 42, 4)} * (1.0 - 0.6), 9) AS colsample_bytree,
    round(exp(ln(1e-1) + {uniform_sql('p_partkey', 42, 5)} * (ln(1e1) - ln(1e-1))), 9) AS min_child_weight,
    round(exp(ln(1e-8) + {uniform_sql('p_partkey', 42, 6)} * (ln(1e-1) - ln(1e-8))), 9) AS reg_alpha,
    round(exp(ln(1e-2) + {uniform_sql('p_partkey', 42, 7)} * (ln(1e1) - ln(1e-2))), 9) AS reg_lambda FROM part""",
)
def _configs(spark, sf_dir):
    u = lambda d: uniform(["p_partkey"], 42, d)
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("trial_id"),
        random_integer(u(0), 200, 900).alias("n_estimators"),
        random_integer(u(1), 3, 11).alias("max_depth"),
        F.round(log_uniform(u(2), 1e-3, 3e-1), 9).alias("learning_rate"),
        F.round(uniform_between(u(3), 0.6, 1.0), 9).alias("subsample"),
        F.round(uniform_between(u(4), 0.6, 1.0), 9).alias("colsample_bytree"),
        F.round(log_uniform(u(5), 1e-1, 1e1), 9).alias("min_child_weight"),
        F.round(log_uniform(u(6), 1e-8, 1e-1), 9).alias("reg_alpha"),
        F.round(log_uniform(u(7), 1e-2, 1e1), 9).alias("reg_lambda"),
    )


def order_runs(spark, sf_dir):
    """Orders as runs: status as experiment, priority as run name, price as metric."""
    orders = table(spark, sf_dir, "orders")
    return orders.select(
        F.col("o_orderkey").cast("string").alias("run_id"), F.col("o_orderstatus").alias("experiment"),
        F.expr(
            "timestampdiff(MILLISECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', CAST(o_orderdate AS TIMESTAMP_NTZ))"
        ).alias("start_time"),
        F.create_map(F.lit("val_auc"), F.col("o_totalprice")).alias("metrics"),
        F.create_map(
            F.lit("max_depth"), F.lit("3"), F.lit("min_child_weight"), F.lit("1"),
            F.lit("learning_rate"), F.col("o_custkey").cast("string"),
        ).alias("params"),
        F.create_map(F.lit(RUN_NAME_TAG), F.col("o_orderpriority")).alias("tags"),
    )


_RUNS = """runs AS (SELECT CAST(o_orderkey AS VARCHAR) AS run_id, o_orderstatus AS experiment,
  epoch_ms(o_orderdate) AS start_time, o_totalprice AS auc, o_custkey, o_orderpriority AS name FROM orders)"""
_NAMED = "experiment = 'F' AND name = '1-URGENT'"


def _named(spark, sf_dir):
    return runs_named(order_runs(spark, sf_dir), "F", "1-URGENT")


@register("runs_by_tag", f"WITH {_RUNS} SELECT run_id, start_time, auc FROM runs WHERE {_NAMED}")
def _runs_by_tag(spark, sf_dir):
    return _named(spark, sf_dir).select("run_id", "start_time", F.element_at("metrics", "val_auc").alias("auc"))


@register("latest_run", f"WITH {_RUNS} SELECT run_id, start_time FROM runs WHERE {_NAMED} ORDER BY start_time DESC, run_id LIMIT 1")
def _latest(spark, sf_dir):
    return latest_run(_named(spark, sf_dir)).select("run_id", "start_time")


@register("first_runs", f"WITH {_RUNS} SELECT run_id, start_time FROM runs WHERE {_NAMED} ORDER BY start_time, run_id LIMIT 3")
def _first(spark, sf_dir):
    return first_runs(_named(spark, sf_dir)).select("run_id", "start_time")


@register(
    "run_artifacts",
    f"""WITH {_RUNS}, a AS (SELECT CAST(l_orderkey AS VARCHAR) AS run_id, 'models/' || min(l_partkey) AS path FROM lineitem GROUP BY 1)
    SELECT run_id, path FROM runs JOIN a USING (run_id) WHERE {_NAMED}""",
)
def _artifacts(spark, sf_dir):
    return artifact_paths(spark, sf_dir).join(_named(spark, sf_dir).select("run_id"), "run_id").select("run_id", "path")


def artifact_paths(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").cast("string").alias("run_id")).agg(
        F.concat(F.lit("models/"), F.min("l_partkey").cast("string")).alias("path")
    )


@register(
    "promoted_model",
    f"""WITH {_RUNS}, a AS (SELECT CAST(l_orderkey AS VARCHAR) AS run_id, 'models/' || min(l_partkey) AS path FROM lineitem GROUP BY 1)
    SELECT 'readmission' AS model, run_id, path FROM a
    WHERE run_id = (SELECT run_id FROM runs WHERE {_NAMED} ORDER BY start_time DESC, run_id LIMIT 1)""",
)
def _promoted(spark, sf_dir):
    pointer = promote(order_runs(spark, sf_dir), artifact_paths(spark, sf_dir), "readmission", "F", "1-URGENT")
    return pointer.select("model", "run_id", "path")


@register(
    "exported_params",
    """SELECT CAST(o_orderkey AS VARCHAR) AS run_id, '3' AS max_depth, CAST(o_custkey AS VARCHAR) AS learning_rate,
    CAST(NULL AS VARCHAR) AS min_child_weight FROM orders""",
)
def _exported(spark, sf_dir):
    kept = order_runs(spark, sf_dir).select("run_id", exported_params(F.col("params")).alias("p"))
    return kept.select(
        "run_id", *[F.try_element_at("p", F.lit(k)).alias(k) for k in ("max_depth", "learning_rate", "min_child_weight")]
    )
