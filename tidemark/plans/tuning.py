"""Random search with stratified folds, and the final fit."""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.draws import log_uniform, random_integer, uniform, uniform_between
from ..operators.binning import fit_binning
from ..operators.evaluation import binary_metrics
from ..operators.ordering import materialised
from ..operators.sampling import stratified_folds, stratified_split
from ..sources.runs import CONFIG_SCHEMA, EXPERIMENT, FINAL_RUN_NAME, RUN_NAME_TAG, runs_frame
from .ensembles import Ensemble, TreeModel, boost_learner
from .training import positive_weight, train_boosted, with_scores

# Folds use this seed whatever the search seed is.
FOLD_SEED = 42
N_FOLDS = 5
METRICS = ("auc", "ap", "acc", "f1")


def search_space(spark: SparkSession, n_trials: int, seed: int = 42) -> DataFrame:
    """(trial_id, config): random draws over the eight dimensions."""
    u = lambda d: uniform([F.col("id")], seed, d)
    # The ranges.
    config = F.struct(
        random_integer(u(0), 200, 900).alias("n_estimators"),
        random_integer(u(1), 3, 11).alias("max_depth"),
        log_uniform(u(2), 1e-3, 3e-1).alias("learning_rate"),
        uniform_between(u(3), 0.6, 1.0).alias("subsample"),
        uniform_between(u(4), 0.6, 1.0).alias("colsample_bytree"),
        log_uniform(u(5), 1e-1, 1e1).alias("min_child_weight"),
        log_uniform(u(6), 1e-8, 1e-1).alias("reg_alpha"),
        log_uniform(u(7), 1e-2, 1e1).alias("reg_lambda"),
    )
    return spark.range(n_trials).select(F.col("id").alias("trial_id"), config.alias("config"))


def trials_by_folds(trials: DataFrame, k: int = N_FOLDS) -> DataFrame:
    """Every (trial, fold) to be fitted: the folds are a k-entry array per trial."""
    return trials.withColumn("fold", F.explode(F.sequence(F.lit(0), F.lit(k - 1))))


def fold_means(fold_metrics: DataFrame, metrics: tuple[str, ...] = METRICS) -> DataFrame:
    """(trial_id, val_*): the mean of each metric over folds."""
    return fold_metrics.groupBy("trial_id").agg(*[F.avg(m).alias(f"val_{m}") for m in metrics])


def best_trial(trials: DataFrame, metric: str = "val_auc") -> DataFrame:
    """The row with the largest metric; trials without it cannot win.

    Ties go to the smallest trial id. Status plays no part: stored runs may be
    marked failed although they have metrics.
    """
    return trials.where(F.col(metric).isNotNull()).orderBy(F.desc(metric), "trial_id").limit(1)


@dataclass
class SearchResult:
    trials: DataFrame  # trial_id, config, val_auc, val_ap, val_acc, val_f1
    fold_metrics: DataFrame
    best_config: dict


def run_search(
    train: DataFrame, keys: list[str], label: str, trials: DataFrame, k: int = N_FOLDS, exclude: tuple[str, ...] = (),
    **limits,
) -> SearchResult:
    """Scores every configuration on the same k folds.

    All (trial, fold) models learn side by side: a round of the search is one tree of each. Bins come from the whole
    table, which has no labels in it; a category that only the held-out fold has is never split on. Out-of-fold scores
    stay a table and are reduced to metrics by (trial, fold) at once.
    """
    spark = train.sparkSession
    folded = stratified_folds(train, keys, label, k, FOLD_SEED)
    configs = [(r["trial_id"], r["config"].asDict()) for r in trials.orderBy("trial_id").collect()]
    models = [(trial, fold, boost_learner(config, fold)) for trial, config in configs for fold in range(k)]
    fit = Ensemble(folded, label, fit_binning(train, (label, *exclude)), [m[2] for m in models],
                   positive_weight(train, label), "fold", keys, **limits).fit()
    try:
        names = spark.createDataFrame([(i, t, f) for i, (t, f, _) in enumerate(models)], "model int, trial_id bigint, fold int")
        scored = fit.held_out_scores().join(F.broadcast(names), "model")
        fold_metrics = materialised(binary_metrics(scored, "y", "score", ["trial_id", "fold"]).select("trial_id", "fold", *METRICS))
    finally:
        fit.close()
    scored_trials = trials.join(F.broadcast(fold_means(fold_metrics)), "trial_id", "left")
    best = best_trial(scored_trials).first()
    return SearchResult(scored_trials, fold_metrics, {} if best is None else best["config"].asDict())


def trial_runs(trials: DataFrame, experiment: str = EXPERIMENT) -> DataFrame:
    """Trial results in the shape of the run table."""
    params = F.map_from_arrays(
        F.array(*[F.lit(f.name) for f in CONFIG_SCHEMA.fields]),
        F.array(*[F.col(f"config.{f.name}").cast("string") for f in CONFIG_SCHEMA.fields]),
    )
    names = [f"val_{m}" for m in METRICS]
    metrics = F.map_filter(
        F.map_from_arrays(F.array(*[F.lit(n) for n in names]), F.array(*[F.col(n) for n in names])),
        lambda _, v: v.isNotNull(),
    )
    now = F.unix_millis(F.current_timestamp())
    return trials.select(
        F.lit(experiment).alias("experiment_id"), F.lit(experiment).alias("experiment"),
        F.concat(F.lit("trial-"), F.col("trial_id").cast("string")).alias("run_id"),
        F.concat(F.lit("trial-"), F.col("trial_id").cast("string")).alias("run_name"),
        F.lit(3).alias("status"), now.alias("start_time"), now.alias("end_time"),
        params.alias("params"), metrics.alias("metrics"),
        F.create_map(F.lit("mlflow.parentRunId"), F.lit(experiment)).alias("tags"),
    )


@dataclass
class FinalFit:
    model: TreeModel
    metrics: dict[str, float]
    run: DataFrame


def fit_final(
    train: DataFrame, test: DataFrame, label: str, config: dict, exclude: tuple[str, ...] = (), experiment: str = EXPERIMENT,
    **options,
) -> FinalFit:
    """Fits the chosen configuration on all of train and measures it on test."""
    started = int(time.time() * 1000)
    model = train_boosted(train, label, config, exclude, **options)
    measured = binary_metrics(with_scores(model, test, "score"), label, "score").first()
    metrics = {f"test_{m}": float(measured[m]) for m in METRICS if measured[m] is not None}
    run = runs_frame(
        train.sparkSession,
        [dict(
            experiment_id=experiment, experiment=experiment, run_id=f"final-{started}", run_name=FINAL_RUN_NAME,
            status=3, start_time=started, end_time=int(time.time() * 1000),
            params={k: str(v) for k, v in config.items()}, metrics=metrics, tags={RUN_NAME_TAG: FINAL_RUN_NAME},
        )],
    )
    return FinalFit(model, metrics, run)


def tune_and_fit(
    df: DataFrame, keys: list[str], label: str, n_trials: int = 30, test_size: float = 0.2, seed: int = 42,
    trials: DataFrame | None = None, exclude: tuple[str, ...] = (), k: int = N_FOLDS,
) -> tuple[SearchResult, FinalFit]:
    """Split, search on train, final fit; ``label`` is a 0/1 column."""
    parted = stratified_split(df, keys, label, test_size, seed)
    train, test = (parted.where(F.col("split") == s).drop("split") for s in ("train", "test"))
    trials = search_space(df.sparkSession, n_trials, seed) if trials is None else trials
    found = run_search(train, keys, label, trials, k, exclude)
    return found, fit_final(train, test, label, found.best_config, exclude, keys=keys)
