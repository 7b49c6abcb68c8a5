"""Experiment runs, trial results and model pointers as tables."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import stripped

# Names under which final models are stored.
EXPERIMENT = "xgb_diabetic_readmission_hpo"
FINAL_RUN_NAME = "best_model_full_train"
RUN_NAME_TAG = "mlflow.runName"

RUN_SCHEMA = (
    "experiment_id string, experiment string, run_id string, run_name string, status int, "
    "start_time bigint, end_time bigint, params map<string,string>, metrics map<string,double>, "
    "tags map<string,string>"
)
CONFIG_SCHEMA = T.StructType(
    [T.StructField(c, T.IntegerType()) for c in ("n_estimators", "max_depth")]
    + [
        T.StructField(c, T.DoubleType())
        for c in ("learning_rate", "subsample", "colsample_bytree", "min_child_weight", "reg_alpha", "reg_lambda")
    ]
)
TRIAL_SCHEMA = (
    "trial_id string, val_auc double, val_ap double, val_acc double, val_f1 double, "
    "timestamp bigint, done boolean, training_iteration int, time_total_s double, "
    f"config {CONFIG_SCHEMA.simpleString()}"
)
# The configuration keys handed on to an exported model.
EXPORTED_KEYS = (
    "max_depth", "learning_rate", "n_estimators", "subsample", "colsample_bytree", "reg_alpha", "reg_lambda",
)


def _yaml_value(text: Column, key: str) -> Column:
    return F.regexp_extract(text, rf"(?m)^{key}:[ ]*'?([^'\r\n]*)'?[ ]*$", 1)


def _small_files(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Whole files of several folders or globs; none where nothing matches."""
    try:
        return spark.read.text(paths, wholetext=True).select("value", F.col("_metadata.file_path").alias("path"))
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "value string, path string")


def _key_values(spark: SparkSession, runs: list[str], kind: str) -> DataFrame:
    """(run_id, key, value) of one kind of small file: <exp>/<run>/<kind>/<key>."""
    files = _small_files(spark, [f"{run}/{kind}/*" for run in runs])
    path = F.col("path")
    return files.select(
        F.regexp_extract(path, rf"/([^/]+)/{kind}/[^/]+$", 1).alias("run_id"),
        F.regexp_extract(path, rf"/{kind}/([^/]+)$", 1).alias("key"),
        stripped(F.col("value")).alias("value"),
    )


def _as_map(pairs: DataFrame, name: str) -> DataFrame:
    """One map per run. A run has one file per key, a few dozen at most."""
    return pairs.groupBy("run_id").agg(F.map_from_entries(F.collect_list(F.struct("key", "value"))).alias(name))


def read_run_store(spark: SparkSession, root: str, experiment: str | None = None, name: str | None = None,
                   max_folders: int = 10_000) -> DataFrame:
    """Runs of a file-tree store, one row each.

    A metric file holds ``timestamp value step`` lines and may repeat them; the
    last line counts. Runs are kept whatever their status says.

    With ``experiment`` only that experiment's folders are listed; with ``name``
    too, its runs' name tags are read first and then the files of the matching
    runs alone, up to ``max_folders`` of them named one by one (beyond, the
    experiment's folders are listed as a whole and the rows filtered).
    """
    text = F.col("value")
    experiments = _small_files(spark, [f"{root}/*/meta.yaml"]).select(
        _yaml_value(text, "experiment_id").alias("experiment_id"), _yaml_value(text, "name").alias("experiment"),
        F.regexp_replace("path", "/meta\\.yaml$", "").alias("folder"))
    folders = [f"{root}/*"]
    if experiment is not None:
        experiments = experiments.where(F.col("experiment") == experiment)
        folders = [r["folder"] for r in experiments.collect()]  # one row per experiment of that name
    runs_at = [f"{folder}/*" for folder in folders]
    if name is not None:
        tagged = _small_files(spark, [f"{run}/tags/{RUN_NAME_TAG}" for run in runs_at])
        named = tagged.where(stripped(text) == name).select(F.regexp_replace("path", "/tags/[^/]+$", "").alias("run"))
        found = [r["run"] for r in named.limit(max_folders + 1).collect()]
        runs_at = found if len(found) <= max_folders else runs_at
    metas = _small_files(spark, [f"{run}/meta.yaml" for run in runs_at]) if runs_at else spark.createDataFrame(
        [], "value string, path string")
    runs = metas.select(
        _yaml_value(text, "experiment_id").alias("experiment_id"),
        _yaml_value(text, "run_id").alias("run_id"),
        _yaml_value(text, "run_name").alias("run_name"),
        _yaml_value(text, "status").try_cast("int").alias("status"),
        _yaml_value(text, "start_time").try_cast("bigint").alias("start_time"),
        _yaml_value(text, "end_time").try_cast("bigint").alias("end_time"),
    ).where(F.col("run_id") != "")
    last_line = F.element_at(F.split(F.col("value"), r"\r?\n"), -1)
    metrics = _key_values(spark, runs_at, "metrics").withColumn(
        "value", F.try_element_at(F.split(last_line, " "), F.lit(2)).try_cast("double")
    )
    parts = [
        _as_map(_key_values(spark, runs_at, "params"), "params"),
        _as_map(metrics, "metrics"),
        _as_map(_key_values(spark, runs_at, "tags"), "tags"),
    ]
    start = runs.join(experiments.drop("folder"), "experiment_id", "left")
    joined = reduce(lambda left, right: left.join(right, "run_id", "left"), parts, start)
    out = joined.select(*[f.split(" ")[0] for f in RUN_SCHEMA.split(", ")])
    return out if name is None else out.where(F.try_element_at("tags", F.lit(RUN_NAME_TAG)) == name)


def runs_frame(spark: SparkSession, rows: list[dict]) -> DataFrame:
    names = [f.name for f in T._parse_datatype_string(RUN_SCHEMA).fields]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], RUN_SCHEMA)


def append_runs(runs: DataFrame, path: str) -> None:
    runs.write.mode("append").parquet(path)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUN_SCHEMA).parquet(path)


def runs_named(runs: DataFrame, experiment: str = EXPERIMENT, name: str = FINAL_RUN_NAME) -> DataFrame:
    return runs.where((F.col("experiment") == experiment) & (F.try_element_at("tags", F.lit(RUN_NAME_TAG)) == name))


def latest_run(runs: DataFrame) -> DataFrame:
    """Newest by start time; recency, not metric, decides."""
    return runs.orderBy(F.desc("start_time"), "run_id").limit(1)


def first_runs(runs: DataFrame, k: int = 3) -> DataFrame:
    """A deterministic preview of matching runs."""
    return runs.orderBy("start_time", "run_id").limit(k)


def read_trial_results(spark: SparkSession, root: str) -> DataFrame:
    """One row per trial from ``*/result.json``; lines without metrics are kept."""
    return (
        spark.read.schema(TRIAL_SCHEMA).option("recursiveFileLookup", True)
        .option("pathGlobFilter", "result.json").json(root)
    )


def read_trial_progress(spark: SparkSession, root: str) -> DataFrame:
    """The CSV form, ``*/progress.csv``: one row per reported line.

    Each small file is read whole and matched by its own header, since files
    of different trials need not order their columns alike.
    """
    files = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "progress.csv").text(
        root, wholetext=True
    )
    cells = lambda line: F.split(line, r',(?=(?:[^"]*"[^"]*")*[^"]*$)')
    lines = files.select(F.split(stripped(F.col("value")), r"\r?\n").alias("lines"))
    rows = lines.select(
        cells(F.get("lines", F.lit(0))).alias("header"),
        F.explode(F.slice("lines", F.lit(2), F.greatest(F.size("lines") - 1, F.lit(0)))).alias("line"),
    ).select(F.map_from_arrays("header", cells(F.col("line"))).alias("m"))
    get = lambda k: F.try_element_at("m", F.lit(k))
    return rows.select(
        get("trial_id").alias("trial_id"),
        *[get(c).try_cast("double").alias(c) for c in ("val_auc", "val_ap", "val_acc", "val_f1", "time_total_s")],
    )


def write_config(config: DataFrame, path: str) -> None:
    """The chosen configuration: one JSON object."""
    config.coalesce(1).write.mode("overwrite").json(path)


def read_config(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(CONFIG_SCHEMA).option("multiLine", True).json(path)


def exported_params(params: Column) -> Column:
    """The sub-map of parameters that go with an exported model."""
    return F.map_filter(params, lambda k, _: k.isin(*EXPORTED_KEYS))


MODEL_SCHEMA = "model string, run_id string, path string, promoted_at timestamp"


def promote(runs: DataFrame, artifacts: DataFrame, model: str, experiment: str = EXPERIMENT, name: str = FINAL_RUN_NAME) -> DataFrame:
    """Pointer row (model, run_id, path, promoted_at) for the newest final run.

    ``artifacts`` is (run_id, path). Empty when no run matches or it has no model.
    """
    newest = latest_run(runs_named(runs, experiment, name)).select("run_id")
    return artifacts.join(F.broadcast(newest), "run_id").select(
        F.lit(model).alias("model"), "run_id", "path", F.current_timestamp().alias("promoted_at")
    )


def current_model(pointers: DataFrame, model: str) -> DataFrame:
    """The latest pointer of a model: the one of the highest version, where versions are kept."""
    newest = [F.desc("version")] if "version" in pointers.columns else []
    return pointers.where(F.col("model") == model).orderBy(*newest, F.desc("promoted_at"), "run_id").limit(1)
