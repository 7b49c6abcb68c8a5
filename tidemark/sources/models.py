"""Saving, loading and exporting fitted models: tree models with their bins, or Spark ML pipelines."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.ensembles import TreeModel
from .runs import MODEL_SCHEMA, current_model

# Folder of a tree model inside the model's path.
TREES = "trees"


def save_model(spark: SparkSession, model: TreeModel | PipelineModel, path: str) -> None:
    """The whole model, preprocessing included."""
    if isinstance(model, TreeModel):
        model.save(spark, f"{path}/{TREES}")
    else:
        model.write().overwrite().save(path)


def load_model(spark: SparkSession, path: str) -> TreeModel | PipelineModel:
    try:
        return TreeModel.load(spark, f"{path}/{TREES}")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return PipelineModel.load(path)


def export_model(spark: SparkSession, source: str, target: str) -> TreeModel | PipelineModel:
    """Copies a run's model to an export location through load and save."""
    model = load_model(spark, source)
    save_model(spark, model, target)
    return model


def _moved_if_new(spark: SparkSession, source: str, target: str) -> bool:
    """Renames a folder unless the target exists; of several callers one succeeds."""
    jvm = spark._jvm
    old, new = jvm.org.apache.hadoop.fs.Path(source), jvm.org.apache.hadoop.fs.Path(target)
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(new.toUri(), spark._jsc.hadoopConfiguration())
    flags = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        files.rename(old, new, flags)
        return True
    except Py4JJavaError as error:
        if "FileAlreadyExists" not in error.java_exception.getClass().getName():
            raise
        files.delete(old, True)
        return False


def read_pointers(spark: SparkSession, path: str) -> DataFrame:
    """All promotions, one row per version; none before the first."""
    try:
        return spark.read.schema(f"{MODEL_SCHEMA}, version bigint").option("basePath", path).parquet(f"{path}/version=*")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], f"{MODEL_SCHEMA}, version bigint")


def swap_pointer(spark: SparkSession, pointer: DataFrame, path: str, expected: int | None = None) -> int | None:
    """Stores the pointer row as the version after ``expected`` (by default the newest): compare and swap.

    The row is written aside and its folder renamed to the version's name, which fails if another job got there first.
    Returns the new version, or None if the promotion lost; the caller may look at the winner and try again."""
    if expected is None:
        expected = read_pointers(spark, path).agg(F.max("version")).first()[0] or 0
    staged = f"{path}/_staged-{uuid.uuid4().hex}"
    pointer.coalesce(1).write.parquet(staged)
    return expected + 1 if _moved_if_new(spark, staged, f"{path}/version={expected + 1}") else None


def load_promoted(spark: SparkSession, pointers_path: str, model: str) -> TreeModel | PipelineModel | None:
    row = current_model(read_pointers(spark, pointers_path), model).first()
    return None if row is None else load_model(spark, row["path"])
