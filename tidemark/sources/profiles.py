"""Stored baseline profiles: what a drift check needs of its baseline, taken once and kept under a version.

A profile holds the counts of every value of every column, which is all that PSI, KS and category shares read, and the
baseline's schema. A check merges it with the counts of the current table; the baseline itself is not scanned again.
A version is complete when its ``meta`` file exists, which is written last.
"""

from __future__ import annotations

import json
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.columns import ComparedColumn, column_table, numeric_columns
from ..operators.tagging import category_counts_by_side, numeric_value_counts

_NUMERIC = "column string, value double, n bigint"
_CATEGORICAL = "column string, value string, n bigint"
_META = "version bigint, schema string"


@dataclass(frozen=True)
class BaselineProfile:
    """``frame`` has the baseline's columns and no rows; ``numeric`` and ``categorical`` are (column, value, n)."""

    frame: DataFrame
    numeric: DataFrame
    categorical: DataFrame
    version: int

    @property
    def columns(self) -> list[str]:
        return self.frame.columns

    def value_counts(self, cur: DataFrame, columns: list[ComparedColumn]) -> DataFrame:
        """As ``numeric_value_counts`` of the baseline and ``cur``, with the baseline's part read from the profile."""
        return self._merged(self.numeric, numeric_value_counts(self.frame, cur, columns), columns)

    def category_counts(self, cur: DataFrame, columns: list[ComparedColumn]) -> DataFrame:
        return self._merged(self.categorical, category_counts_by_side(self.frame, cur, columns), columns)

    def _merged(self, stored: DataFrame, counts: DataFrame, columns: list[ComparedColumn]) -> DataFrame:
        names = column_table(stored.sparkSession, columns).select("pos", "column")
        own = stored.join(F.broadcast(names), "column").select(
            "pos", "value", F.col("n").alias("n_ref"), F.lit(0).cast("bigint").alias("n_cur"))
        return own.unionByName(counts).groupBy("pos", "value").agg(F.sum("n_ref").alias("n_ref"), F.sum("n_cur").alias("n_cur"))


def _counts(ref: DataFrame, columns: list[str], numeric: bool) -> DataFrame:
    specs = [ComparedColumn(c, "", i) for i, c in enumerate(columns)]
    count = numeric_value_counts if numeric else category_counts_by_side
    named = column_table(ref.sparkSession, specs).select("pos", "column")
    counts = count(ref, ref.limit(0), specs)
    return counts.join(F.broadcast(named), "pos").select("column", "value", F.col("n_ref").alias("n"))


def write_profile(ref: DataFrame, path: str, ignore: Iterable[str] = ()) -> BaselineProfile:
    """Takes the profile of ``ref`` and stores it as the next version under ``path``."""
    spark = ref.sparkSession
    kept = ref.drop(*ignore)
    numeric = numeric_columns(kept)
    version = 1 + max((v for v, _ in _versions(spark, path)), default=0)
    at = f"{path}/version={version}"
    _counts(kept, numeric, True).write.mode("overwrite").parquet(f"{at}/numeric")
    _counts(kept, [c for c in kept.columns if c not in numeric], False).write.mode("overwrite").parquet(f"{at}/categorical")
    spark.createDataFrame([(version, kept.schema.json())], _META).coalesce(1).write.mode("overwrite").json(f"{at}/meta")
    return read_profile(spark, path, version)


def _versions(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    """Complete versions with their schemas, one row each."""
    try:
        rows = spark.read.schema(_META).json(f"{path}/version=*/meta").collect()
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    return sorted((r["version"], r["schema"]) for r in rows)


def read_profile(spark: SparkSession, path: str, version: int | None = None) -> BaselineProfile:
    """The newest complete version, or the one asked for."""
    known = dict(_versions(spark, path))
    if not known or (version is not None and version not in known):
        raise FileNotFoundError(f"no complete profile {'' if version is None else version} under {path}")
    version = max(known) if version is None else version
    at, schema = f"{path}/version={version}", T.StructType.fromJson(json.loads(known[version]))
    return BaselineProfile(spark.createDataFrame([], schema), spark.read.schema(_NUMERIC).parquet(f"{at}/numeric"),
                           spark.read.schema(_CATEGORICAL).parquet(f"{at}/categorical"), version)
