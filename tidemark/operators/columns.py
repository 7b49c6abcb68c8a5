"""Column selection decided from schemas; no data is read here."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Names under which the target may still be present.
TARGET_COLUMNS = ("readmitted", "readmit_binary")


@dataclass(frozen=True)
class ComparedColumn:
    name: str
    kind: str  # "numeric", "categorical" or "prediction"
    position: int


def quoted(name: str) -> str:
    """Backquoted name; column names may hold hyphens or dots."""
    return "`" + name.replace("`", "``") + "`"


def field(name: str) -> Column:
    return F.col(quoted(name))


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def categorical_columns(df: DataFrame) -> list[str]:
    """Strings and booleans. Booleans count as categories everywhere."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, (T.StringType, T.BooleanType))]


def drop_targets(df: DataFrame, targets: Iterable[str] = TARGET_COLUMNS) -> DataFrame:
    return df.drop(*targets)


def compared_columns(
    ref: DataFrame, cur: DataFrame, ignore: Iterable[str] = (), pred_col: str | None = None
) -> list[ComparedColumn]:
    """Columns in both frames, typed by the baseline, numeric ones first.

    The prediction column is not a feature: it is appended last under its own
    kind, and only when both sides carry it.
    """
    skip = set(ignore) | ({pred_col} if pred_col else set())
    common = [c for c in ref.columns if c in set(cur.columns) and c not in skip]
    numeric = set(numeric_columns(ref))
    ordered = [(c, "numeric") for c in common if c in numeric]
    ordered += [(c, "categorical") for c in common if c not in numeric]
    if pred_col and pred_col in ref.columns and pred_col in cur.columns:
        ordered.append((pred_col, "prediction"))
    return [ComparedColumn(name, kind, i) for i, (name, kind) in enumerate(ordered)]


def column_table(spark: SparkSession, columns: list[ComparedColumn]) -> DataFrame:
    """One row per compared column; at most as many rows as the table has columns."""
    return spark.createDataFrame(
        [(c.position, c.name, c.kind) for c in columns], "pos int, column string, kind string"
    )


def schema_table(df: DataFrame) -> DataFrame:
    """(position, column, type) of a frame's schema."""
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, "position int, column string, type string")


def schema_difference(ref: DataFrame, cur: DataFrame) -> DataFrame:
    """Columns of the baseline that the current table lacks."""
    left, right = schema_table(ref).select("column"), schema_table(cur).select("column")
    return left.exceptAll(right)


def typed_partition(df: DataFrame) -> DataFrame:
    """(column, kind) for every numeric or categorical column."""
    numeric, categorical = numeric_columns(df), categorical_columns(df)
    rows = [(c, "numeric") for c in numeric] + [(c, "categorical") for c in categorical]
    return df.sparkSession.createDataFrame(rows, "column string, kind string")
