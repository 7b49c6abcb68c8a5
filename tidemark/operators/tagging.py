"""Two samples as one relation, and its long form.

Every two-sample metric reads the long value table made here: one row per
distinct (column, value) with a count for each side. It is built by a single
aggregation with map-side combine, so a value that fills a third of a column
reaches the shuffle once per map task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .columns import ComparedColumn, field

REF, CUR = "ref", "cur"


def tag_union(ref: DataFrame, cur: DataFrame) -> DataFrame:
    """Baseline and current rows under one schema with a ``side`` column."""
    return ref.withColumn("side", F.lit(REF)).unionByName(
        cur.withColumn("side", F.lit(CUR)), allowMissingColumns=True
    )


def lenient_double(df: DataFrame, name: str) -> Column:
    """Double value; text that is no number, and NaN, become NULL."""
    kind = df.schema[name].dataType
    col = field(name)
    if isinstance(kind, T.NumericType):
        value = col.cast("double")
    else:
        value = col.cast("string").try_cast("double")
    return F.when(~F.isnan(value), value)


def _side_counts(
    ref: DataFrame, cur: DataFrame, columns: list[ComparedColumn], value_of, value_type: str
) -> DataFrame:
    spark = ref.sparkSession
    if not columns:
        return spark.createDataFrame([], f"pos int, value {value_type}, n_ref bigint, n_cur bigint")
    names = [str(c.position) for c in columns]

    def project(df: DataFrame, is_ref: bool) -> DataFrame:
        return df.select(
            F.lit(is_ref).alias("is_ref"), *[value_of(df, c.name).alias(n) for c, n in zip(columns, names)]
        )

    wide = project(ref, True).unionAll(project(cur, False))
    long = wide.unpivot(["is_ref"], names, "pos", "value").where(F.col("value").isNotNull())
    counts = long.groupBy("pos", "value").agg(
        F.count_if(F.col("is_ref")).alias("n_ref"), F.count_if(~F.col("is_ref")).alias("n_cur")
    )
    return counts.select(F.col("pos").cast("int").alias("pos"), "value", "n_ref", "n_cur")


def numeric_value_counts(ref: DataFrame, cur: DataFrame, columns: list[ComparedColumn]) -> DataFrame:
    """(pos, value double, n_ref, n_cur) for numeric columns; NULL and NaN left out."""
    return _side_counts(ref, cur, columns, lenient_double, "double")


def category_counts_by_side(ref: DataFrame, cur: DataFrame, columns: list[ComparedColumn]) -> DataFrame:
    """(pos, value string, n_ref, n_cur) for categorical columns; NULL left out."""
    return _side_counts(ref, cur, columns, lambda df, name: field(name).cast("string"), "string")
