"""Target handling: merging, binarising, encoding and class weights."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .columns import field
from .ordering import distinct_rank, join_small

# The three target values of the encounter table and their merge.
READMISSION_MERGE = {">30": "YES", "<30": "YES", "NO": "NO"}
POSITIVE = "YES"
COLOUR_CODES = {"NO": 0, "YES": 1}


def merge_labels(df: DataFrame, column: str, mapping: dict[str, str] | None = None) -> DataFrame:
    """Replaces mapped labels; every other value passes through."""
    return df.replace(mapping or READMISSION_MERGE, subset=[column])


def binarised(label: Column, positive: str = POSITIVE) -> Column:
    """1 for the positive class, 0 for anything else, missing included."""
    return F.coalesce(label == positive, F.lit(False)).cast("int")


def threshold_prediction(score: Column, threshold: float = 0.5) -> Column:
    return (score >= threshold).cast("int")


def mapped_code(label: Column, codes: dict[str, int] | None = None) -> Column:
    """Dictionary lookup; labels without an entry give NULL."""
    pairs = [F.lit(v) for item in (codes or COLOUR_CODES).items() for v in item]
    return F.try_element_at(F.create_map(*pairs), label)


def label_classes(df: DataFrame, column: str) -> DataFrame:
    """(column, class_id): distinct labels numbered in ascending order from 0."""
    labels = df.select(field(column).alias(column)).where(field(column).isNotNull()).distinct()
    return distinct_rank(labels, [], column, "class_id")


def encode_labels(df: DataFrame, column: str, classes: DataFrame | None = None) -> DataFrame:
    """Adds ``class_id``. A label unknown to ``classes`` gives NULL."""
    classes = label_classes(df, column) if classes is None else classes
    return join_small(df, classes, [column])


def decode_labels(df: DataFrame, classes: DataFrame, column: str) -> DataFrame:
    """Adds the label column back from ``class_id``."""
    return join_small(df, classes.select(column, "class_id"), ["class_id"])


def scale_pos_weight(df: DataFrame, label: str) -> DataFrame:
    """One row: negatives / max(positives, 1)."""
    pos, neg = F.count_if(field(label) == 1), F.count_if(field(label) == 0)
    return df.agg(
        neg.alias("n_neg"), pos.alias("n_pos"), (neg / F.greatest(pos, F.lit(1))).alias("scale_pos_weight")
    )


def balanced_weights(df: DataFrame, label: str) -> DataFrame:
    """(label, n, weight): n_total / (n_classes * n_class)."""
    counts = df.where(field(label).isNotNull()).groupBy(field(label).alias(label)).agg(F.count(F.lit(1)).alias("n"))
    whole = counts.agg(F.sum("n").alias("_all"), F.count(F.lit(1)).alias("_k"))
    return counts.crossJoin(F.broadcast(whole)).select(
        label, "n", (F.col("_all") / (F.col("_k") * F.col("n"))).alias("weight")
    )


def with_balanced_weight(df: DataFrame, label: str, weight_col: str = "weight") -> DataFrame:
    weights = balanced_weights(df, label).select(label, F.col("weight").alias(weight_col))
    return join_small(df, weights, [label])


def with_positive_weight(df: DataFrame, label: str, weight_col: str = "weight") -> DataFrame:
    """Positives weigh negatives / max(positives, 1), negatives 1."""
    one = scale_pos_weight(df, label).select("scale_pos_weight")
    weight = F.when(field(label) == 1, F.col("scale_pos_weight")).otherwise(1.0)
    return df.crossJoin(F.broadcast(one)).withColumn(weight_col, weight).drop("scale_pos_weight")
