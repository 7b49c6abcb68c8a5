"""Stratified splits and folds, injected drift and synthetic predictions.

Rows of a class are ordered by a hash of their key. A split point is an order
statistic of that hash, so once the points are known a row's part is a
comparison with at most a few strings: the data itself is never shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.draws import beta_2_5, order_key
from ..functions.stats import count_not_above
from .columns import field
from .ordering import join_small, materialised

# The first 4 hex digits of the hash: 65,536 even buckets per class.
_BUCKET_DIGITS = 4


def class_counts(df: DataFrame, label: str) -> DataFrame:
    """(label, n), held as a small local table when its size allows."""
    counts = df.where(field(label).isNotNull()).groupBy(field(label).alias("_label")).agg(F.count(F.lit(1)).alias("_n"))
    return materialised(counts)


def split_quotas(counts: DataFrame, test_size: float) -> DataFrame:
    """(_label, _cuts): how many rows of each class go to train.

    Train gets n - ceil(test_size * n) rows. Each class gets the floor of its
    proportional share; rows left over go to the largest fractional parts, ties
    in label order. One row per class, so the unpartitioned windows are small.
    """
    everything = Window.partitionBy()
    total = F.sum("_n").over(everything)
    share = counts.withColumn("_train", total - F.ceil(total * F.lit(test_size))).withColumn(
        "_exact", F.col("_n") * F.col("_train") / F.sum("_n").over(everything)
    )
    floored = share.withColumn("_floor", F.floor("_exact"))
    spare = F.col("_train") - F.sum("_floor").over(everything)
    by_rest = Window.orderBy((F.col("_exact") - F.col("_floor")).desc(), "_label")
    return floored.withColumn("_spare", spare).withColumn("_turn", F.row_number().over(by_rest)).select(
        "_label", F.array((F.col("_floor") + F.when(F.col("_turn") <= F.col("_spare"), 1).otherwise(0)).cast("bigint")).alias("_cuts")
    )


def fold_quotas(counts: DataFrame, k: int) -> DataFrame:
    """(_label, _cuts): cumulative fold sizes of each class.

    Classes are laid end to end in label order and position p belongs to fold
    p mod k, which keeps fold sizes within one row of each other.
    """
    start = F.coalesce(
        F.sum("_n").over(Window.orderBy("_label").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    placed = counts.withColumn("_start", start)
    upto = lambda x, i: F.floor((x + F.lit(k - 1 - i)) / k)
    sizes = [upto(F.col("_start") + F.col("_n"), i) - upto(F.col("_start"), i) for i in range(k)]
    cuts, running = [], F.lit(0)
    for size in sizes[:-1]:
        running = running + size
        cuts.append(running.cast("bigint"))
    return placed.select("_label", F.array(*cuts).alias("_cuts"))


def hash_thresholds(df: DataFrame, keys: list[str], label: str, seed: int, quotas: DataFrame) -> DataFrame:
    """(_label, _points): the hash at which each cut of each class falls.

    Pass one counts rows per (class, hash bucket). Pass two ranks only the rows
    of the buckets that hold a cut, about 1/65,536 of a class for each.
    """
    hashed = df.where(field(label).isNotNull()).select(
        field(label).alias("_label"), order_key([field(c) for c in keys], seed).alias("_h")
    ).withColumn("_bucket", F.substring("_h", 1, _BUCKET_DIGITS))
    counts = hashed.groupBy("_label", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    upto = F.sum("_n").over(Window.partitionBy("_label").orderBy("_bucket"))
    placed = join_small(counts.withColumn("_end", upto), quotas, ["_label"], "inner")
    start = F.col("_end") - F.col("_n")
    inner = F.transform(
        F.filter("_cuts", lambda c: (c >= start) & (c < F.col("_end"))), lambda c: c - start + 1
    )
    wanted = placed.select("_label", "_bucket", inner.alias("_ranks")).where(F.size("_ranks") > 0)
    rows = join_small(hashed, wanted, ["_label", "_bucket"], "inner")
    ranked = rows.withColumn("_rank", F.row_number().over(Window.partitionBy("_label", "_bucket").orderBy("_h")))
    points = ranked.where(F.array_contains("_ranks", F.col("_rank").cast("bigint"))).select(
        # A cut reached by two folds (an empty fold) counts twice.
        "_label", F.explode(F.filter("_ranks", lambda r: r == F.col("_rank"))).alias("_again"), "_h"
    )
    return points.groupBy("_label").agg(F.array_sort(F.collect_list("_h")).alias("_points"))


def _with_part(df: DataFrame, keys, label: str, seed: int, quotas: DataFrame, max_cuts: int) -> DataFrame:
    points = hash_thresholds(df, keys, label, seed, quotas).withColumnRenamed("_label", label)
    part = count_not_above(F.col("_points"), order_key([field(c) for c in keys], seed), max_cuts)
    joined = join_small(df, points, [label])
    return joined.withColumn("_part", F.coalesce(part, F.lit(0))).drop("_points").select(*df.columns, "_part")


def stratified_split(df: DataFrame, keys: list[str], label: str, test_size: float = 0.2, seed: int = 42) -> DataFrame:
    """Adds ``split`` ('train' or 'test') with class proportions kept exactly.

    ``keys`` must identify a row: rows with equal keys stay together.
    """
    quotas = split_quotas(class_counts(df, label), test_size)
    parted = _with_part(df, keys, label, seed, quotas, 1)
    return parted.withColumn("split", F.when(F.col("_part") == 0, "train").otherwise("test")).drop("_part")


def stratified_folds(df: DataFrame, keys: list[str], label: str, k: int = 5, seed: int = 42) -> DataFrame:
    """Adds ``fold`` in 0..k-1, each fold with the class mix of the whole."""
    quotas = fold_quotas(class_counts(df, label), k)
    return _with_part(df, keys, label, seed, quotas, k - 1).withColumnRenamed("_part", "fold")


def inject_drift(df: DataFrame, column: str, shift: float) -> DataFrame:
    """A copy of the table with a constant added to one column."""
    shifted = (field(column) + F.lit(shift)).cast(df.schema[column].dataType)
    return df.withColumn(column, shifted)


def mock_predictions(df: DataFrame, keys: list[str], seed: int = 42, pred_col: str = "pred_readmit") -> DataFrame:
    """Beta(2, 5) scores drawn from the row key and a seed."""
    return df.withColumn(pred_col, beta_2_5([field(c) for c in keys], seed))
