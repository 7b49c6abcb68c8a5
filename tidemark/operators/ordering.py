"""Running totals and ranks over a global order without a global sort task.

A window ordered over one whole group is a single task. When the data is large,
the order column is cut into buckets of about equal size, totals per bucket
give each bucket its starting offset, and the window runs inside (group,
bucket) only. The number of buckets follows from a measured row count.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..functions.stats import count_not_above
from ..session import checkpointed

ROWS_PER_BUCKET = 1_000_000
# Sketches that one task merges, and how often merged ones are merged again.
SKETCH_FAN = 64
SKETCH_LEVELS = 3
# Entries of one cut array. More buckets than that come from cutting each one again.
MAX_CUTS = 4096
SMALL_TABLE_ROWS = 50_000


@contextmanager
def held(df: DataFrame) -> Iterator[DataFrame]:
    """Keeps ``df`` cached for the jobs inside the block.

    Lost cache blocks are recomputed from the lineage, so an executor may die.
    """
    cached = df.persist()
    try:
        yield cached
    finally:
        cached.unpersist()


def materialised(df: DataFrame, max_rows: int = SMALL_TABLE_ROWS) -> DataFrame:
    """Runs ``df`` now and returns its rows as a new, lineage-free DataFrame.

    Meant for metric tables. At most ``max_rows + 1`` rows reach the driver; a
    larger result is checkpointed on the shared folder instead.
    """
    head = df.limit(max_rows + 1).toArrow()
    if head.num_rows <= max_rows:
        return df.sparkSession.createDataFrame(head, df.schema)
    return checkpointed(df)


def join_small(
    left: DataFrame, small: DataFrame, on: list[str], how: str = "left", max_rows: int = SMALL_TABLE_ROWS
) -> DataFrame:
    """Joins a side that is small in practice, with its size checked first.

    Within ``max_rows`` it is broadcast; beyond, the join is left to Spark
    (sort-merge with AQE skew splitting).
    """
    head = small.limit(max_rows + 1).toArrow()
    if head.num_rows <= max_rows:
        return left.join(F.broadcast(left.sparkSession.createDataFrame(head, small.schema)), on, how)
    return left.join(small, on, how)


def bucket_cuts(values: DataFrame, order_col: str, total: int, n_buckets: int | None = None) -> list:
    """Ascending cut points that split ``total`` distinct values into even buckets.

    Numbers use quantile sketches, one per map task, merged as a tree of
    ``SKETCH_FAN`` branches: whatever the number of tasks, none receives the
    sketches of all. Other types use a hash sample whose expected
    size is the bucket count. Both stay within a few times ``MAX_CUTS``
    entries whatever the data; no cuts means one bucket is enough.
    """
    if n_buckets is None:
        n_buckets = min(MAX_CUTS, math.ceil(total / ROWS_PER_BUCKET))
    if n_buckets <= 1:
        return []
    if isinstance(values.schema[order_col].dataType, T.NumericType):
        fractions = [i / n_buckets for i in range(1, n_buckets)]
        return _sketched_quantiles(values, order_col, fractions)
    threshold = math.ceil((1 << 40) * min(1.0, n_buckets / max(total, 1)))
    sampled = values.where(F.pmod(F.xxhash64(order_col), F.lit(1 << 40)) < threshold)
    row = sampled.agg(F.array_sort(F.collect_set(order_col)).alias("cuts")).first()
    return list(row["cuts"])


def _sketched_quantiles(values: DataFrame, order_col: str, fractions: list[float]) -> list:
    """Approximate quantiles: rank error well below the distance of two fractions."""
    size = max(200, min(65_535, 8 * len(fractions)))
    merged = values.select(F.col(order_col).cast("double").alias("_v"), F.spark_partition_id().alias("_task")).groupBy(
        F.floor(F.col("_task") / SKETCH_FAN).alias("_task")).agg(F.kll_sketch_agg_double("_v", F.lit(size)).alias("_s"))
    for _ in range(SKETCH_LEVELS - 2):
        merged = merged.groupBy(F.floor(F.col("_task") / SKETCH_FAN).alias("_task")).agg(F.kll_merge_agg_double("_s").alias("_s"))
    whole = merged.agg(F.kll_merge_agg_double("_s").alias("_s")).where(F.kll_sketch_get_n_double("_s") > 0)
    row = whole.select(F.kll_sketch_get_quantile_double("_s", F.array(*[F.lit(f) for f in fractions])).alias("cuts")).first()
    return sorted(set(row["cuts"])) if row else []


def with_bucket(values: DataFrame, order_col: str, cuts: list) -> DataFrame:
    """Adds ``_bucket``; equal values share a bucket and buckets follow the order."""
    if not cuts:
        return values.withColumn("_bucket", F.lit(0))
    edges = F.lit(cuts)
    return values.withColumn("_bucket", F.coalesce(count_not_above(edges, F.col(order_col), len(cuts)), F.lit(0)))


def finer_buckets(bucketed: DataFrame, order_col: str, parts: int) -> DataFrame:
    """Cuts every bucket into about ``parts`` again, each by its own cuts; ``_bucket`` keeps the order.

    The cuts of a bucket come from its own rows, by one aggregation over all
    buckets, and are joined on the bucket.
    """
    if isinstance(bucketed.schema[order_col].dataType, T.NumericType):
        fractions = F.array(*[F.lit(i / parts) for i in range(1, parts)])
        cuts = F.array_sort(F.array_distinct(F.percentile_approx(order_col, fractions, 10 * parts)))
    else:
        share = math.ceil((1 << 40) * min(1.0, parts / ROWS_PER_BUCKET))
        chosen = F.when(F.pmod(F.xxhash64(order_col, F.lit(1)), F.lit(1 << 40)) < share, F.col(order_col))
        cuts = F.slice(F.array_sort(F.collect_set(chosen)), 1, 4 * parts)
    fine = bucketed.groupBy("_bucket").agg(cuts.alias("_cuts"))
    inner = F.coalesce(count_not_above(F.col("_cuts"), F.col(order_col), 4 * parts), F.lit(0))
    joined = join_small(bucketed, fine, ["_bucket"], "inner")
    return joined.withColumn("_bucket", F.col("_bucket").cast("long") * (4 * parts + 1) + inner).drop("_cuts")


def group_totals(values: DataFrame, groups: list[str], sums: list[str]) -> tuple[DataFrame, int]:
    """(groups, tot_<c>) held as a small table if it is one, and the row count."""
    totals = materialised(
        values.groupBy(*groups).agg(
            F.count(F.lit(1)).alias("_rows"), *[F.sum(c).alias(f"tot_{c}") for c in sums]
        )
    )
    total = totals.agg(F.sum("_rows")).first()[0] or 0
    return totals.drop("_rows"), total


def running_totals(
    values: DataFrame, groups: list[str], order_col: str, sums: list[str], n_buckets: int | None = None,
    rows_per_bucket: int = ROWS_PER_BUCKET, max_cuts: int = MAX_CUTS,
) -> DataFrame:
    """Adds ``cum_<c>`` (inclusive, ascending) and ``tot_<c>`` for each summed column.

    ``values`` holds one row per (groups, order_col); hold it if it is costly,
    since its totals are taken before the plan is chosen.

    With buckets, the rows are shuffled once, by (groups, bucket). The offsets,
    one row per group and bucket, are broadcast when few; a larger offset table
    is joined on the layout the window already has.
    """
    totals, total = group_totals(values, groups, sums)
    wanted = math.ceil(total / rows_per_bucket)
    cuts = bucket_cuts(values, order_col, total, min(max_cuts, wanted) if n_buckets is None else n_buckets)
    parts = min(max_cuts, math.ceil(wanted / max_cuts)) if n_buckets is None else 1
    run = _bucket_windows(values, groups, order_col, sums, cuts, parts) if cuts else _one_window(values, groups, order_col, sums)
    if not groups:
        return run.crossJoin(F.broadcast(totals))  # one row
    return join_small(run, totals, groups, "inner")


def _bucket_windows(values: DataFrame, groups: list[str], order_col: str, sums: list[str], cuts: list, parts: int = 1) -> DataFrame:
    bucketed = with_bucket(values, order_col, cuts)
    if parts > 1:
        bucketed = finer_buckets(bucketed, order_col, parts)
    keys = [*groups, "_bucket"]
    per_bucket = bucketed.groupBy(*keys).agg(*[F.sum(c).alias(f"_sum_{c}") for c in sums])
    before = Window.partitionBy(*groups).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    # Run first, as a table of its own: in a self-join Spark rewrites one side,
    # and the rewritten copy no longer finds the held values.
    offsets = per_bucket.select(
        *keys,
        *[F.coalesce(F.sum(f"_sum_{c}").over(before), F.lit(0)).alias(f"_off_{c}") for c in sums],
    )
    inside = Window.partitionBy(*keys).orderBy(order_col).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    windowed = bucketed.select("*", *[F.sum(c).over(inside).alias(f"_in_{c}") for c in sums])
    joined = join_small(windowed, materialised(offsets), keys, "inner")
    return joined.select(
        *values.columns, *[(F.col(f"_off_{c}") + F.col(f"_in_{c}")).alias(f"cum_{c}") for c in sums]
    )


def _one_window(values: DataFrame, groups: list[str], order_col: str, sums: list[str]) -> DataFrame:
    """The plain form, for at most ``ROWS_PER_BUCKET`` rows in all."""
    upto = Window.partitionBy(*groups).orderBy(order_col).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return values.select("*", *[F.sum(c).over(upto).alias(f"cum_{c}") for c in sums])


def distinct_rank(values: DataFrame, groups: list[str], order_col: str, name: str = "rank") -> DataFrame:
    """0-based rank of distinct values inside each group.

    Run now: a small result becomes a local table, a large one is checkpointed.
    """
    with held(values.withColumn("_one", F.lit(1).cast("bigint"))) as ones:
        ranked = running_totals(ones, groups, order_col, ["_one"])
        return materialised(ranked.select(*values.columns, (F.col("cum__one") - 1).cast("bigint").alias(name)))
