"""Synthetic minority oversampling."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.draws import order_key, uniform
from ..session import checkpointed
from .columns import field
from .neighbours import RECALL, ROWS_PER_BLOCK, nearest_in_class
from .ordering import join_small
from .sampling import class_counts, hash_thresholds

# Vectors with more copies than this take the path without a join.
HOT_COPIES = 10_000


def _copies_per_row(df: DataFrame, key: str, label: str, counts: list, seed: int) -> DataFrame:
    """Rows of classes below the largest, with how many children each gets.

    A class of n rows that lacks m gets m // n children per row and one more
    for the m % n rows first in hash order, so the total is exact.
    """
    spark = df.sparkSession
    top = max(r["_n"] for r in counts)
    lacking = [(r["_label"], (top - r["_n"]) // r["_n"], (top - r["_n"]) % r["_n"]) for r in counts if r["_n"] < top]
    kind = df.schema[label].dataType.simpleString()
    plan = spark.createDataFrame(lacking, f"`{label}` {kind}, _each bigint, _extra bigint")
    minority = df.join(F.broadcast(plan), label)
    quotas = plan.select(field(label).alias("_label"), F.array("_extra").alias("_cuts"))
    points = hash_thresholds(minority, [key], label, seed, quotas).withColumnRenamed("_label", label)
    marked = join_small(minority, points, [label])
    early = order_key([field(key)], seed) < F.get("_points", F.lit(0))
    extra = F.when(F.col("_extra") == 0, 0).when(early, 1).otherwise(0)
    return marked.withColumn("_copies", F.col("_each") + extra).drop("_each", "_extra", "_points")


def oversample(
    df: DataFrame, key: str, label: str, features: str = "features", k: int = 5, seed: int = 42,
    rows_per_block: int = ROWS_PER_BLOCK, recall: float = RECALL,
) -> DataFrame:
    """(label, features, synthetic): every class raised to the largest one's size.

    A child lies at a random point between its base row and one of the base's
    ``k`` nearest rows of the same class. Equal vectors are searched once; a
    vector's own copies are its nearest neighbours at distance 0. ``recall`` is
    the share of true neighbours the search must find; 1.0 finds them all.
    """
    counts = class_counts(df, label).collect()  # one row per class
    original = df.select(field(label).alias(label), field(features).alias(features), F.lit(False).alias("synthetic"))
    top = max((r["_n"] for r in counts), default=0)
    short = [r for r in counts if r["_n"] < top]
    if not short:
        return original
    if any(r["_n"] <= k for r in short):
        raise ValueError(f"a class has {k} rows or fewer: too small for {k} neighbours")

    rows = _copies_per_row(df.select(key, label, features), key, label, counts, seed).select(
        field(label).alias("label"), field(key).alias("key"), vector_to_array(features).alias("vec"), "_copies"
    ).withColumn("id", F.md5(F.array_join(F.col("vec").cast("array<string>"), ",")))
    distinct = checkpointed(
        rows.groupBy("label", "id").agg(
            F.first("vec").alias("vec"), F.count(F.lit(1)).alias("mult"), F.sum("_copies").alias("_children")
        )
    )
    asking = (F.col("mult") <= k) & (F.col("_children") > 0)
    near = nearest_in_class(distinct.withColumn("is_query", asking), k, rows_per_block, recall)

    # Per vector: the ids of its k nearest rows, copies repeated.
    mults = distinct.select("label", "id", "mult")
    listed = near.join(mults.withColumnsRenamed({"id": "nid", "mult": "nmult"}), ["label", "nid"]).groupBy(
        "label", F.col("qid").alias("id")
    ).agg(F.array_sort(F.collect_list(F.struct("rank", "nid", "nmult"))).alias("near"))
    repeated = lambda v, n: F.array_repeat(v, F.least(n, F.lit(k)).cast("int"))
    own = repeated(F.col("id"), F.col("mult") - 1)
    others = F.flatten(F.transform("near", lambda s: repeated(s["nid"], s["nmult"])))
    choices = mults.join(listed, ["label", "id"], "left").select(
        "label", "id",
        F.slice(F.concat(own, F.coalesce(others, F.array().cast("array<string>"))), 1, k).alias("choices"),
    )

    hot = mults.where(F.col("mult") > HOT_COPIES).select("label", "id", F.lit(True).alias("_hot"))
    children = join_small(rows.where(F.col("_copies") > 0), hot, ["label", "id"]).withColumn(
        "child", F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int")))
    )
    # A hot vector's neighbours are its own copies: the child equals the base.
    copied = children.where(F.col("_hot")).select("label", "vec")
    drawn = children.where(F.col("_hot").isNull()).drop("_hot").join(choices, ["label", "id"])
    draw_keys = [F.col("key").cast("string"), F.col("child").cast("string")]
    picked = drawn.withColumn(
        "nid", F.get("choices", F.floor(uniform(draw_keys, seed, 1) * F.size("choices")).cast("int"))
    ).withColumn("gap", uniform(draw_keys, seed, 2))
    targets = distinct.select("label", F.col("id").alias("nid"), F.col("vec").alias("other"))
    between = picked.join(targets, ["label", "nid"]).select(
        "label", F.zip_with("vec", "other", lambda a, b: a + F.col("gap") * (b - a)).alias("vec")
    )
    synthetic = copied.unionByName(between).select(
        F.col("label").alias(label), array_to_vector("vec").alias(features), F.lit(True).alias("synthetic")
    )
    return original.unionByName(synthetic)
