"""Scaling and encoding queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.encoding import fit_encoder
from ..operators.preprocess import (
    category_table,
    consistent_standardise,
    fit_preprocessor,
    one_hot_long,
    one_hot_slots,
    scaler_stats,
)
from .registry import register, table
from .samples import LINE_NUMERIC, moment

_ORDER_CUT = "1998-01-01"


def _order_pair(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    cut = moment(orders, "o_orderdate", _ORDER_CUT)
    return orders.where(F.col("o_orderdate") < cut), orders.where(F.col("o_orderdate") >= cut)


@register(
    "scaler_stats",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, round(avg({c}), 6) AS mean, round(stddev_pop({c}), 6) AS std FROM lineitem"
        for c in LINE_NUMERIC
    ),
)
def _stats(spark, sf_dir):
    out = scaler_stats(table(spark, sf_dir, "lineitem"), LINE_NUMERIC)
    return out.select(F.col("column").alias("column_name"), F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"))


_ORDER_NUMBERS = ["o_custkey", "o_totalprice"]


@register(
    "standardize_ref_fit",
    f"""WITH s AS (SELECT {', '.join(f'avg({c}) AS m_{c}, stddev_pop({c}) AS d_{c}' for c in _ORDER_NUMBERS)}
      FROM orders WHERE o_orderdate < TIMESTAMP '{_ORDER_CUT}')
    SELECT o_orderkey, CASE WHEN o_orderdate < TIMESTAMP '{_ORDER_CUT}' THEN 'ref' ELSE 'cur' END AS side,
           {', '.join(f'round(({c} - m_{c}) / d_{c}, 6) AS {c}' for c in _ORDER_NUMBERS)} FROM orders, s""",
)
def _standardise(spark, sf_dir):
    """Every number of the orders but the row's key."""
    ref, cur = consistent_standardise(*_order_pair(spark, sf_dir), _ORDER_NUMBERS)
    both = ref.withColumn("side", F.lit("ref")).unionByName(cur.withColumn("side", F.lit("cur")))
    return both.select("o_orderkey", "side", *[F.round(c, 6).alias(c) for c in _ORDER_NUMBERS])


_ORDER_CATS = ["o_orderstatus", "o_orderpriority"]
_CATS_SQL = " UNION ".join(f"SELECT '{c}' AS column_name, {i} AS p, {c} AS category FROM orders" for i, c in enumerate(_ORDER_CATS))


@register(
    "category_ranks",
    f"SELECT column_name, category, row_number() OVER (PARTITION BY column_name ORDER BY category) - 1 AS rank FROM ({_CATS_SQL})",
)
def _ranks(spark, sf_dir):
    return category_table(table(spark, sf_dir, "orders"), _ORDER_CATS).withColumnRenamed("column", "column_name")


_SLOTS_SQL = f"""r AS (SELECT column_name, p, category, row_number() OVER (PARTITION BY column_name ORDER BY category) - 1 AS rank FROM ({_CATS_SQL})),
    w AS (SELECT column_name, p, count(*) - 1 AS width FROM r GROUP BY 1, 2),
    o AS (SELECT column_name, coalesce(sum(width) OVER (ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM w),
    slots AS (SELECT r.column_name, category, rank, CAST(CASE WHEN rank > 0 THEN start + rank - 1 END AS BIGINT) AS slot FROM r JOIN o USING (column_name))"""


@register("one_hot_slots", f"WITH {_SLOTS_SQL} SELECT * FROM slots")
def _slots(spark, sf_dir):
    return one_hot_slots(table(spark, sf_dir, "orders"), _ORDER_CATS).withColumnRenamed("column", "column_name")


@register(
    "one_hot_long",
    f"WITH {_SLOTS_SQL} "
    + " UNION ALL ".join(
        f"SELECT o_orderkey, '{c}' AS column_name, slot FROM orders JOIN slots ON slots.column_name = '{c}' AND slots.category = {c} WHERE slot IS NOT NULL"
        for c in _ORDER_CATS
    ),
)
def _one_hot(spark, sf_dir):
    return one_hot_long(table(spark, sf_dir, "orders"), "o_orderkey", _ORDER_CATS).withColumnRenamed("column", "column_name")


@register(
    "one_hot_many_categories",
    """WITH r AS (SELECT c_name AS category, row_number() OVER (ORDER BY c_name) - 1 AS rank FROM (SELECT DISTINCT c_name FROM customer))
    SELECT c_custkey, 'c_name' AS column_name, rank - 1 AS slot FROM customer JOIN r ON category = c_name WHERE rank > 0""",
)
def _one_hot_many(spark, sf_dir):
    """A column with one category per row: ranks and join stay distributed."""
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return one_hot_long(rows, "c_custkey", ["c_name"]).withColumnRenamed("column", "column_name")


def _order_features(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_totalprice", "o_orderstatus", "o_orderpriority")


@register(
    "encoded_feature_names",
    """SELECT CAST(row_number() OVER (ORDER BY k, category) - 1 AS INTEGER) AS position, name FROM (
      SELECT 0 AS k, '' AS category, 'o_totalprice' AS name
      UNION ALL SELECT 1, category, 'o_orderstatus_' || category FROM (SELECT *, row_number() OVER (ORDER BY category) AS r FROM (SELECT DISTINCT o_orderstatus AS category FROM orders)) WHERE r > 1
      UNION ALL SELECT 2, category, 'o_orderpriority_' || category FROM (SELECT *, row_number() OVER (ORDER BY category) AS r FROM (SELECT DISTINCT o_orderpriority AS category FROM orders)) WHERE r > 1)""",
)
def _names(spark, sf_dir):
    fitted = fit_preprocessor(_order_features(spark, sf_dir))
    return spark.createDataFrame(list(enumerate(fitted.feature_names)), "position int, name string")


@register(
    "encoded_frame_means",
    """SELECT round(avg((o_totalprice - m) / d), 6) + 0.0 AS feature_0, round(avg(CAST(o_orderstatus = 'O' AS INTEGER)), 6) AS feature_1,
    round(avg(CAST(o_orderstatus = 'P' AS INTEGER)), 6) AS feature_2, round(avg(CAST(o_orderpriority = '2-HIGH' AS INTEGER)), 6) AS feature_3,
    round(avg(CAST(o_orderpriority = '3-MEDIUM' AS INTEGER)), 6) AS feature_4, round(avg(CAST(o_orderpriority = '4-NOT SPECIFIED' AS INTEGER)), 6) AS feature_5,
    round(avg(CAST(o_orderpriority = '5-LOW' AS INTEGER)), 6) AS feature_6
    FROM orders, (SELECT avg(o_totalprice) AS m, stddev_pop(o_totalprice) AS d FROM orders)""",
)
def _encoded(spark, sf_dir):
    rows = _order_features(spark, sf_dir)
    wide = fit_preprocessor(rows).encoded_frame(rows, generic=True)
    return wide.agg(*[(F.round(F.avg(c), 6) + F.lit(0.0)).alias(c) for c in wide.columns])


@register(
    "encoded_both_sides",
    """WITH ref AS (SELECT * FROM customer WHERE c_custkey % 3 <> 0),
    stats AS (SELECT avg(c_acctbal) AS m, stddev_pop(c_acctbal) AS d FROM ref),
    names AS (SELECT c_name, row_number() OVER (ORDER BY c_name) - 1 AS r FROM (SELECT DISTINCT c_name FROM ref)),
    segments AS (SELECT c_mktsegment, row_number() OVER (ORDER BY c_mktsegment) - 1 AS r FROM (SELECT DISTINCT c_mktsegment FROM ref)),
    width AS (SELECT count(*) - 1 AS n FROM names)
    SELECT CASE WHEN c_custkey % 3 <> 0 THEN 'ref' ELSE 'cur' END AS side, c_custkey, round((c_acctbal - m) / d, 6) + 0.0 AS balance,
      array_to_string([x FOR x IN [CASE WHEN names.r > 0 THEN names.r END, CASE WHEN segments.r > 0 THEN n + segments.r END] IF x IS NOT NULL], ',') AS slots
    FROM customer LEFT JOIN names USING (c_name) LEFT JOIN segments USING (c_mktsegment), stats, width""",
)
def _both_sides(spark, sf_dir):
    """An encoder fitted on the baseline and applied to both sides; a name of the other side is unknown to it."""
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", "c_name", "c_mktsegment")
    sides = {"ref": rows.where("c_custkey % 3 <> 0"), "cur": rows.where("c_custkey % 3 = 0")}
    encoder = fit_encoder(sides["ref"], ("c_custkey",))
    out = [encoder.entries(df, ["c_custkey"]).withColumn("side", F.lit(side)) for side, df in sides.items()]
    grouped = out[0].unionByName(out[1]).groupBy("side", "c_custkey").agg(
        F.max(F.when(F.col("position") == 0, F.col("value"))).alias("balance"),
        F.array_sort(F.collect_list(F.when(F.col("position") > 0, F.col("position")))).alias("slots"))
    return grouped.select("side", "c_custkey", (F.round("balance", 6) + F.lit(0.0)).alias("balance"),
                          F.concat_ws(",", F.col("slots").cast("array<string>")).alias("slots"))
