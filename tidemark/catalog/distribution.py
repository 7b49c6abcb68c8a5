"""PSI, KS, quantile and histogram queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.columns import ComparedColumn
from ..operators.distribution import (
    category_shares,
    category_counts,
    histogram_by_side,
    ks_two_sample,
    numeric_histogram,
    psi_categorical,
    psi_numeric,
    quantile_edges,
)
from ..operators.tagging import category_counts_by_side, numeric_value_counts, tag_union
from .registry import register, table
from .samples import (
    EVENT_CUT,
    EVENTS_TAGGED,
    LINE_CATEGORICAL,
    LINE_NUMERIC,
    LINEITEM_TAGGED,
    QUANTILES,
    events_pair,
    lineitem_metrics_sql,
    lineitem_pair,
    long_sql,
    metrics_sql,
)


@register("psi_numeric", metrics_sql(EVENTS_TAGGED, [(0, "value", "value")], []) + " SELECT round(psi, 9) AS psi FROM metrics")
def _psi_numeric(spark, sf_dir):
    return psi_numeric(*events_pair(spark, sf_dir), "value").select(F.round("psi", 9).alias("psi"))


@register(
    "psi_categorical",
    metrics_sql(EVENTS_TAGGED, [(0, "value", "value")], [(1, "event_type", "event_type")])
    + " SELECT round(psi, 9) AS psi FROM cat_metrics",
)
def _psi_categorical(spark, sf_dir):
    return psi_categorical(*events_pair(spark, sf_dir), "event_type").select(F.round("psi", 9).alias("psi"))


@register(
    "ks_two_sample",
    metrics_sql(EVENTS_TAGGED, [(0, "value", "value")], [])
    + " SELECT round(ks_d, 9) AS ks_d, round(ks_p, 9) AS ks_p, n_ref, n_cur FROM metrics",
)
def _ks(spark, sf_dir):
    out = ks_two_sample(*events_pair(spark, sf_dir), "value", method="asymp")
    return out.select(F.round("ks_d", 9).alias("ks_d"), F.round("ks_p", 9).alias("ks_p"), "n_ref", "n_cur")


_BALANCES = """v AS (SELECT s_suppkey % 3 = 0 AS is_cur, s_acctbal + CASE WHEN s_suppkey % 3 = 0 THEN 900 ELSE 0 END AS v FROM supplier),
  size AS (SELECT count(*) FILTER (NOT is_cur) AS n, count(*) FILTER (is_cur) AS m FROM v),
  steps AS (SELECT v, sum(sum(CASE WHEN is_cur THEN 0 ELSE 1 END)) OVER (ORDER BY v) AS a,
    sum(sum(CASE WHEN is_cur THEN 1 ELSE 0 END)) OVER (ORDER BY v) AS b FROM v GROUP BY v),
  gap AS (SELECT n, m, max(abs(a * m - b * n))::BIGINT AS gap FROM steps, size GROUP BY n, m)"""


@register(
    "ks_exact",
    f"""WITH RECURSIVE {_BALANCES},
    walk AS (
      SELECT 0 AS t, n, m, gap, [0.0::DOUBLE FOR x IN range(0, n + 1)] AS s FROM gap
      UNION ALL
      SELECT t + 1, n, m, gap, [CASE WHEN x > t + 1 OR t + 1 - x > m THEN 0.0 WHEN abs(x * m - (t + 1 - x) * n) >= gap THEN 1.0
        ELSE x / (t + 1) * CASE WHEN x > 0 THEN s[x] ELSE 0.0 END + (t + 1 - x) / (t + 1) * s[x + 1] END FOR x IN range(0, n + 1)]
      FROM walk WHERE t < n + m)
    SELECT round(gap / (n * m), 9) AS ks_d, round(least(s[n + 1], 1.0), 9) AS ks_p, n AS n_ref, m AS n_cur FROM walk WHERE t = n + m""",
)
def _ks_exact(spark, sf_dir):
    """Samples small enough for the exact p-value, which is the default: supplier balances, a third of them raised."""
    rows = table(spark, sf_dir, "supplier")
    ref, cur = rows.where("s_suppkey % 3 <> 0"), rows.where("s_suppkey % 3 = 0").withColumn("s_acctbal", F.col("s_acctbal") + 900)
    out = ks_two_sample(ref, cur, "s_acctbal")
    return out.select(F.round("ks_d", 9).alias("ks_d"), F.round("ks_p", 9).alias("ks_p"), "n_ref", "n_cur")


@register(
    "ks_without_finite_values",
    f"""SELECT 1.0::DOUBLE AS ks_p, count(*) FILTER (ts < TIMESTAMP '{EVENT_CUT}') AS n_ref, count(*) FILTER (ts >= TIMESTAMP '{EVENT_CUT}') AS n_cur
    FROM events WHERE value IS NOT NULL AND NOT isnan(value)""",
)
def _ks_guard(spark, sf_dir):
    """A side whose values are all infinite has nothing to compare: p is 1."""
    ref, cur = events_pair(spark, sf_dir)
    cur = cur.withColumn("value", F.when(F.col("value").isNotNull() & ~F.isnan("value"), F.lit(float("inf"))))
    return ks_two_sample(ref, cur, "value").select("ks_p", "n_ref", "n_cur")


@register(
    "ks_all_columns",
    lineitem_metrics_sql()
    + " SELECT column_name, round(ks_d, 9) AS ks_d, round(ks_p, 9) AS ks_p, n_ref, n_cur, round(psi, 9) AS psi FROM num_metrics",
)
def _ks_all(spark, sf_dir):
    from ..operators.distribution import numeric_metrics

    ref, cur = lineitem_pair(spark, sf_dir)
    specs = [ComparedColumn(c, "numeric", i) for i, c in enumerate(LINE_NUMERIC)]
    names = spark.createDataFrame([(s.position, s.name) for s in specs], "pos int, column_name string")
    metrics = numeric_metrics(numeric_value_counts(ref, cur, specs), ks_method="asymp", n_buckets=64)
    return metrics.join(F.broadcast(names), "pos").select(
        "column_name", F.round("ks_d", 9).alias("ks_d"), F.round("ks_p", 9).alias("ks_p"), "n_ref", "n_cur",
        F.round("psi", 9).alias("psi"),
    )


_LINE_LONG = "WITH " + LINEITEM_TAGGED.strip() + ", " + long_sql("num", [(i, c, c) for i, c in enumerate(LINE_NUMERIC)], "DOUBLE")


@register(
    "quantile_edges",
    _LINE_LONG + f""", e AS (SELECT column_name, list_sort(list_distinct(quantile_cont(v, [{QUANTILES}]))) AS edges
    FROM num WHERE NOT is_cur GROUP BY column_name)
    SELECT column_name, CAST(i AS INTEGER) AS edge_no, round(edges[i + 1], 6) AS edge
    FROM e, range(11) r(i) WHERE i < len(edges)""",
)
def _edges(spark, sf_dir):
    ref, _ = lineitem_pair(spark, sf_dir)
    edges = quantile_edges(ref, LINE_NUMERIC)
    return edges.select(F.col("column").alias("column_name"), F.posexplode("edges").alias("edge_no", "edge")).withColumn(
        "edge", F.round("edge", 6)
    )


@register(
    "histogram_on_edges",
    _LINE_LONG + f""", e AS (SELECT pos, list_sort(list_distinct(quantile_cont(v, [{QUANTILES}]))) AS edges
    FROM num WHERE NOT is_cur GROUP BY pos)
    SELECT column_name, CAST(least(len(list_filter(edges, lambda x: x <= v)), len(edges) - 1) AS INTEGER) AS bin,
           count(*) FILTER (NOT is_cur) AS n_ref, count(*) FILTER (is_cur) AS n_cur
    FROM num JOIN e USING (pos) WHERE v >= edges[1] AND v <= edges[len(edges)] GROUP BY 1, 2""",
)
def _hist_edges(spark, sf_dir):
    ref, cur = lineitem_pair(spark, sf_dir)
    specs = [ComparedColumn(c, "numeric", i) for i, c in enumerate(LINE_NUMERIC)]
    names = spark.createDataFrame([(s.position, s.name) for s in specs], "pos int, column string")
    edges = quantile_edges(ref, LINE_NUMERIC).join(F.broadcast(names), "column")
    hist = histogram_by_side(numeric_value_counts(ref, cur, specs), edges)
    return hist.join(F.broadcast(names), "pos").select(F.col("column").alias("column_name"), "bin", "n_ref", "n_cur")


_HIST_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@register(
    "hist30",
    "WITH num AS ("
    + " UNION ALL ".join(f"SELECT '{c}' AS column_name, CAST({c} AS DOUBLE) AS v FROM lineitem" for c in _HIST_COLS)
    + """), s AS (SELECT column_name, min(v) AS lo, max(v) AS hi FROM num GROUP BY column_name),
    w AS (SELECT column_name, CASE WHEN lo = hi THEN lo - 0.5 ELSE lo END AS lo,
          CASE WHEN lo = hi THEN 1.0 ELSE hi - lo END / 30 AS width FROM s)
    SELECT column_name, CAST(least(floor((v - lo) / width), 29) AS INTEGER) AS bin,
           round(max(lo + least(floor((v - lo) / width), 29) * width), 6) AS bin_low,
           round(max(lo + (least(floor((v - lo) / width), 29) + 1) * width), 6) AS bin_high, count(*) AS n
    FROM num JOIN w USING (column_name) GROUP BY 1, 2""",
)
def _hist30(spark, sf_dir):
    hist = numeric_histogram(table(spark, sf_dir, "lineitem"), _HIST_COLS, 30)
    return hist.select(
        F.col("column").alias("column_name"), "bin", F.round("bin_low", 6).alias("bin_low"),
        F.round("bin_high", 6).alias("bin_high"), "n",
    )


_CAT_COLS = ["o_orderstatus", "o_orderpriority"]


@register(
    "category_counts",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, {c} AS value, count(*) AS n FROM orders WHERE {c} IS NOT NULL GROUP BY {c}"
        for c in _CAT_COLS
    ),
)
def _cat_counts(spark, sf_dir):
    return category_counts(table(spark, sf_dir, "orders"), _CAT_COLS).withColumnRenamed("column", "column_name")


@register(
    "category_shares",
    "WITH " + LINEITEM_TAGGED.strip() + ", "
    + long_sql("cat", [(i, c, c) for i, c in enumerate(LINE_CATEGORICAL)], "VARCHAR")
    + """, n AS (SELECT column_name, v, count(*) FILTER (NOT is_cur) AS a, count(*) FILTER (is_cur) AS c
    FROM cat WHERE v IS NOT NULL GROUP BY 1, 2)
    SELECT column_name, v AS category, round(a / greatest(sum(a) OVER (PARTITION BY column_name), 1), 9) AS ref_share,
           round(c / greatest(sum(c) OVER (PARTITION BY column_name), 1), 9) AS cur_share FROM n""",
)
def _cat_shares(spark, sf_dir):
    ref, cur = lineitem_pair(spark, sf_dir)
    specs = [ComparedColumn(c, "categorical", i) for i, c in enumerate(LINE_CATEGORICAL)]
    names = spark.createDataFrame([(s.position, s.name) for s in specs], "pos int, column_name string")
    shares = category_shares(category_counts_by_side(ref, cur, specs))
    return shares.join(F.broadcast(names), "pos").select(
        "column_name", F.col("value").alias("category"),
        F.round("ref_share", 9).alias("ref_share"), F.round("cur_share", 9).alias("cur_share"))


@register(
    "category_union",
    "SELECT DISTINCT CAST(user_id AS VARCHAR) AS category FROM events",
)
def _cat_union(spark, sf_dir):
    ref, cur = events_pair(spark, sf_dir)
    specs = [ComparedColumn("user_id", "categorical", 0)]
    return category_counts_by_side(ref, cur, specs).select(F.col("value").alias("category"))


@register(
    "tagged_union",
    "SELECT CASE WHEN ts >= TIMESTAMP '2024-01-16' THEN 'cur' ELSE 'ref' END AS side, count(*) AS n, "
    "round(avg(value), 6) AS mean_value FROM events GROUP BY 1",
)
def _tagged(spark, sf_dir):
    ref, cur = events_pair(spark, sf_dir)
    return tag_union(ref, cur).groupBy("side").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("value"), 6).alias("mean_value")
    )


@register(
    "ecdf",
    "WITH " + EVENTS_TAGGED.strip() + """, v AS (SELECT value, count(*) FILTER (NOT is_cur) AS a, count(*) FILTER (is_cur) AS c
    FROM tagged WHERE value IS NOT NULL GROUP BY value)
    SELECT value, round(sum(a) OVER (ORDER BY value) / sum(a) OVER (), 9) AS ref_ecdf,
           round(sum(c) OVER (ORDER BY value) / sum(c) OVER (), 9) AS cur_ecdf FROM v""",
)
def _ecdf(spark, sf_dir):
    from ..operators.ordering import running_totals

    ref, cur = events_pair(spark, sf_dir)
    values = numeric_value_counts(ref, cur, [ComparedColumn("value", "numeric", 0)])
    run = running_totals(values, ["pos"], "value", ["n_ref", "n_cur"], n_buckets=32)
    return run.select(
        "value", F.round(F.col("cum_n_ref") / F.col("tot_n_ref"), 9).alias("ref_ecdf"),
        F.round(F.col("cum_n_cur") / F.col("tot_n_cur"), 9).alias("cur_ecdf"),
    )
