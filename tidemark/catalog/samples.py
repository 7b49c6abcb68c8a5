"""Baseline/current pairs cut from the driver tables, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.stats import MIN_PSI_EDGES, MIN_PSI_ROWS, SHARE_FLOOR
from .registry import table

SHIP_CUT = "1998-07-01"
EVENT_CUT = "2024-01-16"
SHIFT = 10

LINE_NUMERIC = ["l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]
LINE_CATEGORICAL = ["l_returnflag", "l_linestatus"]


def moment(df: DataFrame, column: str, text: str) -> Column:
    """A literal of the column's own type, so the comparison reaches the scan."""
    return F.lit(text).cast(df.schema[column].dataType)


def lineitem_pair(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Lines shipped before and after a date; ten units added to the later ones."""
    rows = table(spark, sf_dir, "lineitem")
    cut = moment(rows, "l_shipdate", SHIP_CUT)
    ref, cur = rows.where(F.col("l_shipdate") < cut), rows.where(F.col("l_shipdate") >= cut)
    cur = cur.withColumn("l_quantity", F.col("l_quantity") + SHIFT)
    return ref.drop("l_shipdate"), cur.drop("l_shipdate")


def events_pair(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value", "props")
    cut = moment(rows, "ts", EVENT_CUT)
    return rows.where(F.col("ts") < cut).drop("ts"), rows.where(F.col("ts") >= cut).drop("ts")


LINEITEM_TAGGED = f"""
tagged AS (
  SELECT l_shipdate >= TIMESTAMP '{SHIP_CUT}' AS is_cur, l_orderkey, l_partkey, l_suppkey, l_linenumber,
         l_quantity + CASE WHEN l_shipdate >= TIMESTAMP '{SHIP_CUT}' THEN {SHIFT} ELSE 0 END AS l_quantity,
         l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus
  FROM lineitem)"""

EVENTS_TAGGED = f"""
tagged AS (
  SELECT ts >= TIMESTAMP '{EVENT_CUT}' AS is_cur, event_id, user_id, event_type, value, props FROM events)"""


def long_sql(name: str, columns: list[tuple[int, str, str]], cast: str) -> str:
    """CTE with one row per (column, row); ``columns`` is (position, name, expression)."""
    parts = [
        f"SELECT {p} AS pos, '{c}' AS column_name, is_cur, CAST({e} AS {cast}) AS v FROM tagged"
        for p, c, e in columns
    ]
    return f"{name} AS ({' UNION ALL '.join(parts)})"


QUANTILES = ", ".join(f"{i * 0.1!r}::DOUBLE" for i in range(10)) + ", 1.0::DOUBLE"

# KS p-value of (d, n, m): the corrected Kolmogorov tail, as two series.
_SERIES_DIRECT = "2 * list_sum(list_transform(range(1, 101), lambda k: (CASE WHEN k % 2 = 1 THEN 1.0 ELSE -1.0 END) * exp(-2.0 * k * k * z * z)))"
_SERIES_DUAL = "1 - sqrt(2 * pi()) / greatest(z, 1e-3) * list_sum(list_transform(range(1, 101), lambda k: exp(-((2*k-1) * (2*k-1)) * pi() * pi() / 8 / (greatest(z, 1e-3) * greatest(z, 1e-3)))))"


def numeric_metric_ctes() -> str:
    """CTEs from ``num`` (pos, column_name, is_cur, v) to ``num_metrics``."""
    return f"""
cleaned AS (SELECT * FROM num WHERE v IS NOT NULL AND NOT isnan(v)),
edges AS (
  SELECT pos, list_sort(list_distinct(quantile_cont(v, [{QUANTILES}]))) AS e
  FROM cleaned WHERE NOT is_cur GROUP BY pos),
sizes AS (
  SELECT pos, any_value(column_name) AS column_name, count(*) FILTER (NOT is_cur) AS n, count(*) FILTER (is_cur) AS m
  FROM cleaned GROUP BY pos),
binned AS (
  SELECT c.pos, c.is_cur, least(len(list_filter(e, lambda x: x <= v)), len(e) - 1) AS b
  FROM cleaned c JOIN edges USING (pos) WHERE v >= e[1] AND v <= e[len(e)]),
bins AS (
  SELECT pos, b, count(*) FILTER (NOT is_cur) AS a, count(*) FILTER (is_cur) AS c FROM binned GROUP BY pos, b),
shares AS (
  SELECT pos, greatest(a / greatest(sum(a) OVER (PARTITION BY pos), 1), {SHARE_FLOOR}) AS pa,
         greatest(c / greatest(sum(c) OVER (PARTITION BY pos), 1), {SHARE_FLOOR}) AS pb
  FROM bins),
raw_psi AS (SELECT pos, sum((pa - pb) * ln(pa / pb)) AS p FROM shares GROUP BY pos),
by_value AS (
  SELECT pos, v, count(*) FILTER (NOT is_cur) AS a, count(*) FILTER (is_cur) AS c FROM cleaned GROUP BY pos, v),
steps AS (
  SELECT pos, sum(a) OVER w AS ca, sum(c) OVER w AS cc FROM by_value WINDOW w AS (PARTITION BY pos ORDER BY v)),
distance AS (
  SELECT pos, max(abs(ca / greatest(n, 1) - cc / greatest(m, 1))) AS d FROM steps JOIN sizes USING (pos) GROUP BY pos),
ks AS (
  SELECT pos, d, greatest(round_even(n * m / greatest(n + m, 1.0), 0), 1.0) AS en, n, m FROM distance JOIN sizes USING (pos)),
ks_z AS (
  SELECT *, greatest(sqrt(en) * d + 1 / (6 * sqrt(en)) + (sqrt(en) * d - 1) / (4 * en), 0.0) AS z FROM ks),
ks_p AS (
  SELECT pos, d, n, m, CASE WHEN d <= 0 THEN 1.0
    ELSE greatest(0.0, least(1.0, CASE WHEN z < 1.0 THEN {_SERIES_DUAL} ELSE {_SERIES_DIRECT} END)) END AS p FROM ks_z),
num_metrics AS (
  SELECT s.pos, s.column_name, 'numeric' AS kind, s.n AS n_ref, s.m AS n_cur,
         CASE WHEN least(s.n, s.m) >= {MIN_PSI_ROWS} AND len(e) >= {MIN_PSI_EDGES} THEN coalesce(r.p, 0.0) ELSE 0.0 END AS psi,
         k.d AS ks_d, CASE WHEN s.n > 0 AND s.m > 0 THEN k.p ELSE 1.0 END AS ks_p
  FROM sizes s LEFT JOIN edges USING (pos) LEFT JOIN raw_psi r USING (pos) LEFT JOIN ks_p k USING (pos))"""


def categorical_metric_ctes() -> str:
    """CTEs from ``cat`` (pos, column_name, is_cur, v) to ``cat_metrics``."""
    return f"""
cat_counts AS (
  SELECT pos, any_value(column_name) AS column_name, v, count(*) FILTER (NOT is_cur) AS a, count(*) FILTER (is_cur) AS c
  FROM cat WHERE v IS NOT NULL GROUP BY pos, v),
cat_shares AS (
  SELECT pos, column_name, a, c,
         a / greatest(sum(a) OVER (PARTITION BY pos), 1) + {SHARE_FLOOR} AS pa,
         c / greatest(sum(c) OVER (PARTITION BY pos), 1) + {SHARE_FLOOR} AS pb
  FROM cat_counts),
cat_metrics AS (
  SELECT pos, any_value(column_name) AS column_name, 'categorical' AS kind, CAST(sum(a) AS BIGINT) AS n_ref,
         CAST(sum(c) AS BIGINT) AS n_cur, sum((pa - pb) * ln(pa / pb)) AS psi,
         CAST(NULL AS DOUBLE) AS ks_d, CAST(NULL AS DOUBLE) AS ks_p
  FROM cat_shares GROUP BY pos)"""


def metrics_sql(tagged: str, numeric: list[tuple[int, str, str]], categorical: list[tuple[int, str, str]]) -> str:
    """``WITH ... metrics AS (...)``: one row per compared column."""
    ctes = [tagged.strip(), long_sql("num", numeric, "DOUBLE"), numeric_metric_ctes().strip()]
    union = "SELECT * FROM num_metrics"
    if categorical:
        ctes += [long_sql("cat", categorical, "VARCHAR"), categorical_metric_ctes().strip()]
        union += " UNION ALL SELECT * FROM cat_metrics"
    return "WITH " + ",\n".join(ctes) + f",\nmetrics AS ({union})"


def lineitem_metrics_sql() -> str:
    numeric = [(i, c, c) for i, c in enumerate(LINE_NUMERIC)]
    categorical = [(len(LINE_NUMERIC) + i, c, c) for i, c in enumerate(LINE_CATEGORICAL)]
    return metrics_sql(LINEITEM_TAGGED, numeric, categorical)


def uniform_sql(key: str, seed: int, draw: int = 0) -> str:
    """The md5 draw of ``functions.draws.uniform`` in SQL."""
    return f"(CAST(('0x' || substr(md5({key} || '|{seed}:{draw}'), 1, 13)) AS BIGINT) / {float(16**13)!r})"


def beta_sql(key: str, seed: int) -> str:
    return f"list_sort([{', '.join(uniform_sql(key, seed, i) for i in range(6))}])[2]"
