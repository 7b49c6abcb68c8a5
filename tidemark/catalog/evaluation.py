"""Classification metric queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.evaluation import average_precision, binary_metrics, classification_report, confusion_counts, confusion_matrix, roc_auc
from .registry import register, table


def scored_documents(spark, sf_dir):
    """Labelled documents with a score that grows with their length."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    scored = table(spark, sf_dir, "labels").join(docs, "doc_id")
    return scored.withColumn("score", F.round(F.col("n_chars") / (F.col("n_chars") + F.lit(1000.0)), 3))


_SCORED = """scored AS (SELECT doc_id, quality AS y, lang, round(n_chars / (n_chars + 1000.0), 3) AS score
  FROM labels JOIN documents USING (doc_id))"""


def _metric_sql(groups: str) -> str:
    """Pairwise AUC through mid-ranks and stepwise average precision."""
    by = f"PARTITION BY {groups}" if groups else ""
    lead = f"{groups}, " if groups else ""
    return f"""WITH {_SCORED},
    v AS (SELECT {lead} score, count(*) FILTER (y = 1) AS p, count(*) FILTER (y = 0) AS q FROM scored GROUP BY {lead} score),
    w AS (SELECT *, sum(q) OVER ({by} ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - q AS below,
            sum(p) OVER ({by} ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS tp,
            sum(q) OVER ({by} ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fp FROM v)
    SELECT {lead} CAST(sum(p) + sum(q) AS BIGINT) AS n,
      round(CASE WHEN sum(p) > 0 AND sum(q) > 0 THEN sum(p * (below + q / 2)) / (sum(p)::DOUBLE * sum(q)) END, 9) AS auc,
      round(CASE WHEN sum(p) > 0 THEN sum(p * (tp / (tp + fp))) / sum(p) ELSE 0.0 END, 9) AS ap,
      round((sum(p) FILTER (score >= 0.5) + coalesce(sum(q) FILTER (score < 0.5), 0)) / (sum(p) + sum(q)), 9) AS acc,
      round(2 * sum(p) FILTER (score >= 0.5) / (sum(p) FILTER (score >= 0.5) + sum(q) FILTER (score >= 0.5) + sum(p)), 9) AS f1
    FROM w {f'GROUP BY {groups}' if groups else ''}"""


def _rounded(df):
    return df.select(*[F.round(c, 9).alias(c) if c in ("auc", "ap", "acc", "f1") else F.col(c) for c in df.columns])


@register("roc_auc", f"SELECT auc FROM ({_metric_sql('')})")
def _auc(spark, sf_dir):
    return _rounded(roc_auc(scored_documents(spark, sf_dir), "quality", "score"))


@register("average_precision", f"SELECT ap FROM ({_metric_sql('')})")
def _ap(spark, sf_dir):
    return _rounded(average_precision(scored_documents(spark, sf_dir), "quality", "score"))


@register("binary_metrics", _metric_sql(""))
def _binary(spark, sf_dir):
    return _rounded(binary_metrics(scored_documents(spark, sf_dir), "quality", "score", n_buckets=16))


@register("binary_metrics_by_group", _metric_sql("lang"))
def _binary_groups(spark, sf_dir):
    return _rounded(binary_metrics(scored_documents(spark, sf_dir), "quality", "score", ["lang"], n_buckets=16))


_GUESS = {"1-URGENT": "F", "2-HIGH": "F", "3-MEDIUM": "O", "4-NOT SPECIFIED": "O", "5-LOW": "P"}
_GUESS_SQL = (
    "CASE o_orderpriority WHEN '1-URGENT' THEN 'F' WHEN '2-HIGH' THEN 'F' WHEN '3-MEDIUM' THEN 'O' "
    "WHEN '4-NOT SPECIFIED' THEN 'O' WHEN '5-LOW' THEN 'P' END"
)
_PAIRS = f"""c AS (SELECT o_orderstatus AS a, {_GUESS_SQL} AS p, count(*) AS n FROM orders
  WHERE o_orderstatus IS NOT NULL AND {_GUESS_SQL} IS NOT NULL GROUP BY 1, 2)"""


def guessed_orders(spark, sf_dir):
    """Order status against a guess made from the priority."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    pairs = [F.lit(x) for kv in _GUESS.items() for x in kv]
    return orders.withColumn("guess", F.try_element_at(F.create_map(*pairs), F.col("o_orderpriority")))


@register(
    "confusion_matrix",
    f"""WITH {_PAIRS} SELECT a AS actual, CAST(coalesce(sum(n) FILTER (p = 'F'), 0) AS BIGINT) AS "F",
    CAST(coalesce(sum(n) FILTER (p = 'O'), 0) AS BIGINT) AS "O", CAST(coalesce(sum(n) FILTER (p = 'P'), 0) AS BIGINT) AS "P"
    FROM c GROUP BY a""",
)
def _confusion(spark, sf_dir):
    return confusion_matrix(guessed_orders(spark, sf_dir), "o_orderstatus", "guess", ["F", "O", "P"])


@register("confusion_cells", f"WITH {_PAIRS} SELECT a AS actual, p AS predicted, n FROM c")
def _confusion_cells(spark, sf_dir):
    return confusion_counts(guessed_orders(spark, sf_dir), "o_orderstatus", "guess")


@register(
    "class_report",
    f"""WITH {_PAIRS}, l AS (SELECT a AS label FROM c UNION SELECT p FROM c),
    m AS (SELECT label, coalesce(sum(n) FILTER (a = label AND p = label), 0) AS tp, coalesce(sum(n) FILTER (p = label), 0) AS said,
          coalesce(sum(n) FILTER (a = label), 0) AS support FROM l, c GROUP BY label),
    r AS (SELECT label, CASE WHEN said > 0 THEN tp / said ELSE 0.0 END AS precision, CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS recall,
          CASE WHEN said + support > 0 THEN 2 * tp / (said + support) ELSE 0.0 END AS f1, support, tp FROM m),
    u AS (SELECT label, precision, recall, f1, support FROM r
      UNION ALL SELECT 'accuracy', sum(tp) / sum(support), sum(tp) / sum(support), sum(tp) / sum(support), sum(support) FROM r
      UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) FROM r
      UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
        sum(f1 * support) / sum(support), sum(support) FROM r)
    SELECT label, round(precision, 9) AS precision, round(recall, 9) AS recall, round(f1, 9) AS f1, CAST(support AS BIGINT) AS support FROM u""",
)
def _report(spark, sf_dir):
    out = classification_report(guessed_orders(spark, sf_dir), "o_orderstatus", "guess")
    return out.select("label", *[F.round(m, 9).alias(m) for m in ("precision", "recall", "f1")], "support")


@register(
    "accuracy",
    f"SELECT round(avg(CASE WHEN o_orderstatus = {_GUESS_SQL} THEN 1.0 ELSE 0.0 END), 9) AS accuracy FROM orders",
)
def _accuracy(spark, sf_dir):
    hit = (F.col("o_orderstatus") == F.col("guess")).cast("double")
    return guessed_orders(spark, sf_dir).agg(F.round(F.avg(hit), 9).alias("accuracy"))
