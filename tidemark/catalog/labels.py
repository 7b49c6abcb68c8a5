"""Label, weight and split queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.labels import (
    balanced_weights,
    binarised,
    decode_labels,
    encode_labels,
    label_classes,
    mapped_code,
    merge_labels,
    scale_pos_weight,
    threshold_prediction,
    with_balanced_weight,
    with_positive_weight,
)
from ..operators.sampling import mock_predictions, stratified_folds, stratified_split
from .registry import register, table
from .samples import beta_sql

_MERGE = {"R": "YES", "A": "YES", "N": "NO"}
_MERGE_SQL = "CASE l_returnflag WHEN 'R' THEN 'YES' WHEN 'A' THEN 'YES' WHEN 'N' THEN 'NO' ELSE l_returnflag END"


def _merged(spark, sf_dir):
    return merge_labels(table(spark, sf_dir, "lineitem"), "l_returnflag", _MERGE)


@register("label_merge", f"SELECT {_MERGE_SQL} AS label, l_linestatus, count(*) AS n FROM lineitem GROUP BY 1, 2")
def _merge(spark, sf_dir):
    return _merged(spark, sf_dir).groupBy(F.col("l_returnflag").alias("label"), "l_linestatus").agg(
        F.count(F.lit(1)).alias("n")
    )


@register(
    "label_binarize",
    f"SELECT l_orderkey, l_linenumber, CAST(({_MERGE_SQL}) = 'YES' AS INTEGER) AS y FROM lineitem",
)
def _binarise(spark, sf_dir):
    return _merged(spark, sf_dir).select("l_orderkey", "l_linenumber", binarised(F.col("l_returnflag")).alias("y"))


@register(
    "label_colour_codes",
    f"SELECT CAST(CASE {_MERGE_SQL} WHEN 'NO' THEN 0 WHEN 'YES' THEN 1 END AS INTEGER) AS code, count(*) AS n FROM lineitem GROUP BY 1",
)
def _codes(spark, sf_dir):
    rows = _merged(spark, sf_dir).select(mapped_code(F.col("l_returnflag")).alias("code"))
    return rows.groupBy("code").agg(F.count(F.lit(1)).alias("n"))


@register(
    "label_encode",
    """WITH c AS (SELECT o_orderpriority, dense_rank() OVER (ORDER BY o_orderpriority) - 1 AS class_id
    FROM (SELECT DISTINCT o_orderpriority FROM orders))
    SELECT o_orderkey, o_orderpriority, class_id FROM orders JOIN c USING (o_orderpriority)""",
)
def _encode(spark, sf_dir):
    return encode_labels(table(spark, sf_dir, "orders"), "o_orderpriority").select(
        "o_orderkey", "o_orderpriority", "class_id"
    )


@register(
    "label_decode",
    "SELECT event_type AS decoded, count(*) AS n FROM events GROUP BY 1",
)
def _decode(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    classes = label_classes(events, "event_type")
    encoded = encode_labels(events, "event_type", classes).select("event_id", "class_id")
    decoded = decode_labels(encoded, classes, "event_type")
    return decoded.groupBy(F.col("event_type").alias("decoded")).agg(F.count(F.lit(1)).alias("n"))


@register(
    "scale_pos_weight",
    """SELECT count(*) FILTER (toxic = 0) AS n_neg, count(*) FILTER (toxic = 1) AS n_pos,
    round(count(*) FILTER (toxic = 0) / greatest(count(*) FILTER (toxic = 1), 1), 9) AS scale_pos_weight FROM labels""",
)
def _spw(spark, sf_dir):
    out = scale_pos_weight(table(spark, sf_dir, "labels"), "toxic")
    return out.withColumn("scale_pos_weight", F.round("scale_pos_weight", 9))


@register(
    "balanced_weights",
    """SELECT l_returnflag, count(*) AS n, round(sum(count(*)) OVER () / (count(*) OVER () * count(*)), 9) AS weight
    FROM lineitem GROUP BY l_returnflag""",
)
def _balanced(spark, sf_dir):
    return balanced_weights(table(spark, sf_dir, "lineitem"), "l_returnflag").withColumn("weight", F.round("weight", 9))


@register(
    "weighted_rows",
    """WITH s AS (SELECT count(*) FILTER (toxic = 0) / greatest(count(*) FILTER (toxic = 1), 1) AS spw, count(*) AS n FROM labels),
    q AS (SELECT quality, count(*) AS c FROM labels GROUP BY quality), k AS (SELECT count(*) AS k FROM q)
    SELECT doc_id, round(CASE WHEN toxic = 1 THEN spw ELSE 1.0 END, 9) AS pos_weight, round(n / (k * c), 9) AS class_weight
    FROM labels JOIN q USING (quality), s, k""",
)
def _weighted(spark, sf_dir):
    rows = with_positive_weight(table(spark, sf_dir, "labels"), "toxic", "pos_weight")
    rows = with_balanced_weight(rows, "quality", "class_weight")
    return rows.select("doc_id", F.round("pos_weight", 9).alias("pos_weight"), F.round("class_weight", 9).alias("class_weight"))


_SCORE_SQL = "n_chars / (n_chars + 1000.0)"


@register(
    "threshold_prediction",
    f"SELECT doc_id, CAST({_SCORE_SQL} >= 0.5 AS INTEGER) AS predicted FROM documents",
)
def _threshold(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", threshold_prediction(F.col("n_chars") / (F.col("n_chars") + F.lit(1000.0))).alias("predicted"))


@register(
    "stratified_split",
    """WITH c AS (SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1),
    t AS (SELECT *, sum(n) OVER () AS total, sum(n) OVER () - ceil(sum(n) OVER () * 0.2::DOUBLE) AS n_train FROM c),
    e AS (SELECT *, n * n_train / total AS exact, floor(n * n_train / total) AS base FROM t),
    q AS (SELECT o_orderstatus, base + CASE WHEN row_number() OVER (ORDER BY exact - base DESC, o_orderstatus)
            <= n_train - sum(base) OVER () THEN 1 ELSE 0 END AS quota FROM e),
    r AS (SELECT o_orderkey, o_orderstatus, row_number() OVER (PARTITION BY o_orderstatus ORDER BY md5(o_orderkey || '|42')) AS rn FROM orders)
    SELECT o_orderkey, o_orderstatus, CASE WHEN rn <= quota THEN 'train' ELSE 'test' END AS split
    FROM r JOIN q USING (o_orderstatus)""",
)
def _split(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return stratified_split(orders, ["o_orderkey"], "o_orderstatus", 0.2, 42)


@register(
    "stratified_folds",
    """WITH r AS (SELECT event_id, event_type, row_number() OVER (PARTITION BY event_type ORDER BY md5(event_id || '|42')) AS rn FROM events),
    c AS (SELECT event_type, count(*) AS n, coalesce(sum(count(*)) OVER (ORDER BY event_type ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
          FROM events GROUP BY event_type),
    p AS (SELECT event_type, i, count(*) AS size FROM c, range(5) f(i), LATERAL (SELECT unnest(range(CAST(start AS BIGINT), CAST(start + n AS BIGINT))) AS pos) x
          WHERE pos % 5 = i GROUP BY event_type, i),
    cut AS (SELECT event_type, i, sum(size) OVER (PARTITION BY event_type ORDER BY i) AS upto FROM p)
    SELECT event_id, event_type, CAST((SELECT count(*) FROM cut WHERE cut.event_type = r.event_type AND cut.upto < r.rn) AS INTEGER) AS fold FROM r""",
)
def _folds(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "event_type")
    return stratified_folds(events, ["event_id"], "event_type", 5, 42)


@register("mock_predictions", f"SELECT event_id, round({beta_sql('event_id', 42)}, 9) AS pred_readmit FROM events")
def _mock(spark, sf_dir):
    rows = mock_predictions(table(spark, sf_dir, "events").select("event_id"), ["event_id"], 42)
    return rows.withColumn("pred_readmit", F.round("pred_readmit", 9))
