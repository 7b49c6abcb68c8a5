"""Payload, text and conversion queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import option_list, uri_to_path, utc_stamp
from ..operators.tagging import lenient_double
from ..sources.payloads import attach_predictions, keyed_predictions, length_check, normalised_scores, parse_payloads, rejected_payloads
from ..sources.people import greeting_line
from ..sources.tables import normalise_missing
from .registry import register, table


def payload_rows(spark, sf_dir):
    """One JSON payload per order, its shape chosen by order priority."""
    o = table(spark, sf_dir, "orders")
    a = F.col("o_totalprice").cast("string")
    b = F.col("o_custkey").cast("string")
    shape = F.substring("o_orderpriority", 1, 1)
    payload = (
        F.when(shape == "1", F.concat(F.lit("["), a, F.lit(", "), b, F.lit("]")))
        .when(shape == "2", F.concat(F.lit(' {"predictions": [['), a, F.lit("], ["), b, F.lit("]]}")))
        .when(shape == "3", F.concat(F.lit('[{"score": '), a, F.lit(', "label": "x"}, {"score": "'), b, F.lit('"}]')))
        .when(shape == "4", F.concat(F.lit('["'), F.col("o_orderstatus"), F.lit('", "F"]')))
        .otherwise(F.concat(F.lit("error for "), b))
    )
    return o.select("o_orderkey", payload.alias("payload"))


def _parsed(spark, sf_dir):
    return parse_payloads(payload_rows(spark, sf_dir), "o_orderkey", "payload", positive_class="F")


_VALUE_SQL = """SELECT o_orderkey, CAST(0 AS INTEGER) AS position, CASE WHEN o_orderpriority LIKE '4%' THEN CASE WHEN o_orderstatus = 'F' THEN 1.0 ELSE 0.0 END ELSE o_totalprice END AS score
  FROM orders WHERE o_orderpriority NOT LIKE '5%'
  UNION ALL SELECT o_orderkey, 1, CASE WHEN o_orderpriority LIKE '4%' THEN 1.0 ELSE CAST(o_custkey AS DOUBLE) END FROM orders WHERE o_orderpriority NOT LIKE '5%'"""


@register("payload_normalize", f"SELECT o_orderkey, position, CAST(round(score, 6) AS DOUBLE) AS score FROM ({_VALUE_SQL})")
def _normalise(spark, sf_dir):
    return normalised_scores(_parsed(spark, sf_dir), "o_orderkey").withColumn("score", F.round("score", 6))


@register(
    "payload_rejects",
    "SELECT o_orderkey, 'non-JSON text: error for ' || o_custkey AS error FROM orders WHERE o_orderpriority LIKE '5%'",
)
def _rejects(spark, sf_dir):
    return rejected_payloads(_parsed(spark, sf_dir), "o_orderkey")


_KEY_OF = "CASE o_orderkey % 5 WHEN 0 THEN 'pred_proba' WHEN 1 THEN 'probability' WHEN 2 THEN 'score' WHEN 3 THEN 'YES' ELSE '1' END"


def keyed_payloads(spark, sf_dir):
    """Two elements per order under one of the five keys; of some the second lacks it, of some they are lists or labels."""
    o = table(spark, sf_dir, "orders")
    key, kind = F.expr(_KEY_OF), F.col("o_custkey") % 4
    price, cust = F.col("o_totalprice").cast("string"), F.col("o_custkey").cast("string")
    element = lambda k, v: F.concat(F.lit('{"'), k, F.lit('": '), v, F.lit(', "other": 1}'))
    wrap = lambda v: F.concat(F.lit("["), v, F.lit("]"))
    text = lambda v: F.concat(F.lit('"'), v, F.lit('"'))
    body = (
        F.when(kind == 0, F.concat_ws(", ", element(key, price), element(key, cust)))
        .when(kind == 1, F.concat_ws(", ", element(key, price), element(F.lit("unknown"), cust)))
        .when(kind == 2, F.concat_ws(", ", element(key, wrap(price)), element(key, wrap(cust))))
        .otherwise(F.concat_ws(", ", element(key, text(F.col("o_orderstatus"))), element(key, text(F.lit("F")))))
    )
    return o.select("o_orderkey", F.concat(F.lit('{"predictions": ['), body, F.lit("]}")).alias("payload"))


@register(
    "payload_keys",
    """SELECT o_orderkey, CAST(0 AS INTEGER) AS position, CASE WHEN o_custkey % 4 = 3 THEN CASE WHEN o_orderstatus = 'F' THEN 1.0 ELSE 0.0 END ELSE o_totalprice END AS score
    FROM orders WHERE o_custkey % 4 <> 1
    UNION ALL SELECT o_orderkey, 1, CASE WHEN o_custkey % 4 = 3 THEN 1.0 ELSE CAST(o_custkey AS DOUBLE) END FROM orders WHERE o_custkey % 4 <> 1""",
)
def _keys(spark, sf_dir):
    parsed = parse_payloads(keyed_payloads(spark, sf_dir), "o_orderkey", "payload", positive_class="F")
    return normalised_scores(parsed, "o_orderkey")


@register(
    "payload_key_rejects",
    "SELECT o_orderkey, 'an element lacks the score key' AS error FROM orders WHERE o_custkey % 4 = 1",
)
def _key_rejects(spark, sf_dir):
    parsed = parse_payloads(keyed_payloads(spark, sf_dir), "o_orderkey", "payload", positive_class="F")
    return rejected_payloads(parsed, "o_orderkey")


@register("payload_attached", "SELECT event_id, event_type, value * 2 AS pred FROM events")
def _attached(spark, sf_dir):
    """One answer for every ten events, scores by position, attached by event."""
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "value", F.floor(F.col("event_id") / 10).alias("request"))
    sent = events.groupBy("request").agg(F.array_sort(F.collect_list(F.struct("event_id", "value"))).alias("rows"))
    answers = sent.select("request", F.to_json(F.transform("rows", lambda r: r["value"] * 2)).alias("payload"))
    scores = normalised_scores(parse_payloads(answers, "request", "payload"), "request")
    places = sent.select("request", F.posexplode("rows.event_id").alias("position", "event_id"))
    keyed = keyed_predictions(places, scores, "event_id", "request")
    return attach_predictions(events.select("event_id", "event_type"), keyed, "event_id", "pred")


@register("attach_predictions", "SELECT event_id, event_type, value * 2 AS pred FROM events")
def _attach(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "event_type")
    scores = table(spark, sf_dir, "events").select("event_id", (F.col("value") * 2).alias("score"))
    return attach_predictions(events, scores, "event_id", "pred")


@register(
    "length_check",
    "SELECT (SELECT count(*) FROM documents) AS n_rows, (SELECT count(*) FROM labels) AS n_predictions, "
    "(SELECT count(*) FROM documents) = (SELECT count(*) FROM labels) AS matches",
)
def _length(spark, sf_dir):
    return length_check(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register(
    "people_fanout",
    """SELECT conv_id, turn, name, name || ' is currently in space flying on the ' || role || '! Hello! :)' AS message
    FROM (SELECT conv_id, turn, role, unnest(string_split(text, ' ')) AS name FROM conversations)""",
)
def _fanout(spark, sf_dir):
    """Every word of a turn as a list entry: explode, then one message each."""
    rows = table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", "role", F.explode(F.split("text", " ")).alias("name")
    )
    return rows.select("conv_id", "turn", "name", greeting_line(F.col("name"), F.col("role")).alias("message"))


_SPACES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


@register(
    "option_sets",
    f"""SELECT doc_id, CAST(len(s) AS INTEGER) AS n_options, md5(array_to_string(s, '|')) AS digest FROM (
    SELECT doc_id, list_sort(list_distinct(list_filter(list_transform(string_split(text, ','), lambda x: trim(x, {_SPACES})), lambda x: x <> ''))) AS s
    FROM documents)""",
)
def _options(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", option_list(F.col("text")).alias("s"))
    return rows.select("doc_id", F.size("s").alias("n_options"), F.md5(F.array_join("s", "|")).alias("digest"))


_PREFIXED = "CASE page_id % 4 WHEN 0 THEN 'file:///' || url WHEN 1 THEN 'file://' || url WHEN 2 THEN 'file:/' || url ELSE url END"


@register(
    "uri_paths",
    """SELECT page_id, CASE page_id % 4 WHEN 0 THEN '/' || url WHEN 1 THEN '/' || url WHEN 2 THEN '/' || url ELSE url END AS path FROM pages""",
)
def _paths(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", uri_to_path(F.expr(_PREFIXED)).alias("path"))


@register("utc_stamps", "SELECT event_id, strftime(ts, '%Y%m%dT%H%M%SZ') AS stamp FROM events")
def _stamps(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", utc_stamp(F.col("ts")).alias("stamp"))


@register(
    "lenient_cast",
    "SELECT event_id, TRY_CAST(regexp_extract(props, ': (.*)}', 1) AS DOUBLE) AS k, TRY_CAST(event_type AS DOUBLE) AS t FROM events",
)
def _cast(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select(
        "event_id", F.get_json_object("props", "$.k").alias("k"), F.col("event_type").alias("t")
    )
    return rows.select("event_id", lenient_double(rows, "k").alias("k"), lenient_double(rows, "t").alias("t"))


@register(
    "missing_tokens",
    """SELECT n_name, count(*) AS n, count(v) AS n_known FROM (
      SELECT n_name, CASE WHEN c_mktsegment = 'BUILDING' THEN NULL WHEN c_mktsegment = 'MACHINERY' THEN '?' ELSE c_mktsegment END AS v
      FROM customer JOIN nation ON c_nationkey = n_nationkey) GROUP BY n_name""",
)
def _missing(spark, sf_dir):
    """A null token becomes NULL, "?" stays a category."""
    segment = F.col("c_mktsegment")
    rows = table(spark, sf_dir, "customer").select(
        "c_nationkey", F.when(segment == "BUILDING", "None").when(segment == "MACHINERY", "?").otherwise(segment).alias("v")
    )
    named = normalise_missing(rows).join(
        table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    return named.groupBy("n_name").agg(F.count(F.lit(1)).alias("n"), F.count("v").alias("n_known"))


@register("row_preview", "SELECT * FROM orders ORDER BY o_orderkey LIMIT 3")
def _preview(spark, sf_dir):
    return table(spark, sf_dir, "orders").orderBy("o_orderkey").limit(3)
