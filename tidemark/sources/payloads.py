"""Prediction payloads: JSON text in several shapes to one score per element.

Everything happens inside a row with VARIANT and array functions; only the
final one-row-per-element explode widens the data and nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import head_of, label_to_score, stripped

# Keys looked for in dictionary elements, in this order.
SCORE_KEYS = ("pred_proba", "probability", "score", "YES", "1")

_NUMBER_TYPES = ("BIGINT", "DOUBLE", "FLOAT", "BOOLEAN")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Binds ``value`` once for ``body``.

    The stages of the parse each use the one before several times. Written as
    chained columns, a pushed-down filter would copy every stage into the next.
    """
    return F.get(F.transform(F.array(value), lambda v: body(v)), F.lit(0))


def _no_scores() -> Column:
    return F.lit(None).cast("array<double>").alias("scores")


def _kind(v: Column) -> Column:
    """number, text, list, object or other (JSON null included)."""
    return _let(
        F.schema_of_variant(v),
        lambda t: F.when(t.startswith("OBJECT"), "object")
        .when(t.startswith("ARRAY"), "list")
        .when(t == "STRING", "text")
        .when(t.isin(*_NUMBER_TYPES) | t.startswith("DECIMAL"), "number")
        .otherwise("other"),
    )


def _to_double(v: Column) -> Column:
    """Number or numeric text as a double, booleans as 1 and 0, else NULL."""
    as_bool = F.try_variant_get(v, "$", "boolean").cast("double")
    as_number = F.try_variant_get(v, "$", "string").try_cast("double")
    return F.coalesce(as_number, F.when(F.schema_of_variant(v) == "BOOLEAN", as_bool))


def _member(key: str) -> Callable[[Column], Column]:
    return lambda v: F.try_variant_get(v, f"$['{key}']", "variant")


def _first(v: Column) -> Column:
    return F.try_variant_get(v, "$[0]", "variant")


def _scores(vals: Column, first: Column, positive: str | None) -> Column:
    """Numbers if all are numeric, else labels where the shape allows them."""
    if positive is None:
        labels = F.lit(None).cast("array<double>")
    else:
        labels = F.transform(
            vals, lambda v: F.coalesce(label_to_score(F.try_variant_get(v, "$", "string"), positive), F.lit(0.0))
        )
    return _let(
        F.transform(vals, _to_double),
        lambda numbers: F.when((first != "text") & F.forall(numbers, lambda x: x.isNotNull()), numbers)
        .when(first.isin("text", "object"), labels),
    )


def _list_result(items: Column, keys: tuple[str, ...], positive: str | None) -> Column:
    """struct(scores, error) of a JSON list; its first element decides the shape."""

    def result(vals: Column, first: Column, error: str) -> Column:
        return _let(
            _scores(vals, first, positive),
            lambda s: F.struct(s.alias("scores"), F.when(s.isNull(), error).alias("error")),
        )

    def of_objects(head: Column) -> Column:
        # The first key present in the first element, for all elements; one without it spoils the payload.
        members = F.lit(None).cast("array<variant>")
        for key in reversed(keys):
            members = F.when(_member(key)(head).isNotNull(), F.transform(items, _member(key))).otherwise(members)
        rejected = lambda why: F.struct(_no_scores(), F.lit(why).alias("error"))

        def of_members(vs: Column) -> Column:
            unwrapped = F.when(_first(F.get(vs, F.lit(0))).isNotNull(), F.transform(vs, _first)).otherwise(vs)
            found = _let(unwrapped, lambda u: result(
                u, F.lit("object"), "values are not numeric; a positive class is needed"))
            return F.when(vs.isNull(), rejected("no score key in elements")).when(
                F.exists(vs, lambda v: v.isNull()), rejected("an element lacks the score key")).otherwise(found)

        return _let(members, of_members)

    def of_head(head: Column) -> Column:
        return _let(
            _kind(head),
            lambda kind: F.when(kind == "number", result(items, kind, "unsupported element type"))
            .when(kind == "list", result(F.transform(items, _first), kind, "unsupported element type"))
            .when(kind == "text", result(items, kind, "string labels need a positive class"))
            .when(kind == "object", of_objects(head))
            .otherwise(F.struct(_no_scores(), F.lit("unsupported element type").alias("error"))),
        )

    empty = F.struct(
        F.array().cast("array<double>").alias("scores"), F.lit(None).cast("string").alias("error")
    )
    return F.when(F.size(items) == 0, empty).otherwise(_let(F.get(items, F.lit(0)), of_head))


def parse_payloads(
    df: DataFrame, id_col: str, payload_col: str, pred_key: str | None = None, positive_class: str | None = None
) -> DataFrame:
    """(id, scores array<double>, error): exactly one of the last two is NULL."""
    keys = (pred_key,) if pred_key else SCORE_KEYS

    def of_json(raw: Column, json: Column) -> Column:
        not_json = F.concat(F.lit("non-JSON text: "), F.coalesce(head_of(raw), F.lit("")))
        # A path or a cast that does not fit the value gives NULL, so neither
        # step needs to ask for the type first.
        body = F.coalesce(F.try_variant_get(json, "$.predictions", "variant"), json)
        listed = _let(
            F.try_variant_get(body, "$", "array<variant>"),
            lambda items: F.when(items.isNotNull(), _list_result(items, keys, positive_class)).otherwise(
                F.struct(_no_scores(), F.lit("unsupported payload type").alias("error"))
            ),
        )
        return F.when(json.isNull(), F.struct(_no_scores(), not_json.alias("error"))).otherwise(listed)

    parsed = _let(
        stripped(F.col(payload_col)), lambda raw: _let(F.try_parse_json(raw), lambda json: of_json(raw, json))
    )
    return df.select(id_col, parsed.alias("_parsed")).select(id_col, "_parsed.scores", "_parsed.error")


def normalised_scores(parsed: DataFrame, id_col: str) -> DataFrame:
    """(id, position, score) for every element of every good payload.

    The outer explode keeps Spark from deriving a filter on ``scores`` and
    pushing a second and third copy of the parse below it.
    """
    rows = parsed.select(id_col, F.posexplode_outer("scores").alias("position", "score"))
    return rows.where(F.col("position").isNotNull())


def rejected_payloads(parsed: DataFrame, id_col: str) -> DataFrame:
    return parsed.where(F.col("error").isNotNull()).select(id_col, "error")


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """(source, payload, path): one stored answer per file, taken whole."""
    files = spark.read.text(path, wholetext=True)
    return files.select(F.col("_metadata.file_name").alias("source"), F.col("value").alias("payload"),
                        F.col("_metadata.file_path").alias("path"))


def attach_predictions(df: DataFrame, predictions: DataFrame, on: str, pred_col: str) -> DataFrame:
    """Adds scores by row key after checking that both sides have the same keys, each once."""
    rows = df.groupBy(on).agg(F.count(F.lit(1)).alias("_rows"))
    scored = predictions.groupBy(on).agg(F.count(F.lit(1)).alias("_preds"))
    n_rows, n_preds, odd = rows.join(scored, on, "full").agg(
        F.sum("_rows"), F.sum("_preds"),
        F.count_if((F.coalesce("_rows", F.lit(0)) != 1) | (F.coalesce("_preds", F.lit(0)) != 1))).first()
    if (n_rows or 0) != (n_preds or 0):
        raise ValueError(f"prediction length {n_preds or 0} != number of rows {n_rows or 0}")
    if odd:
        raise ValueError(f"{odd} keys are missing or repeated among rows or predictions")
    return df.join(predictions.select(on, F.col("score").alias(pred_col)), on, "left")


def keyed_predictions(rows: DataFrame, scores: DataFrame, on: str, group: str, position: str = "position") -> DataFrame:
    """(on, score): scores by position joined to the keys of the rows they answer.

    ``rows`` holds (group, position, on): which row of which payload a key was sent as.
    """
    return rows.select(group, position, on).join(scores.select(group, position, "score"), [group, position]).select(on, "score")


def length_check(df: DataFrame, predictions: DataFrame) -> DataFrame:
    """(n_rows, n_predictions, matches) as a table."""
    left = df.agg(F.count(F.lit(1)).alias("n_rows"))
    right = predictions.agg(F.count(F.lit(1)).alias("n_predictions"))
    return left.crossJoin(right).withColumn("matches", F.col("n_rows") == F.col("n_predictions"))
