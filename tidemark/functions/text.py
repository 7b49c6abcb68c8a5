"""String, JSON-text and formatting expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def option_set(text: str | None) -> set[str]:
    """``"a, b,,c"`` -> ``{"a", "b", "c"}``."""
    return {part.strip() for part in (text or "").split(",") if part.strip()}


def stripped(column: Column) -> Column:
    """Without leading and trailing white space, line ends included."""
    return F.btrim(column, F.lit(" \t\n\x0b\x0c\r"))


def option_list(column: Column) -> Column:
    """The same split on a column: trimmed, non-empty, distinct, sorted."""
    parts = F.transform(F.split(column, ","), stripped)
    return F.array_sort(F.array_distinct(F.filter(parts, lambda s: s != "")))


def uri_to_path(uri: Column) -> Column:
    """Local path of a ``file:`` URI; anything else is returned unchanged.

    ``file:///a`` -> ``/a``, ``file://h/a`` -> ``/h/a``, ``file:/a`` -> ``/a``.
    """
    rest = F.substr(uri, F.lit(8))
    return (
        F.when(uri.isNull(), F.lit(""))
        .when(uri.startswith("file:///"), rest)
        .when(uri.startswith("file://"), F.concat(F.lit("/"), rest))
        .when(uri.startswith("file:"), F.substr(uri, F.lit(6)))
        .otherwise(uri)
    )


def utc_stamp(ts: Column) -> Column:
    """``20240131T235959Z`` of a UTC wall-clock time."""
    return F.date_format(ts, "yyyyMMdd'T'HHmmss'Z'")


def head_of(text: Column, n: int = 200) -> Column:
    """The first ``n`` characters, used inside error messages only."""
    return F.substring(text, 1, n)


def label_to_score(label: Column, positive: str) -> Column:
    return F.when(label == positive, 1.0).otherwise(0.0)
