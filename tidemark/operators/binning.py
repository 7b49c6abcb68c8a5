"""Columns cut into bins once, so that tree learners handle small integers only.

A numeric column has bins between quantile cuts and one for missing values. A category column has one bin per category,
in ascending order with a missing value last, and one for categories that were not fitted. Each category but the first
counts as a feature of its own, as in a one-hot encoding without its first column.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .columns import categorical_columns, drop_targets, field, numeric_columns
from .ordering import held, running_totals
from .preprocess import MISSING, MISSING_NAME, category_key, category_lists
from .tagging import lenient_double

MAX_BINS = 256


@dataclass(frozen=True)
class Binning:
    """Cuts of every numeric column, categories of every category column, and the order of both.

    ``vector`` names a vector column whose elements are the numeric columns; ``cuts`` then has one entry per element."""

    cuts: dict[str, list[float]]
    categories: dict[str, list[str]]
    vector: str | None = None

    @cached_property
    def names(self) -> list[str]:
        out = list(self.cuts)
        for c, cats in self.categories.items():
            out += [f"{c}_{MISSING_NAME if cat == MISSING else cat}" for cat in cats[1:]]
        return out

    @cached_property
    def layout(self) -> Layout:
        return Layout([len(c) for c in self.cuts.values()], [len(c) for c in self.categories.values()])

    def projected(self, df: DataFrame) -> list[Column]:
        """Raw values as ``codes`` reads them: doubles (or one array of them), then category keys."""
        if self.vector:
            kind = df.schema[self.vector].dataType.simpleString()
            values = field(self.vector) if kind.startswith("array") else vector_to_array(self.vector)
            numeric = [values.cast("array<double>").alias("v")]
        else:
            numeric = [lenient_double(df, c).alias(f"n{i}") for i, c in enumerate(self.cuts)]
        return numeric + [category_key(field(c)).alias(f"c{i}") for i, c in enumerate(self.categories)]

    def codes(self, columns: list[pa.Array]) -> np.ndarray:
        """(rows, columns) bins of projected values."""
        rows = len(columns[0]) if columns else 0
        out = np.empty((rows, len(self.cuts) + len(self.categories)), np.int32)
        if self.vector:
            values = columns[0].flatten().to_numpy(zero_copy_only=False).reshape(rows, len(self.cuts)).T
            columns = columns[1:]
        else:
            values = [c.cast(pa.float64()).to_numpy(zero_copy_only=False) for c in columns[:len(self.cuts)]]
            columns = columns[len(self.cuts):]
        for i, (cuts, v) in enumerate(zip(self.cuts.values(), values)):
            v = np.asarray(v, np.float64)
            out[:, i] = np.where(np.isnan(v), len(cuts) + 1, np.searchsorted(np.asarray(cuts), v, side="right"))
        for i, (cats, c) in enumerate(zip(self.categories.values(), columns), start=len(self.cuts)):
            out[:, i] = pc.index_in(c.cast(pa.string()), pa.array(cats, pa.string())).fill_null(len(cats)).to_numpy()
        return out


class Layout:
    """Where the bins of each column lie in one row of cells, and which feature a cell belongs to (-1: none)."""

    def __init__(self, cuts: list[int], categories: list[int]):
        widths = [n + 2 for n in cuts] + [n + 1 for n in categories]
        self.offsets = np.concatenate([[0], np.cumsum(widths)]).astype(np.int64)
        self.columns, self.cells = len(widths), int(self.offsets[-1])
        self.column = np.repeat(np.arange(self.columns), widths)
        self.code = np.arange(self.cells) - self.offsets[self.column]
        self.is_category = np.arange(self.columns) >= len(cuts)
        self.last = np.array(widths, np.int64) - 1  # the bin of missing values, or of unknown categories
        self.feature = np.where(self.is_category[self.column], -1, self.column)
        at = len(cuts)
        for i, n in enumerate(categories, start=len(cuts)):
            first = int(self.offsets[i])
            self.feature[first + 1:first + n] = np.arange(at, at + max(n - 1, 0))
            at += max(n - 1, 0)
        self.features = at


def _cuts(values: DataFrame, parts: int) -> dict[int, list[float]]:
    """The distinct values at ranks i / parts of each ``pos``: order statistics of (pos, value) rows, not a sketch's."""
    counts = values.where(F.col("value").isNotNull() & ~F.isnan("value")).groupBy("pos", "value").agg(F.count(F.lit(1)).alias("n"))
    with held(counts) as counts:
        run = running_totals(counts, ["pos"], "value", ["n"])
        wanted = run.where(f"least({parts} * cum_n div tot_n, {parts - 1}) > {parts} * (cum_n - n) div tot_n")
        found: dict[int, list[float]] = {}
        for r in wanted.select("pos", "value").collect():  # less than ``parts`` rows per column
            found.setdefault(r["pos"], []).append(r["value"])
    return {pos: sorted(own) for pos, own in found.items()}


def fit_binning(df: DataFrame, exclude: tuple[str, ...] = (), max_bins: int = MAX_BINS, vector: str | None = None,
                names: list[str] | None = None) -> Binning:
    """Cuts and categories of ``df``: of all its columns but targets and ``exclude``, or of one vector column.

    Cuts are values of the column at even ranks, so a column of few values is cut at each of them."""
    if vector:
        values = Binning({}, {}, vector).projected(df)[0]
        found = _cuts(df.select(F.posexplode(values).alias("pos", "value")), max_bins)
        width = df.select(F.max(F.size(values))).first()[0] or 0
        names = names or [f"feature_{i}" for i in range(width)]
        return Binning({n: found.get(i, []) for i, n in enumerate(names)}, {}, vector)
    features = drop_targets(df).drop(*exclude)
    numeric, categorical = numeric_columns(features), categorical_columns(features)
    found = {}
    if numeric:
        values = F.array(*[lenient_double(features, c) for c in numeric])
        found = _cuts(features.select(F.posexplode(values).alias("pos", "value")), max_bins)
    return Binning({c: found.get(i, []) for i, c in enumerate(numeric)}, category_lists(features, categorical))
