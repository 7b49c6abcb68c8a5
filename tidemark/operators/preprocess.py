"""Scaling and one-hot encoding fitted on one table and applied to any other."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexerModel, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .columns import categorical_columns, drop_targets, field, numeric_columns, quoted
from .ordering import distinct_rank, join_small
from .tagging import lenient_double

# Stands for a missing category; sorts after every other string.
MISSING = "\U0010ffff"
MISSING_NAME = "nan"
EPSILON = 2.220446049250313e-16


def _usable_scale(variance: Column, mean: Column, n: Column) -> Column:
    """Population deviation, or 1 where the column is constant up to rounding."""
    noise = n * EPSILON * variance + (n * mean * EPSILON) * (n * mean * EPSILON)
    return F.when(variance <= noise, 1.0).otherwise(F.sqrt(variance))


def scaler_stats(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, mean, std, scale) in one pass over the table.

    ``std`` is the population deviation; ``scale`` is what values are divided by.
    """
    structs = []
    for c in columns:
        v = lenient_double(df, c)
        structs.append(
            F.struct(F.lit(c).alias("column"), F.avg(v).alias("mean"), F.var_pop(v).alias("var"), F.count(v).alias("n"))
        )
    long = df.agg(F.array(*structs).alias("s")).select(F.explode("s").alias("s")).select("s.*")
    return long.select(
        "column", "mean", F.sqrt("var").alias("std"), _usable_scale(F.col("var"), F.col("mean"), F.col("n")).alias("scale")
    )


def category_key(column: Column) -> Column:
    return F.coalesce(column.cast("string"), F.lit(MISSING))


def category_table(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, category, rank): distinct categories in ascending order from 0.

    A missing value is a category of its own and comes last. Distinct values
    are found with map-side combine and ranked without a per-column task.
    """
    wide = df.select(*[category_key(field(c)).alias(c) for c in columns])
    distinct = wide.unpivot([], [field(c) for c in columns], "column", "category").distinct()
    return distinct_rank(distinct, ["column"], "category")


@dataclass(frozen=True)
class Preprocessor:
    """Fitted state: numeric block first, then one block per category column.

    Holds one entry per column and per category, the width of the encoded
    matrix, which any model trained on it must hold as well.
    """

    numeric: dict[str, tuple[float, float]]
    categories: dict[str, list[str]]

    @property
    def feature_names(self) -> list[str]:
        """Numeric columns keep their name, categories become ``column_category``."""
        names = list(self.numeric)
        for c, cats in self.categories.items():
            names += [f"{c}_{MISSING_NAME if cat == MISSING else cat}" for cat in cats[1:]]
        return names

    @property
    def generic_names(self) -> list[str]:
        return [f"feature_{i}" for i in range(len(self.feature_names))]

    def scaled(self, df: DataFrame, column: str) -> Column:
        mean, scale = self.numeric[column]
        return (lenient_double(df, column) - F.lit(mean)) / F.lit(scale)

    def standardise(self, df: DataFrame) -> DataFrame:
        """Replaces each fitted numeric column by its scaled value; a projection."""
        return df.withColumns({c: self.scaled(df, c) for c in self.numeric})

    def encoded_frame(self, df: DataFrame, generic: bool = False) -> DataFrame:
        """The wide encoded frame: one double column per feature; a projection."""
        cols = [self.scaled(df, c) for c in self.numeric]
        for c, cats in self.categories.items():
            key = category_key(field(c))
            cols += [F.when(key == cat, 1.0).otherwise(0.0) for cat in cats[1:]]
        names = self.generic_names if generic else self.feature_names
        return df.select(*[col.alias(n) for col, n in zip(cols, names)])

    def pipeline_model(self, df: DataFrame, output: str = "features") -> PipelineModel:
        """The same encoding as a saveable ML pipeline with sparse vectors.

        The indexer's labels leave out the first category. That category and
        unseen ones share the indexer's extra bucket, which the encoder drops,
        so both encode as zeros.
        """
        exprs, assembled = ["*"], []
        for c in self.numeric:
            mean, scale = self.numeric[c]
            exprs.append(f"(CAST({quoted(c)} AS DOUBLE) - {mean!r}D) / {scale!r}D AS {quoted('_scaled_' + c)}")
            assembled.append("_scaled_" + c)
        encoded = {c: cats for c, cats in self.categories.items() if len(cats) > 1}
        for c in encoded:
            exprs.append(f"coalesce(CAST({quoted(c)} AS STRING), '{MISSING}') AS {quoted('_cat_' + c)}")
        stages = [SQLTransformer(statement=f"SELECT {', '.join(exprs)} FROM __THIS__")]
        if encoded:
            # Columns with equally many labels share a stage: the label table
            # of one indexer must be rectangular.
            by_size: dict[int, list[str]] = {}
            for c, cats in encoded.items():
                by_size.setdefault(len(cats), []).append(c)
            indexers = [
                StringIndexerModel.from_arrays_of_labels(
                    [encoded[c][1:] for c in group],
                    inputCols=["_cat_" + c for c in group],
                    outputCols=["_idx_" + c for c in group],
                    handleInvalid="keep",
                )
                for group in by_size.values()
            ]
            encoder = OneHotEncoder(
                inputCols=["_idx_" + c for c in encoded], outputCols=["_hot_" + c for c in encoded], dropLast=True
            )
            # Sizes come from the indexers' column metadata; no data is read.
            sample = PipelineModel([*stages, *indexers]).transform(df.limit(0))
            stages += [*indexers, encoder.fit(sample)]
            assembled += ["_hot_" + c for c in encoded]
        stages.append(VectorAssembler(inputCols=assembled, outputCol=output, handleInvalid="keep"))
        return PipelineModel(stages)


def category_lists(df: DataFrame, columns: list[str], max_categories: int = 1_000_000) -> dict[str, list[str]]:
    """Categories of each column in ascending order (of UTF-8 bytes, as Spark sorts), collected up to a bound."""
    found: dict[str, list[str]] = {c: [] for c in columns}
    if columns:
        wide = df.select(*[category_key(field(c)).alias(c) for c in columns])
        distinct = wide.unpivot([], [field(c) for c in columns], "column", "category").distinct()
        rows = distinct.limit(max_categories + 1).toArrow()
        if rows.num_rows > max_categories:
            raise ValueError(f"more than {max_categories} categories: they stay in a table, see encoding.fit_encoder")
        for c, cat in zip(rows.column("column").to_pylist(), rows.column("category").to_pylist()):
            found[c].append(cat)
    return {c: sorted(cats, key=lambda s: s.encode()) for c, cats in found.items()}


def fit_preprocessor(
    df: DataFrame, exclude: tuple[str, ...] = (), max_categories: int = 1_000_000
) -> Preprocessor:
    """Fits on ``df`` with target columns removed.

    The category list is collected, so it is size-checked; past the bound use
    ``encoding.fit_encoder``, whose state is a table.
    """
    features = drop_targets(df).drop(*exclude)
    numeric, categorical = numeric_columns(features), categorical_columns(features)
    stats = {}
    if numeric:
        for r in scaler_stats(features, numeric).collect():
            stats[r["column"]] = (r["mean"] if r["mean"] is not None else 0.0, r["scale"] if r["scale"] is not None else 1.0)
    return Preprocessor({c: stats[c] for c in numeric}, category_lists(features, categorical, max_categories))


def consistent_standardise(ref: DataFrame, cur: DataFrame, columns: list[str]) -> tuple[DataFrame, DataFrame]:
    """Scales both tables with the baseline's mean and deviation."""
    stats = {r["column"]: (r["mean"], r["scale"]) for r in scaler_stats(ref, columns).collect()}
    fitted = Preprocessor(stats, {})
    return fitted.standardise(ref), fitted.standardise(cur)


def one_hot_slots(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, category, rank, slot): position of each kept category.

    Slots run over the columns in the given order; the first category of each
    column has no slot.
    """
    table = category_table(df, columns)
    widths = table.groupBy("column").agg((F.count(F.lit(1)) - 1).alias("_width"))
    order = df.sparkSession.createDataFrame([(c, i) for i, c in enumerate(columns)], "column string, _pos int")
    known = {r["column"]: r["_width"] for r in widths.collect()}  # one row per column
    offsets, at = [], 0
    for c in columns:
        offsets.append((c, at))
        at += max(known.get(c, 0), 0)
    starts = df.sparkSession.createDataFrame(offsets, "column string, _start long")
    return (
        table.join(F.broadcast(starts), "column")
        .select("column", "category", "rank", F.when(F.col("rank") > 0, F.col("_start") + F.col("rank") - 1).alias("slot"))
    )


def one_hot_long(df: DataFrame, key: str, columns: list[str], fitted: DataFrame | None = None) -> DataFrame:
    """(key, column, slot): the non-zero entries of the encoded matrix.

    First categories and categories unknown to ``fitted`` give no row. The
    slot table is broadcast when small; otherwise it is a shuffled join.
    """
    slots = one_hot_slots(df, columns) if fitted is None else fitted
    wide = df.select(field(key).alias(key), *[category_key(field(c)).alias(c) for c in columns])
    long = wide.unpivot([field(key)], [field(c) for c in columns], "column", "category")
    kept = slots.where(F.col("slot").isNotNull()).select("column", "category", "slot")
    return join_small(long, kept, ["column", "category"], "inner").select(key, "column", "slot")
