"""Scaling and one-hot encoding whose fitted state is a table, for any number of categories.

Nothing is collected but one row per column. Categories are ranked in a distributed order; a row's vector is put
together from the slots of its categories by one aggregation over the row's key.

Entries find their slot in two ways, so that no category of many rows is shuffled by its value: the categories that at
least one row in ``HEAD`` has in the table to be encoded are few whatever the data (at most ``HEAD`` in a column) and
are broadcast; all others are rarer than that and are joined by a shuffle without a hot key.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

import pyarrow as pa
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import checkpointed
from .columns import categorical_columns, drop_targets, field, numeric_columns
from .preprocess import MISSING, MISSING_NAME, category_key, one_hot_slots, scaler_stats
from .tagging import lenient_double

#: A category is broadcast if one row in so many has it.
HEAD = 10_000


@dataclass
class Encoder:
    """``numeric`` scales by column; ``slots`` is (column, category, rank, slot) with one row per category."""

    numeric: dict[str, tuple[float, float]]
    categorical: list[str]
    slots: DataFrame
    width: int  # slots of all categories

    @property
    def size(self) -> int:
        return len(self.numeric) + self.width

    def entries(self, df: DataFrame, keys: list[str]) -> DataFrame:
        """(keys, position, value): what is not 0 in the encoded matrix, numeric positions first."""
        return self._entries(df, keys).select(*keys, F.explode("entries").alias("e")).select(
            *keys, F.col("e.position").alias("position"), F.col("e.value").alias("value")).where("value <> 0 OR isnan(value)")

    def transform(self, df: DataFrame, keys: list[str], output: str = "features") -> DataFrame:
        """(keys, output): one sparse vector per key. ``keys`` name a row."""
        rows = self._entries(df, keys)
        kept = F.filter("entries", lambda e: (e.value != 0) | F.isnan(e.value))
        body = F.struct(
            F.lit(0).cast("tinyint").alias("type"), F.lit(self.size).alias("size"),
            F.transform(kept, lambda e: e.position.cast("int")).alias("indices"),
            F.transform(kept, lambda e: e.value).alias("values"))
        built = rows.select(*[field(k) for k in keys], body.alias(output))
        # The struct is what a vector column stores; passing it through Arrow only gives it the vector's type.
        schema = T.StructType([*built.schema.fields[:-1], T.StructField(output, VectorUDT())])
        return built.mapInArrow(_same, schema)

    def _entries(self, df: DataFrame, keys: list[str]) -> DataFrame:
        """(keys, entries): per key the (position, value) of its numbers and slots, by position."""
        named = [F.struct(F.lit(i).cast("long").alias("position"),
                          F.coalesce((lenient_double(df, c) - F.lit(mean)) / F.lit(scale), F.lit(float("nan"))).alias("value"))
                 for i, (c, (mean, scale)) in enumerate(self.numeric.items())]
        kind = "array<struct<position:bigint,value:double>>"
        numbers = F.array(*named).cast(kind) if named else F.array().cast(kind)
        own = [field(k) for k in keys]
        if not self.categorical:
            return df.select(*own, numbers.alias("entries"))
        cats = F.array(*[F.struct(F.lit(c).alias("column"), category_key(field(c)).alias("category")) for c in self.categorical])
        long = df.select(*own, numbers.alias("_numbers"), F.posexplode(cats).alias("_at", "_cell")).select(
            *own, F.when(F.col("_at") == 0, F.col("_numbers")).alias("_numbers"), "_cell.column", "_cell.category")
        head = self._head(df)
        slots = self.slots.select("column", "category", "slot")
        known = head.join(slots, ["column", "category"], "left").withColumn("_known", F.lit(True))
        # At most HEAD rows per column.
        met = long.join(F.broadcast(known), ["column", "category"], "left")
        tail = met.where("_known IS NULL").drop("slot").join(slots.hint("merge"), ["column", "category"], "left")
        both = met.where("_known").select(*own, "_numbers", "slot").unionByName(tail.select(*own, "_numbers", "slot"))
        offset = len(self.numeric)
        slot = F.struct((F.col("slot") + offset).alias("position"), F.lit(1.0).alias("value"))
        return both.groupBy(*own).agg(F.array_sort(F.concat(
            F.flatten(F.collect_list("_numbers")), F.collect_list(F.when(F.col("slot").isNotNull(), slot)))).alias("entries"))

    def _head(self, df: DataFrame) -> DataFrame:
        """(column, category) of the categories that many rows of ``df`` have."""
        counts = _category_counts(df, self.categorical)
        total = df.count()
        return checkpointed(counts.where(F.col("n") * HEAD >= total).select("column", "category"))

    def names(self) -> DataFrame:
        """(position, name) of the encoded columns; one-hot names are ``column_category``."""
        spark = self.slots.sparkSession
        numeric = spark.createDataFrame(list(enumerate(self.numeric)), "position long, name string")
        shown = F.when(F.col("category") == MISSING, F.lit(MISSING_NAME)).otherwise(F.col("category"))
        return numeric.unionByName(self.slots.where("slot IS NOT NULL").select(
            (F.col("slot") + len(self.numeric)).alias("position"), F.concat_ws("_", "column", shown).alias("name")))

    def save(self, path: str) -> None:
        self.slots.write.mode("overwrite").parquet(f"{path}/slots")
        meta = json.dumps({"numeric": list(self.numeric.items()), "categorical": self.categorical, "width": self.width})
        self.slots.sparkSession.createDataFrame([(meta,)], "meta string").coalesce(1).write.mode("overwrite").parquet(f"{path}/meta")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Encoder:
        meta = json.loads(spark.read.parquet(f"{path}/meta").first()["meta"])
        numeric = {c: (mean, scale) for c, (mean, scale) in meta["numeric"]}
        return cls(numeric, meta["categorical"], spark.read.parquet(f"{path}/slots"), meta["width"])


def _same(batches):
    for batch in batches:
        yield pa.RecordBatch.from_arrays(batch.columns, names=batch.schema.names)


def _category_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    wide = df.select(*[category_key(field(c)).alias(c) for c in columns])
    long = wide.unpivot([], [field(c) for c in columns], "column", "category")
    return long.groupBy("column", "category").agg(F.count(F.lit(1)).alias("n"))


def fit_encoder(df: DataFrame, exclude: tuple[str, ...] = ()) -> Encoder:
    """Fits on ``df`` with target columns removed; a missing category is one of its own and comes last in its column."""
    features = drop_targets(df).drop(*exclude)
    numeric, categorical = numeric_columns(features), categorical_columns(features)
    stats = {r["column"]: r for r in scaler_stats(features, numeric).collect()} if numeric else {}
    scales = {c: (0.0 if stats[c]["mean"] is None else stats[c]["mean"], 1.0 if stats[c]["scale"] is None else stats[c]["scale"])
              for c in numeric}
    if not categorical:
        empty = df.sparkSession.createDataFrame([], "column string, category string, rank bigint, slot bigint")
        return Encoder(scales, [], empty, 0)
    slots = checkpointed(one_hot_slots(features, categorical))
    return Encoder(scales, categorical, slots, slots.where("slot IS NOT NULL").count())
