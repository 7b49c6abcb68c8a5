"""A corpus cleaned and packed: language, near duplicates, repeated passages, benchmark passages, sequences.

Each stage works on all that the one before kept. A document without an id is dropped, and of rows that share an id
the least one stays; a text that loses all its words is dropped with its document.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.decontamination import contamination
from tidemark.llm.jaccard_join import near_classes
from tidemark.llm.language_id import UNKNOWN, identify
from tidemark.llm.packing import pack
from tidemark.llm.substring_dedup import remove_repeats
from tidemark.llm.tables import joined, stored
from tidemark.session import checkpoint_dir, ship_package


def _without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    return joined(docs, stored(ids.select("doc_id").distinct()), ["doc_id"], "left_anti", F.lit(16))


def _one_row_per_id(docs: DataFrame) -> DataFrame:
    repeated = stored(docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1").select("doc_id"))
    single = joined(docs, repeated, ["doc_id"], "left_anti", F.lit(16))
    several = joined(docs, repeated, ["doc_id"], "left_semi", F.lit(16))
    least = several.groupBy("doc_id").agg(F.min(F.struct(*docs.columns)).alias("row")).select("row.*")
    return single.unionByName(least)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language (no text, or no letter in it) go."""
    ship_package(spark)
    docs = _one_row_per_id(docs.where(F.col("doc_id").isNotNull()))
    return _without(docs, identify(docs).where(F.col("lang_pred") == UNKNOWN))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of least id of each class stays."""
    ship_package(spark)
    return _without(docs, near_classes(docs).where("component_id <> doc_id"))


def _with_text(docs: DataFrame, out: DataFrame, text: str) -> DataFrame:
    kept = out.withColumns({"text": F.col(text), "n_chars": F.char_length(text).cast(docs.schema["n_chars"].dataType)})
    return kept.select(*docs.columns)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 words and more that a smaller id has are cut out; other texts stay as they are."""
    ship_package(spark)
    rest = tuple(c for c in docs.columns if c not in ("doc_id", "n_chars"))
    out = remove_repeats(docs, carry=rest).where("n_removed < n_words OR n_words = 0")
    return _with_text(docs, out.withColumn("kept", F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("text"))), "kept")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages are cut out of the texts."""
    ship_package(spark)
    rest = tuple(c for c in docs.columns if c not in ("doc_id", "n_chars", "text"))
    out = contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), carry=rest)
    hit = F.aggregate(F.zip_with("starts", "stops", lambda a, b: b - a), F.lit(0), lambda x, y: x + y)
    return _with_text(docs, out.where((F.size("starts") == 0) | (hit < F.col("n_words"))), "cleaned")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 1024 tokens."""
    ship_package(spark)
    return pack(docs).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("substring_dedup", substring_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{checkpoint_dir(spark).rstrip('/')}/tidemark-pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{i}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


# Trained weights, tokens and graph components are beyond SQL; tests hold run() against brute force.
ORACLE_SQL = None
