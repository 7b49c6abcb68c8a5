"""Trees and stored models against their SQL where a column has more values than a quantile sketch keeps apart."""

import pytest
from pyspark.sql import functions as F

from oracle import compare, connect
from tidemark.catalog import ORACLES, QUERIES


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("tables")
    n, at = 40_000, F.col("doc_id")
    docs = spark.range(n).withColumnRenamed("id", "doc_id").select(
        "doc_id", F.lit("").alias("text"), F.element_at(F.array(*map(F.lit, "abc")), (at % 3 + 1).cast("int")).alias("lang"),
        F.element_at(F.array(*map(F.lit, "pqrst")), (at % 5 + 1).cast("int")).alias("source"), (at * 7919 % n).alias("n_chars"))
    high = F.pmod(F.xxhash64("doc_id"), F.lit(100)) < F.when(F.col("n_chars") < 13_371, 30).when(F.col("n_chars") < 29_111, 55).otherwise(40)
    labels = docs.select("doc_id", high.cast("long").alias("quality"), F.lit(0).cast("long").alias("toxic"))
    docs.toPandas().to_parquet(path / "documents.parquet")
    labels.toPandas().to_parquet(path / "labels.parquet")
    return str(path)


@pytest.mark.parametrize("name", ["boosted_first_tree", "stored_model_scores"])
def test_exact_cuts(spark, tables, name):
    assert compare(spark, connect(tables), name, QUERIES[name], ORACLES[name], tables) is None
