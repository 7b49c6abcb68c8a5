"""The encoder whose state is a table: against the collected one, and with more categories than that one takes."""

import math

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import SparseVector
from pyspark.sql import functions as F

from tidemark.operators import encoding
from tidemark.operators.encoding import Encoder, fit_encoder
from tidemark.operators.preprocess import fit_preprocessor, one_hot_long

ROWS = [(1, 1.0, 5, "b", "q", True), (2, 3.0, 5, "a", None, False), (3, None, 5, "c", "p", True), (4, 8.0, 5, "a", "p", None)]
OTHER = [(1, 4.0, 6, "zz", None, None), (2, 1.0, 5, "c", "q", True), (3, None, None, None, "never", False)]
SCHEMA = "id int, x double, k int, `c-1` string, d string, f boolean"


@pytest.mark.parametrize("head", [10_000, 1])
def test_equal_to_the_collected_encoder(spark, monkeypatch, head):
    monkeypatch.setattr(encoding, "HEAD", head)  # with 1, only a category that all rows have is broadcast
    train, other = spark.createDataFrame(ROWS, SCHEMA), spark.createDataFrame(OTHER, SCHEMA)
    fitted, collected = fit_encoder(train, ("id",)), fit_preprocessor(train, ("id",))
    assert [r["name"] for r in fitted.names().orderBy("position").collect()] == collected.feature_names
    for df in (train, other):
        got = fitted.transform(df, ["id"]).orderBy("id").collect()
        assert all(isinstance(r["features"], SparseVector) and r["features"].size == fitted.size for r in got)
        want = collected.pipeline_model(train).transform(df).select("id", vector_to_array("features").alias("v")).orderBy("id").collect()
        for a, b in zip(got, want, strict=True):
            assert a["id"] == b["id"] and [str(x) for x in a["features"].toArray()] == [str(x) for x in b["v"]]


def test_more_than_a_million_categories(spark):
    n = 1_050_000
    df = spark.range(n).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("c"), (F.col("id") * 7 % n).cast("string"))).alias("c"),
                               (F.col("id") % 2).cast("string").alias("d"), F.concat(F.lit("u"), F.col("id").cast("string")).alias("u"))
    with pytest.raises(ValueError, match="categories"):
        fit_preprocessor(df, ("id",))
    fitted = fit_encoder(df, ("id",))
    assert fitted.width > 1_000_000
    got = fitted.entries(df, ["id"]).agg(F.count(F.lit(1)), F.sum(F.xxhash64("id", "position").cast("decimal(38,0)"))).first()
    long = one_hot_long(df, "id", ["c", "d", "u"], fitted.slots)
    assert tuple(got) == tuple(long.agg(F.count(F.lit(1)), F.sum(F.xxhash64("id", F.col("slot")).cast("decimal(38,0)"))).first())
    vector = fitted.transform(df.where("id = 5"), ["id"]).first()["features"]
    assert vector.size == fitted.size and len(vector.indices) == 3


def test_saved_state_and_odd_frames(spark, tmp_path):
    train = spark.createDataFrame(ROWS, SCHEMA)
    fitted = fit_encoder(train, ("id",))
    fitted.save(str(tmp_path / "e"))
    again = Encoder.load(spark, str(tmp_path / "e"))
    assert again.transform(train, ["id"]).orderBy("id").collect()[0] == fitted.transform(train, ["id"]).orderBy("id").collect()[0]
    assert fitted.transform(train.where("false"), ["id"]).collect() == []
    numbers = fit_encoder(train.select("id", "x"), ("id",))
    vector = numbers.transform(train, ["id"]).orderBy("id").collect()[2]["features"]
    assert vector.size == 1 and math.isnan(vector.toArray()[0])
    words = fit_encoder(train.select("id", "d"), ("id",))
    assert [list(r["features"].toArray()) for r in words.transform(train, ["id"]).orderBy("id").collect()] == [
        [1.0, 0.0], [0.0, 1.0], [0.0, 0.0], [0.0, 0.0]]
