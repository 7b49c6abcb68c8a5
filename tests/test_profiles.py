"""Stored baseline profiles: same reports, no scan of the baseline, versions, repeated batches."""

import shutil

import pytest
from pyspark.sql import functions as F

from tidemark.operators.columns import ComparedColumn
from tidemark.operators.drift import DriftOptions, column_metrics, drift_report
from tidemark.plans.refresh import drift_check
from tidemark.sources.profiles import read_profile, write_profile
from tidemark.sources.reports import read_reports
from tidemark.streaming import incremental

OPTIONS = DriftOptions(ignore=frozenset({"id"}), pred_col="p")


def frame(spark, n, shift=0.0):
    return spark.range(n).select(
        "id", (F.col("id") % 37 + shift).alias("x"), F.when(F.col("id") % 5 > 0, F.col("id") % 11).cast("double").alias("z"),
        F.when(F.col("id") % 4 > 0, (F.col("id") % 6).cast("string")).alias("k"), (F.col("id") % 2 == 0).alias("b"),
        ((F.col("id") % 10) / 10).alias("p"))


def rows(df):
    return sorted(map(str, df.collect()))


def test_report_without_the_baseline(spark, tmp_path):
    base = str(tmp_path / "base")
    frame(spark, 900).write.parquet(base)
    ref, cur = spark.read.parquet(base), frame(spark, 400, 6.0).drop("b").withColumn("extra", F.lit(1))
    write_profile(ref, str(tmp_path / "p"))
    profile = read_profile(spark, str(tmp_path / "p"))
    assert rows(drift_report(profile, cur, OPTIONS)) == rows(drift_report(ref, cur, OPTIONS))
    assert rows(column_metrics(profile, cur, OPTIONS)) == rows(column_metrics(ref, cur, OPTIONS))
    read = profile.value_counts(cur, [ComparedColumn("x", "numeric", 0)]).inputFiles()
    assert read and all("/numeric/" in f and "/base/" not in f for f in read)
    shutil.rmtree(base)  # a second check does not need the baseline any more
    outcome = drift_check(read_profile(spark, str(tmp_path / "p")), cur, OPTIONS, report_path=str(tmp_path / "r"))
    assert outcome.triggered in (True, False) and read_reports(spark, str(tmp_path / "r")).count() == 1


def test_versions(spark, tmp_path):
    path = str(tmp_path / "p")
    with pytest.raises(FileNotFoundError):
        read_profile(spark, path)
    assert write_profile(frame(spark, 50), path).version == 1
    assert write_profile(frame(spark, 60, 1.0), path, ignore=["id"]).version == 2
    assert "id" not in read_profile(spark, path).columns and "id" in read_profile(spark, path, 1).columns
    shutil.rmtree(f"{path}/version=2/meta")  # a version whose writer died is not seen
    assert read_profile(spark, path).version == 1
    with pytest.raises(FileNotFoundError):
        read_profile(spark, path, 2)
    cur = frame(spark, 40).drop("p")
    scored = drift_check(read_profile(spark, path, 1), cur, OPTIONS, keys=["id"])
    assert scored.drift.summary.first()["pred_psi"] is not None
    with pytest.raises(ValueError, match="profile"):
        drift_check(read_profile(spark, path, 1), cur, OPTIONS, snapshot_path=str(tmp_path / "s"))


def test_a_repeated_batch_leaves_one_report(spark, tmp_path):
    ref, seen = frame(spark, 300), []
    inside = str(tmp_path / "in")
    ref.write.parquet(f"{inside}/a")
    run = lambda: incremental.check_new_files(
        spark, ref, f"{inside}/*", ref.schema, str(tmp_path / "rep"), str(tmp_path / "ck"), OPTIONS, lambda s: seen.append(1))
    run()
    frame(spark, 200, 9.0).write.parquet(f"{inside}/b")
    run()
    assert len(seen) == 2
    # The commit of the last batch is lost: Spark runs it again, the log knows it.
    commits = sorted((tmp_path / "ck" / "commits").iterdir())
    for f in commits:
        if f.name.strip(".").split(".")[0] == "1":
            f.unlink()
    run()
    assert len(seen) == 2 and spark.read.json(str(tmp_path / "rep")).count() == 2
