"""Drift over arriving data, an addition to the batch operators.

``check_new_files`` runs the ordinary drift check on whatever landed since the
last run. ``windowed_psi`` keeps a histogram per time window on fixed baseline
edges and turns it into one PSI per window and column.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..functions.stats import bin_number, clipped_share, psi_term
from ..operators.columns import field
from ..operators.drift import DriftOptions, detect_drift
from ..operators.distribution import PSI_BINS, quantile_edges
from ..operators.ordering import held
from ..operators.tagging import lenient_double
from ..sources.profiles import BaselineProfile, read_profile, write_profile
from ..sources.reports import write_report


def check_new_files(
    spark: SparkSession, ref: DataFrame | BaselineProfile, incoming: str, schema: T.StructType, report_path: str,
    checkpoint: str, options: DriftOptions = DriftOptions(), on_report: Callable[[DataFrame], None] | None = None,
):
    """Compares newly landed Parquet files with the baseline, once each.

    Files already seen are remembered in ``checkpoint``; the call ends when the
    backlog is done, so a daily schedule can simply call it. The baseline is
    profiled once, beside the checkpoint, and every batch merges with that
    profile. Finished batches are logged: one that is run again after its report
    was made is passed over.
    """
    if isinstance(ref, DataFrame):
        ref = _kept_profile(ref, f"{checkpoint}-baseline", options)
    log = f"{checkpoint}-reported"

    def check(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty() or batch_id in _reported(spark, log):
            return
        with held(batch) as rows:
            result = detect_drift(ref, rows, options)
            # A batch that is run again replaces its report.
            write_report(result.summary, report_path, key=f"batch-{batch_id}")
            if on_report:
                on_report(result.summary)
        spark.createDataFrame([(batch_id,)], "batch_id bigint").coalesce(1).write.mode("append").json(log)

    stream = spark.readStream.schema(schema).parquet(incoming)
    query = (
        stream.writeStream.foreachBatch(check).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return query


def _reported(spark: SparkSession, log: str) -> set[int]:
    """Batches of this checkpoint whose report is made."""
    try:
        return {r["batch_id"] for r in spark.read.schema("batch_id bigint").json(log).collect()}
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return set()


def _kept_profile(ref: DataFrame, path: str, options: DriftOptions) -> BaselineProfile:
    """The profile an earlier call left, if it is of the same columns."""
    try:
        known = read_profile(ref.sparkSession, path)
    except FileNotFoundError:
        return write_profile(ref, path, options.ignore)
    same = known.frame.schema == ref.drop(*options.ignore).schema
    return known if same else write_profile(ref, path, options.ignore)


def baseline_bins(ref: DataFrame, columns: list[str], bins: int = PSI_BINS) -> DataFrame:
    """(column, edges, bin, n_ref, ref_total): the fixed side of a windowed PSI."""
    edges = quantile_edges(ref, columns, bins).where(F.size("edges") >= 3)
    long = ref.select(*[lenient_double(ref, c).alias(c) for c in columns]).unpivot(
        [], [field(c) for c in columns], "column", "value"
    )
    binned = long.join(F.broadcast(edges), "column").withColumn(
        "bin", bin_number(F.col("edges"), F.col("value"), bins + 1)
    )
    counts = binned.where(F.col("bin").isNotNull()).groupBy("column", "bin").agg(F.count(F.lit(1)).alias("n_ref"))
    every = edges.select("column", "edges", F.explode(F.sequence(F.lit(1), F.size("edges") - 1)).alias("bin"))
    total = F.sum("n_ref").over(Window.partitionBy("column"))
    return every.join(counts, ["column", "bin"], "left").fillna(0, ["n_ref"]).withColumn("ref_total", total)


def window_histogram(
    events: DataFrame, edges: DataFrame, columns: list[str], ts: str, window: str = "1 day", delay: str | None = "1 day",
    bins: int = PSI_BINS,
) -> DataFrame:
    """(window_start, column, bin, n): works on a batch or a stream.

    On a stream, rows later than ``delay`` behind the watermark are dropped;
    without a delay none is. State is windows x columns x bins counters, not rows.
    """
    if events.isStreaming and delay is not None:
        events = events.withWatermark(ts, delay)
    values = F.array(*[F.struct(F.lit(c).alias("column"), lenient_double(events, c).alias("value")) for c in columns])
    long = events.select(field(ts).alias(ts), F.explode(values).alias("r")).select(ts, "r.*")
    binned = long.join(F.broadcast(edges.select("column", "edges")), "column").withColumn(
        "bin", bin_number(F.col("edges"), F.col("value"), bins + 1)
    )
    counted = binned.where(F.col("bin").isNotNull()).groupBy(F.window(ts, window), "column", "bin").agg(
        F.count(F.lit(1)).alias("n_cur")
    )
    return counted.select(F.col("window.start").alias("window_start"), "column", "bin", "n_cur")


def psi_per_window(histogram: DataFrame, baseline: DataFrame) -> DataFrame:
    """(window_start, column, n_cur, psi) from finished windows."""
    totals = histogram.groupBy("window_start", "column").agg(F.sum("n_cur").alias("cur_total"))
    grid = totals.join(F.broadcast(baseline.drop("edges")), "column")
    full = grid.join(histogram, ["window_start", "column", "bin"], "left").fillna(0, ["n_cur"])
    term = psi_term(
        clipped_share(F.col("n_ref"), F.col("ref_total")), clipped_share(F.col("n_cur"), F.col("cur_total"))
    )
    return full.groupBy("window_start", "column").agg(F.max("cur_total").alias("n_cur"), F.sum(term).alias("psi"))


def stream_windowed_psi(
    stream: DataFrame, baseline: DataFrame, columns: list[str], ts: str, table: str, checkpoint: str,
    window: str = "1 day", delay: str = "1 day",
):
    """Runs the stream until its input is used up; finished windows land in ``table`` (Parquet)."""
    edges = baseline.select("column", "edges").distinct()
    counts = window_histogram(stream, edges, columns, ts, window, delay)
    query = (
        counts.writeStream.format("parquet").option("path", table).option("checkpointLocation", checkpoint)
        .outputMode("append").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return query


def stream_seen_rows(
    stream: DataFrame, baseline: DataFrame, columns: list[str], ts: str, table: str, checkpoint: str, window: str = "1 day",
):
    """As ``stream_windowed_psi``, but counts what came however late; ``table`` holds the counts after the last batch.

    Its state never expires: one counter per window, column and bin."""
    edges = baseline.select("column", "edges").distinct()
    counts = window_histogram(stream, edges, columns, ts, window, delay=None)

    def replace(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(table)

    query = (
        counts.writeStream.foreachBatch(replace).option("checkpointLocation", checkpoint)
        .outputMode("complete").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return query


def late_rows(seen: DataFrame, finished: DataFrame) -> DataFrame:
    """(window_start, column, n_late): rows of finished windows that came after their window was closed."""
    total = lambda df, name: df.groupBy("window_start", "column").agg(F.sum("n_cur").alias(name))
    both = total(finished, "_done").join(total(seen, "_seen"), ["window_start", "column"], "left")
    return both.select("window_start", "column", (F.coalesce("_seen", "_done") - F.col("_done")).alias("n_late"))
