"""Two-sample distribution metrics: quantile edges, histograms, PSI and KS."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.stats import (
    EXACT_KS_MAX_N,
    MIN_PSI_EDGES,
    MIN_PSI_ROWS,
    bin_number,
    clipped_share,
    ks_p_value,
    padded_share,
    psi_term,
)
from ..session import checkpointed
from .columns import ComparedColumn, field
from .ordering import held, materialised, running_totals
from .tagging import category_counts_by_side, lenient_double, numeric_value_counts

PSI_BINS = 10


def _quantile_fractions(bins: int) -> list[float]:
    """The double grid i * (1/bins), ending exactly at 1."""
    step = 1.0 / bins
    return [i * step for i in range(bins)] + [1.0]


def _rank(q: float, up: int, total: str) -> str:
    """SQL of a 0-based rank next to quantile ``q``: the one below or above it."""
    low = f"floor(({total} - 1) * {q!r}D)"
    return f"least({low} + 1, {total} - 1)" if up else low


def ordered_profile(values: DataFrame, bins: int = PSI_BINS, n_buckets: int | None = None) -> DataFrame:
    """Per column: side totals, KS distance and exact baseline quantile edges.

    ``values`` is (pos, value, n_ref, n_cur). One ordered pass answers all
    three: the KS distance is the largest gap of the two running shares, and an
    order statistic of rank r is the value whose running baseline count first
    exceeds r. Only values near a wanted rank are kept beside the maximum; the
    interpolation happens on one row per column.
    """
    run = running_totals(values, ["pos"], "value", ["n_ref", "n_cur"], n_buckets)
    fractions = _quantile_fractions(bins)
    # Values within two ranks of a quantile: a superset of those wanted, told
    # by arithmetic alone and at most a handful per edge.
    step = f"({bins} / greatest(tot_n_ref - 1, 1))"
    near = f"n_ref > 0 AND floor((cum_n_ref + 1) * {step}) >= ceil((cum_n_ref - n_ref - 2) * {step})"
    hit = F.expr(f"CASE WHEN {near} THEN struct(value, cum_n_ref AS upto) END")
    finite = "abs(value) < double('infinity')"
    gap = "abs(cum_n_ref / greatest(tot_n_ref, 1) - cum_n_cur / greatest(tot_n_cur, 1))"
    grouped = run.withColumn("_hit", hit).groupBy("pos").agg(
        F.max("tot_n_ref").alias("n_ref"),
        F.max("tot_n_cur").alias("n_cur"),
        F.expr(f"sum(CASE WHEN {finite} THEN n_ref ELSE 0 END)").alias("finite_ref"),
        F.expr(f"sum(CASE WHEN {finite} THEN n_cur ELSE 0 END)").alias("finite_cur"),
        F.expr(f"max({gap})").alias("ks_d"),
        F.sort_array(F.collect_list("_hit")).alias("_hits"),
    )
    # Linear interpolation, written to be exact at both ends.
    edges = []
    for q in fractions:
        low, high = (f"element_at(filter(_hits, h -> h.upto > {_rank(q, up, 'n_ref')}), 1).value" for up in (0, 1))
        at = f"((n_ref - 1) * {q!r}D)"
        t, width = f"({at} - floor({at}))", f"({high} - {low})"
        edges.append(f"CASE WHEN {t} < 0.5D THEN {low} + {width} * {t} ELSE {high} - {width} * (1 - {t}) END")
    distinct = f"array_sort(array_distinct(array({', '.join(edges)})))"
    return grouped.selectExpr(
        "pos", "n_ref", "n_cur", "finite_ref", "finite_cur", "ks_d",
        f"CASE WHEN n_ref > 0 THEN {distinct} END AS edges",
    )


def histogram_by_side(values: DataFrame, edges: DataFrame, bins: int = PSI_BINS) -> DataFrame:
    """(pos, bin, n_ref, n_cur) on given edges; values outside are not counted.

    ``edges`` has one row per compared column and is broadcast on that bound.
    """
    binned = values.join(F.broadcast(edges.select("pos", "edges")), "pos").withColumn(
        "bin", bin_number(F.col("edges"), F.col("value"), bins + 1)
    )
    return (
        binned.where(F.col("bin").isNotNull())
        .groupBy("pos", "bin")
        .agg(F.sum("n_ref").alias("n_ref"), F.sum("n_cur").alias("n_cur"))
    )


def numeric_psi_from_bins(hist: DataFrame) -> DataFrame:
    """(pos, raw_psi) from per-side bin counts; at most ``bins`` rows per column.

    A bin empty on both sides has equal clipped shares and adds nothing, so
    absent bins need no row.
    """
    whole = Window.partitionBy("pos")
    ref_total, cur_total = F.sum("n_ref").over(whole), F.sum("n_cur").over(whole)
    term = psi_term(clipped_share(F.col("n_ref"), ref_total), clipped_share(F.col("n_cur"), cur_total))
    return hist.select("pos", term.alias("_term")).groupBy("pos").agg(F.sum("_term").alias("raw_psi"))


def numeric_metrics(
    values: DataFrame, bins: int = PSI_BINS, ks_method: str = "auto", n_buckets: int | None = None
) -> DataFrame:
    """(pos, n_ref, n_cur, psi, ks_d, ks_p) for every numeric column at once.

    Runs three jobs over one held value table: its size, the ordered profile,
    the histogram on the profile's edges. Only tables with one row per column
    (times bins) leave those jobs.
    """
    with held(values):
        profile = materialised(ordered_profile(values, bins, n_buckets))
        raw = materialised(numeric_psi_from_bins(histogram_by_side(values, profile, bins)))
    if ks_method == "auto" and not profile.where(F.greatest("n_ref", "n_cur") <= EXACT_KS_MAX_N).limit(1).count():
        ks_method = "asymp"  # no column is small enough for the exact p-value
    usable = (
        (F.least("n_ref", "n_cur") >= MIN_PSI_ROWS) & (F.size("edges") >= MIN_PSI_EDGES)
    )
    compared = (F.col("finite_ref") > 0) & (F.col("finite_cur") > 0)
    return (
        profile.join(F.broadcast(raw), "pos", "left")
        .withColumn("psi", F.when(usable, F.coalesce("raw_psi", F.lit(0.0))).otherwise(0.0))
        .withColumn("ks_d", F.when(compared, F.col("ks_d")))
        .withColumn(
            "ks_p",
            F.when(compared, ks_p_value(F.col("ks_d"), F.col("n_ref"), F.col("n_cur"), ks_method)).otherwise(1.0),
        )
        .select("pos", "n_ref", "n_cur", "psi", "ks_d", "ks_p")
    )


def categorical_metrics(values: DataFrame) -> DataFrame:
    """(pos, n_ref, n_cur, psi) for every categorical column.

    Category sets may be large, so totals are joined (one row per column)
    rather than windowed over all categories of a column. The table is held
    meanwhile: each side is scanned once.
    """
    with held(values):
        totals = materialised(values.groupBy("pos").agg(F.sum("n_ref").alias("_ref"), F.sum("n_cur").alias("_cur")))
        term = psi_term(padded_share(F.col("n_ref"), F.col("_ref")), padded_share(F.col("n_cur"), F.col("_cur")))
        metrics = (
            values.join(F.broadcast(totals), "pos")
            .groupBy("pos")
            .agg(F.max("_ref").alias("n_ref"), F.max("_cur").alias("n_cur"), F.sum(term).alias("psi"))
        )
        return materialised(metrics)


def category_shares(values: DataFrame) -> DataFrame:
    """(pos, value, ref_share, cur_share) from counts by side, which are taken once."""
    counts = checkpointed(values)
    totals = counts.groupBy("pos").agg(F.sum("n_ref").alias("_ref"), F.sum("n_cur").alias("_cur"))
    share = lambda n, total: F.col(n) / F.greatest(total, F.lit(1))
    return counts.join(F.broadcast(totals), "pos").select(
        "pos", "value", share("n_ref", "_ref").alias("ref_share"), share("n_cur", "_cur").alias("cur_share"))


def _single(name: str, kind: str) -> list[ComparedColumn]:
    return [ComparedColumn(name, kind, 0)]


def psi_numeric(ref: DataFrame, cur: DataFrame, column: str, bins: int = PSI_BINS) -> DataFrame:
    """One row: psi of a numeric column."""
    values = numeric_value_counts(ref, cur, _single(column, "numeric"))
    return _or_default(numeric_metrics(values, bins, "asymp"), ["psi"], {"psi": 0.0})


def psi_categorical(ref: DataFrame, cur: DataFrame, column: str) -> DataFrame:
    """One row: psi of a categorical column."""
    values = category_counts_by_side(ref, cur, _single(column, "categorical"))
    return _or_default(categorical_metrics(values), ["psi"], {"psi": 0.0})


def ks_two_sample(ref: DataFrame, cur: DataFrame, column: str, method: str = "auto") -> DataFrame:
    """One row: KS distance, sample sizes and two-sided p-value."""
    values = numeric_value_counts(ref, cur, _single(column, "numeric"))
    return _or_default(
        numeric_metrics(values, PSI_BINS, method),
        ["ks_d", "ks_p", "n_ref", "n_cur"],
        {"ks_p": 1.0, "n_ref": 0, "n_cur": 0},
    )


def _or_default(metrics: DataFrame, columns: list[str], defaults: dict) -> DataFrame:
    """An all-NULL column has no value rows; it still answers with one row."""
    return metrics.agg(*[F.max(c).alias(c) for c in columns]).fillna(defaults)


def quantile_edges(df: DataFrame, columns: list[str], bins: int = PSI_BINS) -> DataFrame:
    """(column, edges): distinct exact quantiles of each numeric column."""
    specs = [ComparedColumn(c, "numeric", i) for i, c in enumerate(columns)]
    names = df.sparkSession.createDataFrame([(c.position, c.name) for c in specs], "pos int, column string")
    with held(numeric_value_counts(df, df.limit(0), specs)) as values:
        profile = materialised(ordered_profile(values, bins))
    return profile.join(F.broadcast(names), "pos").select("column", "edges")


def numeric_histogram(df: DataFrame, columns: list[str], bins: int = 30) -> DataFrame:
    """(column, bin, bin_low, bin_high, n): equal-width bins from min to max.

    A constant column is drawn half a unit to each side. Rows are unpivoted and
    meet the range of their column, one broadcast row each; counts are combined
    before the shuffle, so only columns x bins rows leave the map side.
    """
    wide = df.select(*[lenient_double(df, c).alias(c) for c in columns])
    spans = wide.agg(F.array(*[
        F.struct(F.lit(c).alias("column"), F.min(field(c)).alias("lo"), F.max(field(c)).alias("hi")) for c in columns
    ]).alias("s")).select(F.explode("s").alias("s"))
    flat = F.col("s.lo") == F.col("s.hi")
    ranges = spans.select(
        "s.column", F.when(flat, F.col("s.lo") - 0.5).otherwise(F.col("s.lo")).alias("lo"),
        (F.when(flat, F.lit(1.0)).otherwise(F.col("s.hi") - F.col("s.lo")) / bins).alias("width"))
    long = wide.unpivot([], [field(c) for c in columns], "column", "value").where(F.col("value").isNotNull())
    number = F.least(F.floor((F.col("value") - F.col("lo")) / F.col("width")), F.lit(bins - 1)).cast("int")
    counts = long.join(F.broadcast(ranges), "column").groupBy("column", number.alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), F.min("lo").alias("lo"), F.min("width").alias("width"))
    return counts.where(F.col("bin").isNotNull()).select(
        "column", "bin", (F.col("lo") + F.col("bin") * F.col("width")).alias("bin_low"),
        (F.col("lo") + (F.col("bin") + 1) * F.col("width")).alias("bin_high"), "n")


def category_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, value, n) for every categorical column in one job; NULL left out."""
    wide = df.select(*[field(c).cast("string").alias(c) for c in columns])
    long = wide.unpivot([], [field(c) for c in columns], "column", "value")
    return long.where(F.col("value").isNotNull()).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
