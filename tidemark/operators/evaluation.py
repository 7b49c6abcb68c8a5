"""Classification metrics. Scores are aggregated to distinct values first."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .columns import field
from .ordering import held, materialised, running_totals


def score_counts(df: DataFrame, label: str, score: str, groups: list[str]) -> DataFrame:
    """(groups, score, n_pos, n_neg): one row per distinct score."""
    y = field(label)
    return (
        df.where(y.isNotNull() & field(score).isNotNull())
        .groupBy(*groups, field(score).cast("double").alias("score"))
        .agg(F.count_if(y == 1).alias("n_pos"), F.count_if(y == 0).alias("n_neg"))
    )


def _auc(pos_total: Column, neg_total: Column) -> Column:
    """Share of (positive, negative) pairs ranked right, ties counting half."""
    neg_below = F.col("cum_n_neg") - F.col("n_neg")
    won = F.sum(F.col("n_pos") * (neg_below + F.col("n_neg") / 2))
    return F.when((pos_total > 0) & (neg_total > 0), won / (pos_total.cast("double") * neg_total))


def _average_precision(pos_total: Column) -> Column:
    """Precision at each distinct threshold, weighted by the recall gained."""
    tp = F.col("tot_n_pos") - F.col("cum_n_pos") + F.col("n_pos")
    fp = F.col("tot_n_neg") - F.col("cum_n_neg") + F.col("n_neg")
    gained = F.sum(F.col("n_pos") * (tp / F.greatest(tp + fp, F.lit(1))))
    return F.when(pos_total > 0, gained / pos_total).otherwise(0.0)


def binary_metrics(
    df: DataFrame, label: str, score: str, groups: list[str] | None = None,
    threshold: float = 0.5, n_buckets: int | None = None,
) -> DataFrame:
    """(groups, n, auc, ap, acc, f1) for 0/1 labels and a score.

    One aggregation to distinct scores answers all four. AUC is NULL with a
    single class; AP and F1 are 0 without positives.
    """
    groups = groups or []
    with held(score_counts(df, label, score, groups)) as counts:
        run = running_totals(counts, groups, "score", ["n_pos", "n_neg"], n_buckets)
        pos_total, neg_total = F.max("tot_n_pos"), F.max("tot_n_neg")
        said_yes = F.col("score") >= threshold
        tp = F.sum(F.when(said_yes, F.col("n_pos")).otherwise(0))
        fp = F.sum(F.when(said_yes, F.col("n_neg")).otherwise(0))
        fn, tn = pos_total - tp, neg_total - fp
        measured = run.groupBy(*groups).agg(
            (pos_total + neg_total).alias("n"),
            _auc(pos_total, neg_total).alias("auc"),
            _average_precision(pos_total).alias("ap"),
            ((tp + tn) / F.greatest(pos_total + neg_total, F.lit(1))).alias("acc"),
            F.when(2 * tp + fp + fn > 0, 2 * tp / F.greatest(2 * tp + fp + fn, F.lit(1)))
            .otherwise(0.0).alias("f1"),
        )
        return materialised(measured)


def roc_auc(df: DataFrame, label: str, score: str, groups: list[str] | None = None) -> DataFrame:
    return binary_metrics(df, label, score, groups).select(*(groups or []), "auc")


def average_precision(df: DataFrame, label: str, score: str, groups: list[str] | None = None) -> DataFrame:
    return binary_metrics(df, label, score, groups).select(*(groups or []), "ap")


def confusion_counts(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """(actual, predicted, n): the non-empty cells."""
    return (
        df.where(field(actual).isNotNull() & field(predicted).isNotNull())
        .groupBy(field(actual).alias("actual"), field(predicted).alias("predicted"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def confusion_matrix(df: DataFrame, actual: str, predicted: str, labels: list | None = None, max_columns: int = 10_000
                     ) -> DataFrame:
    """Rows are actual labels, one column per predicted label, empty cells 0.

    Without ``labels`` they are found first. A wide table has a bound on its
    columns, so more labels than ``max_columns`` are an error: the same cells as
    rows, whatever the number of classes, are ``confusion_counts``.
    """
    cells = materialised(confusion_counts(df, actual, predicted))
    if labels is None:
        found = cells.select(F.col("actual").alias("l")).union(cells.select("predicted")).distinct()
        labels = [r["l"] for r in found.orderBy("l").limit(max_columns + 1).collect()]
    if len(labels) > max_columns:
        raise ValueError(f"more than {max_columns} classes: use confusion_counts")
    base = df.sparkSession.createDataFrame([(v,) for v in labels], f"actual {cells.schema['actual'].dataType.simpleString()}")
    wide = cells.groupBy("actual").pivot("predicted", labels).agg(F.sum("n"))
    return F.broadcast(base).join(wide, "actual", "left").fillna(0)


def classification_report(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """(label, precision, recall, f1, support) per class, then accuracy and averages.

    In the accuracy row all three metric columns hold the accuracy.
    """
    cells = materialised(confusion_counts(df, actual, predicted))
    as_text = lambda c: F.col(c).cast("string")
    sides = cells.select(
        F.explode(
            F.array(
                F.struct(as_text("actual").alias("label"), F.col("n").alias("support"), F.lit(0).cast("bigint").alias("said"),
                         F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(0).alias("tp")),
                F.struct(as_text("predicted").alias("label"), F.lit(0).cast("bigint").alias("support"), F.col("n").alias("said"),
                         F.lit(0).cast("bigint").alias("tp")),
            )
        ).alias("r")
    ).select("r.*")
    sums = sides.groupBy("label").agg(*[F.sum(c).alias(c) for c in ("support", "said", "tp")])
    ratio = lambda a, b: F.when(b > 0, a / F.greatest(b, F.lit(1))).otherwise(0.0)
    tp, said, support = F.col("tp"), F.col("said"), F.col("support")
    per_class = materialised(
        sums.select(
            "label", ratio(tp, said).alias("precision"), ratio(tp, support).alias("recall"),
            ratio(2 * tp, said + support).alias("f1"), "support", "tp",
        )
    )
    metrics = ("precision", "recall", "f1")
    total = F.sum("support")
    accuracy = F.sum("tp") / F.greatest(total, F.lit(1))
    rows = [
        per_class.select("label", *metrics, "support"),
        per_class.agg(F.lit("accuracy").alias("label"), *[accuracy.alias(m) for m in metrics], total.alias("support")),
        per_class.agg(F.lit("macro avg").alias("label"), *[F.avg(m).alias(m) for m in metrics], total.alias("support")),
        per_class.agg(
            F.lit("weighted avg").alias("label"),
            *[(F.sum(F.col(m) * F.col("support")) / F.greatest(total, F.lit(1))).alias(m) for m in metrics],
            total.alias("support"),
        ),
    ]
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out
