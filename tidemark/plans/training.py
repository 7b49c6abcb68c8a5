"""Fitting tree models on tables, batch scoring and feature importance."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.columns import field
from ..operators.evaluation import classification_report
from ..operators.labels import balanced_weights, scale_pos_weight
from ..operators.ordering import held
from ..operators.preprocess import fit_preprocessor
from ..operators.sampling import stratified_split
from ..operators.smote import oversample
from ..session import checkpointed
from .ensembles import TreeModel, fit_boosted, fit_forest


def positive_weight(df: DataFrame, label: str) -> Column:
    """Positives weigh negatives / max(positives, 1), negatives 1."""
    return F.when(field(label) == 1, F.lit(float(scale_pos_weight(df, label).first()["scale_pos_weight"]))).otherwise(1.0)


def balanced_weight(df: DataFrame, label: str) -> Column:
    """Each class of a 0/1 label weighs the same in total."""
    weights = {r[label]: float(r["weight"]) for r in balanced_weights(df, label).collect()}  # one row per class
    return F.when(field(label) == 1, F.lit(weights.get(1, 1.0))).otherwise(F.lit(weights.get(0, 1.0)))


def train_boosted(df: DataFrame, label: str, config: dict, exclude: tuple[str, ...] = (), **options) -> TreeModel:
    """Boosted trees from a trial configuration, positives weighted. Penalties, child weight (on the Hessian), row and
    column shares per tree all act; missing numbers go the way that gains more at each split."""
    return fit_boosted(df, label, config, exclude, positive_weight(df, label), **options)


def train_forest(df: DataFrame, label: str, exclude: tuple[str, ...] = (), trees: int = 200, max_depth: int = 0, **options) -> TreeModel:
    """A forest of balanced classes; trees grow until their nodes are pure unless ``max_depth`` says otherwise."""
    return fit_forest(df, label, trees, max_depth, exclude, balanced_weight(df, label), **options)


def with_scores(model, df: DataFrame, pred_col: str = "pred_proba", mode: str = "probability") -> DataFrame:
    """Adds the class-1 probability, or with ``mode='label'`` the predicted class."""
    scored = model.transform(df)
    value = vector_to_array("probability")[1] if mode == "probability" else F.col("prediction")
    return scored.select(*[F.col(f"`{c}`") for c in df.columns], value.alias(pred_col))


def feature_importance(spark: SparkSession, model: TreeModel, k: int | None = None) -> DataFrame:
    """(feature, importance), largest first; at most one row per feature."""
    table = spark.createDataFrame(list(model.importances().items()), "feature string, importance double")
    ranked = table.orderBy(F.desc("importance"), "feature")
    return ranked.limit(k) if k else ranked


@dataclass
class OversampledFit:
    model: TreeModel
    encoder: object  # the encoding pipeline, fitted on the training rows
    report: DataFrame  # classification report on the test rows
    class_counts: DataFrame  # (label, n, n_synthetic) of the rows the model learned from


def oversample_fit_report(
    df: DataFrame, keys: list[str], label: str, learner: str = "forest", config: dict | None = None,
    exclude: tuple[str, ...] = (), test_size: float = 0.2, seed: int = 42, k: int = 5, recall: float | None = None,
    trees: int = 200, **limits,
) -> OversampledFit:
    """Split, encode, raise the smaller class, fit, report: the encoder and the new rows come from training rows only.

    ``learner`` is ``forest`` (``trees`` of unlimited depth) or ``boosted`` (``config``). ``label`` is 0/1; several key
    columns name a row together."""
    parted = stratified_split(df, keys, label, test_size, seed)
    train, test = (parted.where(F.col("split") == s).drop("split") for s in ("train", "test"))
    fitted = fit_preprocessor(train, (label, *keys, *exclude))
    encoder = fitted.pipeline_model(train)
    name = F.concat_ws("|", *[field(c).cast("string") for c in keys]).alias("_key")
    with held(train):
        encoded = checkpointed(encoder.transform(train).select(name, label, "features"))
    search = {} if recall is None else {"recall": recall}
    grown = checkpointed(oversample(encoded, "_key", label, "features", k, seed, **search))
    counts = grown.groupBy(label).agg(F.count(F.lit(1)).alias("n"), F.count_if("synthetic").alias("n_synthetic"))
    rows, names = grown.select(label, "features"), fitted.feature_names
    if learner == "forest":
        model = fit_forest(rows, label, trees, seed=seed, vector="features", names=names, **limits)
    else:
        model = fit_boosted(rows, label, config or {}, seed=seed, vector="features", names=names, **limits)
    scored = model.transform(encoder.transform(test).select(label, "features"))
    said = scored.select(label, F.col("prediction").cast(df.schema[label].dataType).alias("said"))
    return OversampledFit(model, encoder, classification_report(said, label, "said"), counts)
