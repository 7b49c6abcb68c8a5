"""Principal components with centring, and explained variance."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import PCA, StandardScaler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def with_vector(df: DataFrame, array_col: str, output: str = "features") -> DataFrame:
    """Adds an ML vector made from an array column."""
    return df.withColumn(output, array_to_vector(F.col(array_col).cast("array<double>")))


def fit_pca(df: DataFrame, k: int = 50, features: str = "features", output: str = "pca") -> PipelineModel:
    """Centres, then projects on ``k`` components.

    Spark's model does not centre on transform, so a mean-only scaler goes
    first. The covariance is a tree aggregation of a d x d matrix.
    """
    centre = StandardScaler(inputCol=features, outputCol="_centred", withMean=True, withStd=False)
    return Pipeline(stages=[centre, PCA(k=k, inputCol="_centred", outputCol=output)]).fit(df)


def explained_variance(spark, model: PipelineModel) -> DataFrame:
    """(component, ratio, cumulative), one row per component."""
    ratios = model.stages[-1].explainedVariance.toArray().tolist()
    table = spark.createDataFrame([(i + 1, float(r)) for i, r in enumerate(ratios)], "component int, ratio double")
    upto = Window.orderBy("component").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return table.withColumn("cumulative", F.sum("ratio").over(upto))
