"""Tables written to the shared folder, and joins of documents with a side whose size is measured first."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import checkpoint_dir

#: A side up to this size, measured, is broadcast; a larger one is joined by a shuffle.
BROADCAST_BYTES = 32 << 20


#: Spark's setting that drops the shuffle files of an execution when it ends.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def new_path(spark: SparkSession) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/tidemark-{uuid.uuid4().hex}"


def stored(df: DataFrame, path: str | None = None, **options: str) -> DataFrame:
    """``df`` written once as Parquet in the session's shared folder: it survives lost executors and cuts the plan. With
    ``path``, over what is there. What was shuffled for it is dropped as soon as it is written."""
    spark = df.sparkSession
    path, before = path or new_path(spark), spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.options(**options).mode("overwrite").parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def joined(docs: DataFrame, side: DataFrame, on: list[str], how: str, row_bytes: Column | None = None,
           limit: int = BROADCAST_BYTES) -> DataFrame:
    """``docs`` with a stored side. The bytes of the side are summed first: a small one spares the texts a shuffle."""
    size = side.agg(F.sum(F.lit(16) if row_bytes is None else row_bytes)).first()[0] or 0
    return docs.join(F.broadcast(side) if size <= limit else side.hint("merge"), on, how)


def list_bytes(*columns: str, each: int = 8) -> Column:
    """Bytes of a row of array columns."""
    return sum((F.coalesce(F.size(c), F.lit(0)) * each + 16 for c in columns), F.lit(16))
