"""Principal components of wide, sparse vectors by a randomised range finder.

A random subspace of a few more dimensions than components wanted is multiplied by the covariance matrix a few times and
made orthogonal in between; the components lie in what it turns to. Each multiplication is one pass over the rows: a task
adds up x (x'Q) over its rows, Spark sums the tasks' matrices in slices of features, and the centre is taken off by
arithmetic, so vectors stay sparse and no matrix of features x features exists anywhere. The driver holds features x
(components + ``extra``) numbers.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .columns import field

EXTRA = 10
PASSES = 4
#: Numbers of one slice of a task's matrix.
_SLICE = 1 << 16
_SUMS = "slice int, body binary"


def _entries(vectors: pa.StructArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, index, value) of the entries of a vector column, sparse or dense."""
    values = vectors.field("values")
    sizes = np.asarray(values.value_lengths().fill_null(0), np.int64)
    row = np.repeat(np.arange(len(vectors)), sizes)
    place = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    sparse = vectors.field("type").to_numpy(zero_copy_only=False) == 0
    listed = vectors.field("indices")
    given = listed.flatten().to_numpy(zero_copy_only=False)
    index = place.copy()
    index[sparse[row]] = given
    return row, index, values.flatten().to_numpy(zero_copy_only=False)


def _product(row: np.ndarray, index: np.ndarray, value: np.ndarray, rows: int, matrix: np.ndarray) -> np.ndarray:
    """Vectors times a matrix of features x columns."""
    out = np.zeros((rows, matrix.shape[1]))
    np.add.at(out, row, value[:, None] * matrix[index])
    return out


def _summed(df: DataFrame, work: Callable, cells: int) -> np.ndarray:
    """Sum over all rows of what ``work`` adds to an array of ``cells`` numbers per task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(cells)
        for batch in batches:
            work(batch.column(0), total)
        for i in range(0, cells, _SLICE):
            yield pa.RecordBatch.from_arrays([pa.array([i // _SLICE], pa.int32()), pa.array([total[i:i + _SLICE].tobytes()])],
                                             names=["slice", "body"])

    def add(table: pa.Table) -> pa.Table:
        bodies = [np.frombuffer(b) for b in table["body"].to_pylist()]
        return pa.table({"slice": table["slice"][:1], "body": pa.array([np.sum(bodies, axis=0).tobytes()], pa.binary())})

    slices = df.mapInArrow(run, _SUMS).groupBy("slice").applyInArrow(add, _SUMS).toArrow().sort_by("slice")
    return np.concatenate([np.frombuffer(b) for b in slices["body"].to_pylist()]) if slices.num_rows else np.zeros(cells)


@dataclass
class Components:
    """``matrix`` is features x components; ``ratio`` the share of all variance of each."""

    mean: np.ndarray
    matrix: np.ndarray
    variance: np.ndarray
    total: float

    @property
    def ratio(self) -> np.ndarray:
        return self.variance / self.total if self.total else np.zeros(len(self.variance))

    def explained(self, spark: SparkSession) -> DataFrame:
        """(component, variance, ratio, cumulative), one row per component."""
        rows = zip(range(1, len(self.ratio) + 1), self.variance.tolist(), self.ratio.tolist(), np.cumsum(self.ratio).tolist())
        return spark.createDataFrame(list(rows), "component int, variance double, ratio double, cumulative double")

    def transform(self, df: DataFrame, features: str = "features", output: str = "pca") -> DataFrame:
        """Adds the centred scores as an array; any table with vectors of the same size."""
        shared = df.sparkSession.sparkContext.broadcast((self.mean @ self.matrix, self.matrix))
        names = [f"c{i}" for i in range(len(df.columns))]
        schema = T.StructType([*df.schema.fields, T.StructField(output, T.ArrayType(T.DoubleType()))])
        at = df.columns.index(features)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            offset, matrix = shared.value
            for batch in batches:
                scores = _product(*_entries(batch.column(at)), batch.num_rows, matrix) - offset
                ends = pa.array(np.arange(batch.num_rows + 1) * scores.shape[1], pa.int32())
                listed = pa.ListArray.from_arrays(ends, pa.array(np.ascontiguousarray(scores).ravel()))
                yield pa.RecordBatch.from_arrays([*batch.columns, listed], names=[*names, "scores"])

        renamed = T.StructType([T.StructField(n, f.dataType) for n, f in zip([*names, "scores"], schema.fields)])
        return df.toDF(*names).mapInArrow(run, renamed).toDF(*schema.names)


def fit_components(df: DataFrame, k: int = 50, features: str = "features", extra: int = EXTRA, passes: int = PASSES,
                   seed: int = 42) -> Components:
    """The ``k`` leading components of a vector column; ``df`` is read ``passes`` + 2 times, so hold it or store it."""
    rows = df.select(field(features).alias("v")).where(F.col("v").isNotNull())
    if not isinstance(rows.schema["v"].dataType, VectorUDT):
        raise TypeError(f"{features} is not a vector column")
    size = rows.selectExpr("v").limit(1).collect()
    if not size:
        raise ValueError("no rows to fit on")
    d = size[0]["v"].size
    k = min(k, d)

    def moments(vectors, total):
        row, index, value = _entries(vectors)
        np.add.at(total, index, value)
        np.add.at(total, d + index, value * value)
        total[2 * d] += len(vectors)

    sums = _summed(rows, moments, 2 * d + 1)
    n = sums[-1]
    mean = sums[:d] / n
    total = float((sums[d:2 * d] - n * mean * mean).sum() / max(n - 1, 1))

    def covariance_times(q: np.ndarray) -> np.ndarray:
        shared = df.sparkSession.sparkContext.broadcast(q)

        def multiply(vectors, out):
            row, index, value = _entries(vectors)
            product = _product(row, index, value, len(vectors), shared.value)
            np.add.at(out.reshape(d, -1), index, value[:, None] * product[row])

        raw = _summed(rows, multiply, q.size).reshape(q.shape)
        shared.destroy()
        return (raw - n * np.outer(mean, mean @ q)) / max(n - 1, 1)

    width = min(d, k + extra)
    q = np.linalg.qr(np.random.default_rng(seed).normal(size=(d, width)))[0]
    for _ in range(passes if width < d else 0):
        q = np.linalg.qr(covariance_times(q))[0]
    small = q.T @ covariance_times(q)
    values, vectors = np.linalg.eigh((small + small.T) / 2)
    order = np.argsort(values)[::-1][:k]
    return Components(mean, q @ vectors[:, order], np.maximum(values[order], 0.0), total)
