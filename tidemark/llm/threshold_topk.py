"""Exact top-k inner products by the three-phase uniform threshold over lists of partial scores.

A vector's components are cut into a few slices; every slice is a list that scores all vectors by the inner product of
that slice alone. A vector's score is the sum over the lists.

1. Every partition gathers, for each query and list, its k best entries by local score and sums them over all lists.
   The k-th best of these sums over all partitions is a cutoff that the k-th best answer cannot be below.
2. The cutoffs are broadcast. A vector whose score reaches a query's cutoff reaches cutoff / lists in at least one list,
   whatever the signs, so the entries that do are sufficient; all others are passed over.
3. The remaining lists of these entries are added, and those that reach the cutoff are ranked; a partition keeps the k
   best of each query, a window over all partitions takes the answer.

Queries are met in waves of a fixed number of bytes, dealt by a hash of the row, so what is broadcast (a wave's vectors
and cutoffs) is bounded; each wave scans the stored vectors twice, in place. Shuffled are at most k rows for each query
and partition, however often a vector or a score is repeated. Products are taken in doubles where no sum can leave
their 53 bits, else in 64-bit integers.

Defined results: null vectors and those with null or non-finite components take no part; a vector shorter than another
counts as zero beyond its end; repeated rows are candidates each, a query passes over its own row only; a null id is no
query, as a candidate it comes last among ties and is reported as null; scores beyond 64 bits are an error; other columns
are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .tables import stored
from .words import arrow_schema

#: Bytes of the query vectors that one wave broadcasts.
WAVE_BYTES = 16 << 20
#: Slices of a vector.
LISTS = 4
_ROWS, _COLUMNS = 1024, 2048

_FOUND = "query long, vec_id long, row long, score long"
_NO_ID = np.iinfo(np.int64).max


@dataclass
class _Wave:
    rows: np.ndarray  # row number of each query
    vectors: np.ndarray  # one column for each query
    lists: list[slice]
    k: int
    cutoff: np.ndarray | None = None


def _matrix(vectors: pa.Array, width: int, kind: type) -> np.ndarray:
    sizes = np.asarray(vectors.value_lengths(), np.int64)
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(kind)
    if len(flat) == len(sizes) * width:
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), kind)
    out[np.arange(width) < sizes[:, None]] = flat
    return out


class _Best:
    """The k best entries of each query so far: score descending, then id, then row."""

    def __init__(self, queries: int, k: int):
        self.k, self.floor = k, np.full(queries, -np.inf)
        self.held = tuple(np.zeros(0, np.int64) for _ in range(4))

    def add(self, query: np.ndarray, score: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        held = [np.concatenate(x) for x in zip(self.held, (query, score, ids, rows))]
        order = np.lexsort((held[3], held[2], -held[1], held[0]))
        query = held[0][order]
        first = np.searchsorted(query, query)
        kept = order[np.arange(len(order)) - first < self.k]
        self.held = tuple(x[kept] for x in held)
        last = np.searchsorted(self.held[0], np.arange(len(self.floor)), side="right") - 1
        full = np.searchsorted(self.held[0], np.arange(len(self.floor))) + self.k - 1 == last
        self.floor[full] = self.held[1][last[full]]

    def batch(self, schema: pa.Schema) -> pa.RecordBatch:
        query, score, ids, rows = self.held
        return pa.RecordBatch.from_arrays(
            [pa.array(query), pa.array(ids, mask=ids == _NO_ID), pa.array(rows), pa.array(score)], schema=schema)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(0, batch.num_rows, _ROWS):
            yield batch.slice(i, _ROWS)


def _gathered(lists: list[np.ndarray], k: int) -> tuple[np.ndarray, np.ndarray]:
    """Phase 1: (row, query) of the k best entries of every list, each pair once."""
    rows, queries = lists[0].shape
    if rows <= k:
        return tuple(x.ravel() for x in np.indices((rows, queries)))
    best = [np.argpartition(-local, k - 1, axis=0)[:k] for local in lists]
    cells = np.unique(np.concatenate([(b * queries + np.arange(queries)).ravel() for b in best]))
    return cells // queries, cells % queries


def _sufficient(lists: list[np.ndarray], floor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Phase 2: (row, query) of the entries that reach an equal share of the query's cutoff in some list."""
    share = np.ceil(floor / len(lists))
    reached = lists[0] >= share
    for local in lists[1:]:
        reached |= local >= share
    return np.nonzero(reached)


def _scan(shared, width: int, kind: type, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wave = shared.value
        best = _Best(len(wave.rows), wave.k)
        if wave.cutoff is not None:
            best.floor = wave.cutoff.copy()
        for piece in _pieces(batches):
            x = _matrix(piece.column("vector"), width, kind)
            ids = piece.column("vec_id").fill_null(_NO_ID).to_numpy(zero_copy_only=False)
            rows = piece.column("row").to_numpy(zero_copy_only=False)
            for a in range(0, len(wave.rows), _COLUMNS):
                z = min(a + _COLUMNS, len(wave.rows))
                lists = [x[:, s] @ wave.vectors[s, a:z] for s in wave.lists]
                r, q = _gathered(lists, wave.k + 1) if wave.cutoff is None else _sufficient(lists, best.floor[a:z])
                score = sum(local[r, q] for local in lists).astype(np.int64)
                q = q + a
                good = (score >= best.floor[q]) & (rows[r] != wave.rows[q])
                if good.any():
                    r, q = r[good], q[good]
                    best.add(q, score[good], ids[r], rows[r])
        if len(best.held[0]):
            yield best.batch(schema)

    return run


def top_products(vectors: DataFrame, k: int = 10, every: int = 100, scale: int = 1024, lists: int = LISTS,
                 wave_bytes: int = WAVE_BYTES, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """The ``k`` best of all other rows for each row whose id is divisible by ``every``: query_id, rank from 1, vec_id,
    score. A component x counts as floor(scale * x), a score is an integer inner product."""
    spark = vectors.sparkSession
    cells = F.col(f"`{vector_col}`")
    whole = F.forall(cells, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    rows = vectors.where(cells.isNotNull() & whole).select(
        F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.monotonically_increasing_id().alias("row"),
        F.transform(cells, lambda x: F.floor(x.cast("double") * scale)).alias("vector"))
    # Written once: from here on row numbers stay what they are.
    rows = stored(rows)
    asked = F.coalesce(F.col("vec_id") % every == 0, F.lit(False))
    size = rows.agg(F.count_if(asked).alias("queries"), F.max(F.size("vector")).alias("width"),
                    F.max(F.greatest(F.abs(F.array_max("vector")), F.abs(F.array_min("vector")))).alias("largest")).first()
    answer = "query_id long, rank int, vec_id long, score long"
    if not size.queries:
        return spark.createDataFrame([], answer)
    width, bound = size.width, (size.largest or 0) ** 2 * size.width
    if bound >= 1 << 63:
        raise OverflowError(f"inner products of {width} components up to {size.largest} may leave 64 bits")
    kind = np.float64 if bound < 1 << 53 else np.int64
    slices = [slice(int(part[0]), int(part[-1]) + 1) for part in np.array_split(np.arange(width), lists) if len(part)]
    waves = math.ceil(size.queries * max(width, 1) * 8 / wave_bytes)
    schema = arrow_schema(_FOUND)
    parts = []
    for i in range(waves):
        asking = rows.where(asked & (F.pmod(F.xxhash64("row"), F.lit(waves)) == i)).toArrow()
        if not asking.num_rows:
            continue
        wave = _Wave(asking["row"].to_numpy(), np.ascontiguousarray(_matrix(
            asking["vector"].combine_chunks(), width, kind).T), slices or [slice(0, 0)], k)
        shared = spark.sparkContext.broadcast(wave)
        gathered = rows.mapInArrow(_scan(shared, width, kind, schema), _FOUND)
        by_score = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "row")
        ranked = gathered.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= k)
        cutoff = ranked.groupBy("query").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("least")).where(f"n = {k}")
        cut = cutoff.select("query", "least").toArrow()
        wave.cutoff = np.full(len(wave.rows), -np.inf)
        wave.cutoff[cut["query"].to_numpy()] = cut["least"].to_numpy()
        second = spark.sparkContext.broadcast(wave)
        found = rows.mapInArrow(_scan(second, width, kind, schema), _FOUND)
        ranked = found.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= k)
        names = pa.table({"query": pa.array(np.arange(len(wave.rows))), "query_id": asking["vec_id"]})
        names = spark.createDataFrame(names)
        parts.append(stored(ranked.join(F.broadcast(names), "query").select("query_id", "rank", "vec_id", "score")))
        shared.destroy()
        second.destroy()
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
