"""k nearest neighbours inside each class, without an all-pairs join.

Points are dealt to cells by their nearest pivot, with cells in proportion to the class. A query visits cells nearest
pivot first. How many is measured: for a bounded sample of queries the true neighbours are found by a scan of all points,
and the least number of visits is taken that reaches the wanted recall on them. With ``recall=1.0`` the search is exact:
the visits made so far bound the distance a query still has to look, and by the triangle inequality a cell whose pivot
is farther than that bound plus the cell's radius holds no closer point.

Searches run on blocks of bounded size; only k rows per query leave one. Work is points times visits times a block, so
in proportion to the points where neighbours share cells; where they do not (distances that say little, in many
dimensions) the visits that the wanted recall takes show it.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import checkpointed

#: Pivots of a class; beyond so many cells, cells grow and are split into blocks.
MAX_PIVOTS = 4096
ROWS_PER_BLOCK = 4096
#: Points that a cell holds on average.
ROWS_PER_CELL = 1024
#: Queries per class whose true neighbours are looked up to choose the number of visits.
SAMPLE = 128
RECALL = 0.95
_QUERIES_AT_ONCE = 256


def matrix(vectors: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """(rows, dimensions) of a list column whose rows are equally long."""
    flat = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(flat), -1)


def _squares(queries: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Squared distances up to rounding."""
    out = queries @ points.T
    out *= -2
    out += np.einsum("ij,ij->i", queries, queries)[:, None]
    out += np.einsum("ij,ij->i", points, points)
    return np.maximum(out, 0, out=out)


def nearest_rows(qid: np.ndarray, queries: np.ndarray, pid: np.ndarray, points: np.ndarray, k: int):
    """(query index, point index, distance) of the k best points of each query, which never matches its own id.

    A product of matrices names all points that rounding could place among the best; their distances are then taken
    from differences, so equal points are at 0. Ties go to the smaller id: the answer does not depend on row order."""
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
    names = np.argsort(np.argsort(pid, kind="stable"), kind="stable")
    for lo in range(0, len(qid) if len(pid) else 0, _QUERIES_AT_ONCE):
        part = queries[lo:lo + _QUERIES_AT_ONCE]
        away = _squares(part, points)
        own = qid[lo:lo + _QUERIES_AT_ONCE, None] == pid[None, :]
        away[own] = np.inf
        nth = min(k, len(pid)) - 1
        slack = 1e-9 * (np.einsum("ij,ij->i", part, part) + np.einsum("ij,ij->i", points, points).max())
        q, p = np.nonzero(away <= (np.partition(away, nth, axis=1)[:, nth] + slack)[:, None])
        keep = ~own[q, p]
        q, p = q[keep], p[keep]
        diff = part[q] - points[p]
        exact = np.sqrt(np.einsum("ij,ij->i", diff, diff))
        order = np.lexsort((names[p], exact, q))
        q, p, exact = q[order], p[order], exact[order]
        best = np.arange(len(q)) - np.searchsorted(q, q) < k
        found.append((q[best] + lo, p[best], exact[best]))
    return tuple(np.concatenate(x) for x in zip(*found))


@dataclass
class _Cells:
    """Per class: pivots, the largest distance of a point to its pivot, blocks of each cell; and visits to make."""

    pivots: dict
    radius: dict
    blocks: dict
    visits: dict


def _by_label(batch: pa.RecordBatch) -> Iterator[tuple[object, np.ndarray]]:
    codes = batch.column("label").dictionary_encode()
    index = codes.indices.to_numpy(zero_copy_only=False)
    for i, label in enumerate(codes.dictionary.to_pylist()):
        yield label, np.flatnonzero(index == i)


def _assigner(pivots: dict, schema: pa.Schema) -> Callable:
    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell, away = np.zeros(batch.num_rows, np.int32), np.zeros(batch.num_rows)
            vectors = matrix(batch.column("vec"))
            for label, rows in _by_label(batch):
                for lo in range(0, len(rows), _QUERIES_AT_ONCE):
                    some = rows[lo:lo + _QUERIES_AT_ONCE]
                    cell[some] = _squares(vectors[some], pivots[label]).argmin(axis=1)
                    away[some] = np.linalg.norm(vectors[some] - pivots[label][cell[some]], axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell), pa.array(away)], schema=schema)

    return assign


def _router(shared, schema: pa.Schema, rest: bool) -> Callable:
    """The blocks that each query visits: those of its nearest cells, or with ``rest`` those its bound leaves open."""
    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = shared.value
        for batch in batches:
            vectors = matrix(batch.column("vec"))
            for label, rows in _by_label(batch):
                count, visits = len(cells.pivots[label]), cells.visits[label]
                for lo in range(0, len(rows), _QUERIES_AT_ONCE):
                    some = rows[lo:lo + _QUERIES_AT_ONCE]
                    away = np.sqrt(_squares(vectors[some], cells.pivots[label]))
                    order = np.argsort(away, axis=1, kind="stable")
                    wanted = np.zeros((len(some), count), bool)
                    if rest:
                        bound = batch.column("bound").fill_null(np.inf).to_numpy(zero_copy_only=False)[some]
                        # A hair of slack keeps rounding from skipping a tie.
                        wanted = away - cells.radius[label] <= (bound * (1 + 1e-6) + 1e-6)[:, None]
                        np.put_along_axis(wanted, order[:, :visits], False, axis=1)
                    else:
                        np.put_along_axis(wanted, order[:, :visits], True, axis=1)
                    q, c = np.nonzero(wanted)
                    times = cells.blocks[label][c]
                    block = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
                    source, cell = pa.array(some[np.repeat(q, times)]), np.repeat(c, times).astype(np.int32)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(n).take(source) for n in ("label", "id", "vec")]
                        + [pa.array(cell), pa.array(block.astype(np.int32))], schema=schema)

    return route


def _visit(k: int, schema: pa.Schema) -> Callable:
    def search(points: pa.Table, queries: pa.Table) -> pa.Table:
        if not points.num_rows or not queries.num_rows:
            return schema.empty_table()
        q, p, dist = nearest_rows(*(_named(queries)), *(_named(points)), k)
        return pa.table([points["label"].combine_chunks().take(pa.array(p)), queries["id"].combine_chunks().take(pa.array(q)),
                         points["id"].combine_chunks().take(pa.array(p)), pa.array(dist)], schema=schema)

    return search


def _named(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    return table["id"].to_numpy(), matrix(table["vec"])


def _scan(shared, k: int, schema: pa.Schema) -> Callable:
    """k best of every sampled query among the points of a partition, with their cells."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors, ids = matrix(batch.column("vec")), batch.column("id").to_numpy(zero_copy_only=False)
            cell = batch.column("cell").to_numpy()
            for label, rows in _by_label(batch):
                if label not in shared.value:
                    continue
                names, queries = shared.value[label]
                q, p, dist = nearest_rows(names, queries, ids[rows], vectors[rows], k)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("label").take(pa.array(rows[p])), pa.array(names[q]), pa.array(ids[rows[p]]),
                     pa.array(dist), pa.array(cell[rows[p]])], schema=schema)

    return run


def _arrow(df: DataFrame) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(df.schema)


def _typed(df: DataFrame, ddl: str) -> tuple[str, pa.Schema]:
    """A result schema beginning with the class column, as DDL and for Arrow."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    whole = f"label {df.schema['label'].dataType.simpleString()}, {ddl}"
    return whole, to_arrow_schema(_parse_datatype_string(whole))


def _visits(placed: DataFrame, sample: dict, pivots: dict, k: int, recall: float) -> dict:
    """The least number of nearest cells, per class, that hold ``recall`` of the sample's true neighbours."""
    ddl, schema = _typed(placed, "qid string, nid string, dist double, cell int")
    shared = placed.sparkSession.sparkContext.broadcast(sample)
    true = _best(placed.mapInArrow(_scan(shared, k, schema), ddl), k).select("label", "qid", "cell").collect()
    shared.destroy()
    place = {}
    for label, (names, queries) in sample.items():
        order = np.argsort(_squares(queries, pivots[label]), axis=1, kind="stable")
        rank = np.empty_like(order)
        np.put_along_axis(rank, order, np.arange(order.shape[1])[None, :].repeat(len(order), 0), axis=1)
        place[label] = dict(zip(names.tolist(), rank))
    needed: dict = {label: [] for label in sample}
    for r in true:
        needed[r["label"]].append(int(place[r["label"]][r["qid"]][r["cell"]]))
    return {label: 1 + sorted(n)[max(0, math.ceil(recall * len(n)) - 1)] if n else 1 for label, n in needed.items()}


def nearest_in_class(points: DataFrame, k: int = 5, rows_per_block: int = ROWS_PER_BLOCK, recall: float = RECALL,
                     rows_per_cell: int = ROWS_PER_CELL) -> DataFrame:
    """(label, qid, nid, dist, rank): the k nearest other points of each query.

    ``points`` is (label, id, vec array<double>, is_query boolean) with one row per distinct vector of a class; ``id``
    is a string. ``recall`` is the share of true neighbours that the sample must find; 1.0 finds all. The table is read
    several times, so hand in a checkpointed or stored one.
    """
    points = points.select("label", "id", "vec", "is_query")
    by_hash = Window.partitionBy("label").orderBy(F.xxhash64("id"), "id")
    sizes = {r["label"]: r["n"] for r in points.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    chosen = points.withColumn("r", F.row_number().over(by_hash)).where(F.col("r") <= MAX_PIVOTS)
    want = {label: min(MAX_PIVOTS, max(1, math.ceil(n / rows_per_cell))) for label, n in sizes.items()}
    need = F.lit(1)
    for label, n in want.items():
        need = F.when(F.col("label") == F.lit(label), F.lit(n)).otherwise(need)
    pivots: dict = {}
    for r in chosen.where(F.col("r") <= need).select("label", "vec").collect():  # MAX_PIVOTS rows per class at most
        pivots.setdefault(r["label"], []).append(r["vec"])
    pivots = {label: np.array(v, float) for label, v in pivots.items()}
    ddl, schema = _typed(points, "id string, vec array<double>, is_query boolean, cell int, to_pivot double")
    placed = checkpointed(points.mapInArrow(_assigner(pivots, schema), ddl))
    stats = placed.groupBy("label", "cell").agg(F.count(F.lit(1)).alias("n"), F.max("to_pivot").alias("radius")).collect()
    cells = _Cells(pivots, {lb: np.zeros(len(p)) for lb, p in pivots.items()},
                   {lb: np.zeros(len(p), np.int64) for lb, p in pivots.items()}, {lb: 1 for lb in pivots})
    for r in stats:  # one row per pivot
        cells.radius[r["label"]][r["cell"]] = r["radius"]
        cells.blocks[r["label"]][r["cell"]] = math.ceil(r["n"] / rows_per_block)
    if recall < 1 and any(len(p) > 1 for p in pivots.values()):
        some = placed.where("is_query").withColumn("r", F.row_number().over(by_hash)).where(F.col("r") <= SAMPLE)
        sample: dict = {}
        for r in some.select("label", "id", "vec").collect():  # SAMPLE rows per class at most
            sample.setdefault(r["label"], []).append((r["id"], r["vec"]))
        sample = {lb: (np.array([x[0] for x in v], object), np.array([x[1] for x in v], float)) for lb, v in sample.items()}
        cells.visits.update(_visits(placed, sample, pivots, k, recall))

    counts = placed.sparkSession.createDataFrame(
        [(lb, c, int(n)) for lb, b in cells.blocks.items() for c, n in enumerate(b)],
        f"label {points.schema['label'].dataType.simpleString()}, cell int, _blocks int")
    blocks = placed.join(F.broadcast(counts), ["label", "cell"]).withColumn(
        "block", F.pmod(F.xxhash64("id"), F.col("_blocks")).cast("int")).drop("_blocks", "to_pivot")
    shared = placed.sparkSession.sparkContext.broadcast(cells)
    near = _searched(blocks, blocks.where("is_query"), shared, k, rest=False)
    if recall < 1 or all(len(p) == 1 for p in pivots.values()):
        return near
    near = checkpointed(near)
    bounds = near.where(F.col("rank") == k).select("label", F.col("qid").alias("id"), F.col("dist").alias("bound"))
    asking = blocks.where("is_query").join(bounds, ["label", "id"], "left")
    far = _searched(blocks, asking, shared, k, rest=True)
    return _best(near.drop("rank").unionByName(far.drop("rank")), k)


def _searched(blocks: DataFrame, asking: DataFrame, shared, k: int, rest: bool) -> DataFrame:
    ddl, schema = _typed(blocks, "id string, vec array<double>, cell int, block int")
    columns = ["label", "id", "vec", *(["bound"] if rest else [])]
    wanted = asking.select(*columns).mapInArrow(_router(shared, schema, rest), ddl)
    wanted = wanted.toDF("q_label", "id", "vec", "q_cell", "q_block")
    ddl, schema = _typed(blocks, "qid string, nid string, dist double")
    found = blocks.select("label", "cell", "block", "id", "vec").groupBy("label", "cell", "block").cogroup(
        wanted.groupBy("q_label", "q_cell", "q_block")).applyInArrow(_visit(k, schema), ddl)
    return _best(found, k)


def _best(rows: DataFrame, k: int) -> DataFrame:
    ranked = rows.withColumn("rank", F.row_number().over(Window.partitionBy("label", "qid").orderBy("dist", "nid")))
    return ranked.where(F.col("rank") <= k)
