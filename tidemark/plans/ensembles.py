"""Boosted trees and forests grown on Spark over columns binned once.

Rows are kept as blocks of up to ``BLOCK_CELLS`` cells. Rows of equal bins get equal scores from every tree, so a block
holds each combination of bins once, with the scores of every model so far, the (combination, label, weight, fold) kinds
of its rows, and of a row its kind and the hash that its draws come from. One boosting round grows one tree for every model
still learning, so a search fits all its configurations and folds together and the number of jobs does not grow with them.

* A level is one aggregation: tasks sum gradients and Hessians of their rows per (model, node, cell), Spark adds them up
  by that key, and a second exchange by (model, node) finds each node's best split. Only splits reach the driver.
* A node whose rows are few enough for one task is finished there: its rows are shuffled by (model, node) and the rest of
  its tree is grown at once. If the combinations of all rows fit a block (columns of few bins have few, whatever the rows)
  and their hashes do (``BLOCK_ROWS``), that holds from the root and needs no shuffle.
* Tasks are pure functions of their block, of the trees since scores were last written (``KEPT_TREES`` at most) and of
  seeds. Scores are folded into new, checkpointed blocks every few rounds, so a lost executor costs a block, not a model.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass, fields, replace

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast, StorageLevel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.binning import Binning, Layout, fit_binning
from ..operators.columns import field
from ..operators.ordering import held
from ..operators.trees import (
    Growth, Splits, Tree, best_splits, cell_sums, drawn_features, grow_here, mixed, seeded,
)
from ..session import checkpointed, give_back

#: Cells (rows x columns) of a block, and of a node that one task finishes.
BLOCK_CELLS = 1 << 20
#: Rows (12 bytes each) of a block whose combinations fit ``BLOCK_CELLS``.
BLOCK_ROWS = 1 << 23
#: Trees that tasks add to the written scores; then scores are written again.
KEPT_TREES = 32
#: Rows whose draws a task holds at a time.
DRAWS_AT_ONCE = 1 << 17
#: Bytes of trees that a worker scores with at a time; a larger tree is scored with alone.
SCORED_BYTES = 1 << 24
#: Rounds of one job where a block holds all rows of its models.
ROUNDS_AT_ONCE = 16

_PIECE = "codes binary, profile binary, y binary, w binary, fold binary, kind binary, draw binary"
_PIECE_TYPES = {"codes": np.int32, "profile": np.int32, "y": np.float32, "w": np.float64, "fold": np.int32,
                "kind": np.int32, "draw": np.uint64}
_BLOCK = f"grp int, {_PIECE}, score binary"
_TREE = "model int, round int, " + ", ".join(f"t_{f.name} binary" for f in fields(Tree))
_CELLS = "model int, node int, cell int, g double, h double, n long"
_SPLIT_NAMES = [f.name for f in fields(Splits)]
_SPLITS = "model int, " + ", ".join(f"s_{n} double" for n in _SPLIT_NAMES)
_NODE_ROWS = "model int, node int, codes binary, g binary, h binary, n binary"
_TYPES = {"column": np.int32, "code": np.int32, "missing_left": bool, "left": np.int32, "right": np.int32,
          "value": np.float64, "gain": np.float64, "cover": np.float64}


@dataclass(frozen=True)
class Learner:
    """One model of a fit: how its trees grow, how many, on which rows."""

    growth: Growth
    trees: int
    subsample: float = 1.0
    bootstrap: bool = False
    fold: int | None = None  # rows of this fold are held out
    seed: int = 42


def boost_learner(config: dict, fold: int | None = None, seed: int = 42) -> Learner:
    """A learner of boosted trees from a trial's configuration."""
    return Learner(
        Growth(max_depth=int(config["max_depth"]), reg_lambda=float(config.get("reg_lambda", 1.0)),
               reg_alpha=float(config.get("reg_alpha", 0.0)), gamma=float(config.get("gamma", 0.0)),
               min_child_weight=float(config.get("min_child_weight", 1.0)),
               columns=float(config.get("colsample_bytree", 1.0)), shrink=float(config["learning_rate"])),
        trees=int(config["n_estimators"]), subsample=float(config.get("subsample", 1.0)), fold=fold, seed=seed)


def forest_learner(features: int, max_depth: int = 0, min_rows: float = 0.0, seed: int = 42) -> Learner:
    """A learner of one forest tree: bootstrapped rows, the root of the number of features drawn at every node."""
    share = math.sqrt(features) / max(features, 1)
    return Learner(Growth(max_depth=max_depth, reg_lambda=0.0, min_child_weight=min_rows, columns=min(1.0, share),
                          per_node=True, mean=True), trees=1, bootstrap=True, seed=seed)


@dataclass
class _State:
    """What a job needs besides its blocks: learners, their trees since scores were written, the tree being grown."""

    layout: Layout
    learners: list[Learner]
    groups: list[list[int]]
    recent: dict[int, list[Tree]]
    growing: dict  # model -> rounds to grow, or the tree under way
    round: int


class _Block:
    """One row of the block table, its arrays restored."""

    def __init__(self, row: dict, layout: Layout):
        for name, kind in _PIECE_TYPES.items():
            setattr(self, name, np.frombuffer(row[name], kind))
        self.codes = self.codes.reshape(-1, layout.columns)
        self.n = len(self.codes)
        self.score = np.frombuffer(row["score"], np.float64).reshape(-1, self.n)
        self.rows = np.bincount(self.kind, minlength=len(self.y))
        self._last = None, None

    def scores(self, state: _State, place: int, model: int) -> np.ndarray:
        """The score of each combination of bins; models that average have none."""
        out = self.score[place].copy() if len(self.score) else np.zeros(self.n)
        for tree in state.recent.get(model, ()):
            out += tree.value[tree.leaves(self.codes, state.layout)]
        return out

    def drawn(self, seed: int, number: int) -> np.ndarray:
        """A uniform number per row; models of one seed share those of a round."""
        if self._last[0] != (seed, number):
            self._last = (seed, number), np.concatenate([u for _, u in self._draws(seed, number)] or [np.zeros(0)])
        return self._last[1]

    def _draws(self, seed: int, number: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(kind, uniform number) of the rows, a part of them at a time."""
        name = np.uint64(seeded(seed, number, 1))
        for lo in range(0, len(self.draw), DRAWS_AT_ONCE):
            yield self.kind[lo:lo + DRAWS_AT_ONCE], _uniform(self.draw[lo:lo + DRAWS_AT_ONCE] ^ name)

    def bootstrapped(self, seed: int, number: int) -> tuple[np.ndarray, np.ndarray]:
        """(rows drawn at all, draws) of each kind."""
        rows, times = np.zeros(len(self.y)), np.zeros(len(self.y))
        for kind, u in self._draws(seed, number):  # rows are ordered by kind
            first, each = kind[0], _poisson(u)
            for total, x in ((rows, each > 0), (times, each)):
                some = np.bincount(kind - first, weights=x)
                total[first:first + len(some)] += some
        return rows, times

    def gradients(self, learner: Learner, number: int, scores: np.ndarray):
        """(combination, g, h, rows) over the rows a model learns from in a round."""
        rows = times = self.rows  # of each kind
        if learner.bootstrap:
            rows, times = self.bootstrapped(learner.seed, number)
        elif learner.subsample < 1:
            rows = times = np.bincount(self.kind[self.drawn(learner.seed, number) < learner.subsample], minlength=len(self.y))
        if learner.fold is not None:
            rows, times = (np.where(self.fold != learner.fold, x, 0) for x in (rows, times))
        w = self.w * times
        w, wy, n = (np.bincount(self.profile, weights=x, minlength=self.n) for x in (w, w * self.y, rows))
        used = np.flatnonzero(n)
        w, wy, n = w[used], wy[used], n[used]
        if learner.growth.mean:
            return used, wy, w, n
        p = 1 / (1 + np.exp(-scores[used]))
        return used, p * w - wy, np.maximum(p * (1 - p), 1e-16) * w, n


def _uniform(x: np.ndarray) -> np.ndarray:
    return (mixed(x) >> np.uint64(11)).astype(np.float64) / (1 << 53)


#: The distribution function of a Poisson variable of mean 1.
_POISSON = np.cumsum([math.exp(-1) / math.factorial(i) for i in range(20)])


def _poisson(u: np.ndarray) -> np.ndarray:
    return np.searchsorted(_POISSON, u, side="right")


def _distinct(columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(a row of each distinct combination, in order; the number of every row's combination)."""
    order = np.lexsort(columns[::-1])
    new = np.zeros(len(order), bool)
    new[:1] = True
    for c in columns:
        own = c[order]
        new[1:] |= own[1:] != own[:-1]
    number = np.empty(len(order), np.int32)
    number[order] = np.cumsum(new) - 1
    return order[new], number


def _piece(codes, profile, y, w, fold, kind, draw) -> dict:
    """The arrays of a block: equal combinations of bins and equal kinds become one, rows are ordered by kind and draw."""
    first, number = _distinct(list(codes.T))
    return _packed(codes[first], number[profile], y, w, fold, kind, draw)


def _packed(codes, profile, y, w, fold, kind, draw) -> dict:
    """The arrays of a block whose combinations are distinct already."""
    some, of = _distinct([profile, y, w, fold])
    kind = of[kind]
    order = np.lexsort((draw, kind))
    arrays = {"codes": codes, "profile": profile[some], "y": y[some], "w": w[some], "fold": fold[some],
              "kind": kind[order], "draw": draw[order]}
    return {n: np.ascontiguousarray(arrays[n], k).tobytes() for n, k in _PIECE_TYPES.items()}


def _pieces(binning: Binning, cells: int):
    limit = max(1, cells // max(binning.layout.columns, 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                part = batch.slice(at, limit - size)
                held.append(part)
                at, size = at + part.num_rows, size + part.num_rows
                if size == limit:
                    yield pack(held)
                    held, size = [], 0
        if held:
            yield pack(held)
        batch = part = held = None
        give_back()

    def pack(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        batch = pa.concat_batches(held)
        get = lambda c, k: batch.column(c).to_numpy(zero_copy_only=False).astype(k)
        codes, each = binning.codes([batch.column(i) for i in range(4, batch.num_columns)]), np.arange(batch.num_rows)
        draw = batch.column(3).to_numpy(zero_copy_only=False).view(np.uint64)
        return _batch([_piece(codes, each, get(0, np.float32), get(1, np.float64), get(2, np.int32), each, draw)], _PIECE)

    return run


def _combinations(columns: int):
    """A hash of each combination of bins in a piece."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for body in batch.column(0):
                codes, name = np.frombuffer(body.as_py(), np.int32).reshape(-1, columns), np.uint64(0)
                for c in codes.T:
                    name = mixed(name + c.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
                yield pa.RecordBatch.from_arrays([pa.array(name.view(np.int64))], ["name"])

    return run


def _merged(columns: int, groups: list[list[int]], mean: bool):
    """All pieces of a group as one block. Combinations are joined a piece at a time, so only distinct ones add up."""
    def run(table: pa.Table) -> pa.Table:
        every = lambda n: [np.frombuffer(body.as_buffer(), _PIECE_TYPES[n]) for body in table[n]]
        codes, steps = np.zeros((0, columns), np.int32), []
        for part in every("codes"):
            known, both = len(codes), np.concatenate([codes, part.reshape(-1, columns)])
            first, number = _distinct(list(both.T))
            codes = both[first]
            steps.append((number[:known], number[known:]))
        at, numbers = np.arange(len(codes), dtype=np.int32), []
        for old, new in reversed(steps):
            numbers.append(at[new])
            at = at[old]
        profile = np.concatenate([own[x] for own, x in zip(reversed(numbers), every("profile"))])
        starts = np.cumsum([0, *(len(x) for x in every("y"))]).astype(np.int32)
        kind = np.concatenate([x + at for x, at in zip(every("kind"), starts)])
        row = _packed(codes, profile, *(np.concatenate(every(n)) for n in ("y", "w", "fold")), kind, np.concatenate(every("draw")))
        grp = table["grp"][0].as_py()
        del table, kind
        out = pa.Table.from_batches([_batch([{"grp": grp, **row, "score": _zeros(groups[grp], len(codes), mean)}], _BLOCK)])
        row = None
        give_back()
        return out

    return run


def _zeros(models: list[int], combinations: int, mean: bool) -> bytes:
    """A score of 0 for each model and combination; none where models average."""
    return b"" if mean else np.zeros(len(models) * combinations).tobytes()


def _unscored(groups: list[list[int]], columns: int, mean: bool):
    """Blocks with a score of 0 for each model of their group and combination."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                yield _batch([{**row, "score": _zeros(groups[row["grp"]], len(row["codes"]) // (4 * columns), mean)}], _BLOCK)
        batch = row = None
        give_back()

    return run


def _dealt(learners: list[Learner], groups: int) -> list[list[int]]:
    """Models by group, the costly ones first and each to the group that has least to do."""
    cost = [m.trees * (m.growth.max_depth or 12) for m in learners]
    out, load = [[] for _ in range(groups)], [0] * groups
    for m in sorted(range(len(learners)), key=lambda m: -cost[m]):
        at = load.index(min(load))
        out[at].append(m)
        load[at] += cost[m]
    return out


def _schema(ddl: str) -> pa.Schema:
    kinds = {"int": pa.int32(), "long": pa.int64(), "double": pa.float64(), "binary": pa.binary(), "float": pa.float32()}
    return pa.schema([(n, kinds[k]) for n, k in (c.split() for c in ddl.split(", "))])


def _batch(rows: list[dict], ddl: str) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=_schema(ddl))


def _over_blocks(shared, work: Callable) -> Callable:
    """``work(state, row, block)`` on every block; it yields batches."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                yield from work(shared.value, row, _Block(row, shared.value.layout))
        batch = row = None
        give_back()

    return run


def _tree_row(model: int, number: int, tree: Tree) -> dict:
    return {"model": model, "round": number, **{f"t_{n}": np.ascontiguousarray(getattr(tree, n)).tobytes() for n in _TYPES}}


def _tree(row: dict) -> Tree:
    return Tree(**{n: np.frombuffer(row[f"t_{n}"], k).copy() for n, k in _TYPES.items()})


def _allowed(layout: Layout, learner: Learner, number: int) -> np.ndarray | None:
    if learner.growth.per_node or learner.growth.columns >= 1:
        return None
    return drawn_features(layout.features, learner.growth.columns, seeded(learner.seed, number, 2))


def _whole_trees(state: _State, row: dict, block: _Block) -> Iterator[pa.RecordBatch]:
    """A block that holds all rows of its models: their next trees, each on the scores that the ones before left."""
    group = [(place, model) for place, model in enumerate(state.groups[row["grp"]]) if state.growing.get(model)]
    scores = {model: block.scores(state, place, model) for place, model in group}
    for number in range(state.round, state.round + max((state.growing[m] for _, m in group), default=0)):
        for _, model in group:
            learner = state.learners[model]
            if number >= state.round + state.growing[model]:
                continue
            used, g, h, n = block.gradients(learner, number, scores[model])
            tree = Tree.root() if not len(used) else grow_here(
                block.codes[used], g, h, n, state.layout, learner.growth, seeded(learner.seed, number, 3),
                _allowed(state.layout, learner, number))
            if not learner.growth.mean:
                scores[model] += tree.value[tree.leaves(block.codes, state.layout)]
            yield _batch([_tree_row(model, number, tree)], _TREE)


def _level_sums(state: _State, row: dict, block: _Block) -> Iterator[pa.RecordBatch]:
    """Sums of gradients and Hessians over this block per (model, open node, cell)."""
    for place, model in enumerate(state.groups[row["grp"]]):
        if model not in state.growing:
            continue
        tree = state.growing[model]
        used, g, h, n = block.gradients(state.learners[model], state.round, block.scores(state, place, model))
        at = tree.leaves(block.codes[used], state.layout)
        open_nodes = tree.open
        inside = np.isin(at, open_nodes)
        if not inside.any():
            continue
        here = np.searchsorted(open_nodes, at[inside])
        node, cell, g, h, n = cell_sums(
            here, block.codes[used[inside]], g[inside], h[inside], n[inside], state.layout, len(open_nodes))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(node), model, np.int32)), pa.array(open_nodes[node].astype(np.int32)),
             pa.array(cell.astype(np.int32)), pa.array(g), pa.array(h), pa.array(n.astype(np.int64))], schema=_schema(_CELLS))


def _level_splits(shared) -> Callable:
    """Best split of each (model, node) whose cells are in this partition."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, held = shared.value, [b for b in batches if b.num_rows]
        if not held:
            return
        whole = pa.Table.from_batches(held)
        columns = [whole.column(c).to_numpy() for c in range(6)]
        order = np.lexsort((columns[2], columns[1], columns[0]))
        columns = [c[order] for c in columns]
        for model in np.unique(columns[0]).tolist():
            node, cell, g, h, n = (c[columns[0] == model] for c in columns[1:])
            learner = state.learners[model]
            out = best_splits(node, cell, g, h, n, state.layout, learner.growth, _allowed(state.layout, learner, state.round),
                              seeded(learner.seed, state.round, 3))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(out.node), model, np.int32)),
                 *(pa.array(getattr(out, name).astype(np.float64)) for name in _SPLIT_NAMES)], schema=_schema(_SPLITS))

    return run


def _small_rows(state: _State, row: dict, block: _Block) -> Iterator[pa.RecordBatch]:
    """The rows of nodes that a task finishes, one piece per (model, node) and block."""
    for place, model in enumerate(state.groups[row["grp"]]):
        if model not in state.growing or not len(state.growing[model].small):
            continue
        tree = state.growing[model]
        used, g, h, n = block.gradients(state.learners[model], state.round, block.scores(state, place, model))
        at = tree.leaves(block.codes[used], state.layout)
        for node in np.intersect1d(at, tree.small).tolist():
            own = at == node
            yield _batch([{"model": model, "node": node, "codes": block.codes[used[own]].tobytes(), "g": g[own].tobytes(),
                           "h": h[own].tobytes(), "n": n[own].tobytes()}], _NODE_ROWS)


def _finish(shared) -> Callable:
    def grow(table: pa.Table) -> pa.Table:
        state, model, node = shared.value, table["model"][0].as_py(), table["node"][0].as_py()
        join = lambda c, k: np.frombuffer(b"".join(table[c].to_pylist()), k)
        codes = join("codes", np.int32).reshape(-1, state.layout.columns)
        g, h, n = (join(c, np.float64) for c in "ghn")
        order = np.lexsort((h, g, *codes.T))  # the same tree whatever order the pieces came in
        learner = state.learners[model]
        tree = grow_here(codes[order], g[order], h[order], n[order], state.layout, learner.growth, seeded(learner.seed, state.round, 4 + node),
                         _allowed(state.layout, learner, state.round), state.growing[model].depth_of[node])
        return pa.Table.from_batches([_batch([{"node": node, **_tree_row(model, state.round, tree)}], "node int, " + _TREE)])

    return grow


class _Growing(Tree):
    """A tree under way: open nodes of the current level, and nodes left to be finished in a task."""

    @classmethod
    def start(cls, small: bool) -> _Growing:
        root = Tree.root()
        tree = cls(**{f.name: getattr(root, f.name) for f in fields(Tree)})
        tree.depth_of = {0: 0}
        tree.open = np.zeros(0 if small else 1, np.int64)
        tree.small = np.zeros(1 if small else 0, np.int64)
        return tree

    def done(self) -> Tree:
        return Tree(**{f.name: getattr(self, f.name) for f in fields(Tree)})


def _scored(state: _State, row: dict, block: _Block) -> Iterator[pa.RecordBatch]:
    score = [block.scores(state, place, model) for place, model in enumerate(state.groups[row["grp"]]) if len(block.score)]
    yield _batch([{**row, "score": np.concatenate(score).tobytes() if score else b""}], _BLOCK)


_HELD_OUT = "model int, y float, score double"


def _held_out(state: _State, row: dict, block: _Block) -> Iterator[pa.RecordBatch]:
    for place, model in enumerate(state.groups[row["grp"]]):
        kinds = np.flatnonzero(block.fold == state.learners[model].fold)
        kinds = np.repeat(kinds, block.rows[kinds])
        p = 1 / (1 + np.exp(-block.scores(state, place, model)[block.profile[kinds]]))
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(kinds), model, np.int32)), pa.array(block.y[kinds]), pa.array(p)],
                                         schema=_schema(_HELD_OUT))


class Ensemble:
    """The fit of several learners on one table."""

    def __init__(self, df: DataFrame, label: str, binning: Binning, learners: list[Learner], weight: Column | None = None,
                 fold: str | None = None, keys: list[str] | None = None, block_cells: int = BLOCK_CELLS,
                 kept_trees: int = KEPT_TREES):
        """``keys`` name a row in draws of rows; without them its values do."""
        self.spark, self.binning, self.learners = df.sparkSession, binning, learners
        self.block_cells, self.kept_trees = block_cells, kept_trees
        self.trees: list[list[Tree]] = [[] for _ in learners]
        df = df.where(field(label).isNotNull())
        rows = df.select(
            field(label).cast("float"), (F.lit(1.0) if weight is None else weight).cast("double"),
            (F.lit(-1) if fold is None else field(fold)).cast("int"),
            F.xxhash64(*[field(c) for c in keys or df.columns]), *binning.projected(df))
        rows = rows.toDF(*[f"b{i}" for i in range(len(rows.columns))])
        self.rows = df.count()
        layout = binning.layout
        if not layout.columns:
            raise ValueError("no column to learn from")
        columns, wanted = layout.columns, max(1, math.ceil(self.rows * layout.columns / block_cells))
        blocks = rows.coalesce(wanted).mapInArrow(_pieces(binning, block_cells), _PIECE)
        self.whole = wanted == 1  # every block holds all rows
        if wanted > 1:
            pieces = blocks = self._held(blocks)
            if self.rows <= BLOCK_ROWS:
                found = pieces.select("codes").mapInArrow(_combinations(columns), "name long").distinct().count()
                self.whole = found * columns <= block_cells
        workers = self.spark.sparkContext.defaultParallelism
        dealt = min(len(learners), workers) if self.whole else 1
        self.groups = _dealt(learners, dealt)
        self.state = _State(layout, learners, self.groups, {}, {}, 0)
        blocks = blocks.withColumn("grp", F.explode(F.array(*map(F.lit, range(dealt)))) if dealt > 1 else F.lit(0))
        blocks, mean = blocks.repartition(dealt, "grp") if dealt > 1 else blocks, all(m.growth.mean for m in learners)
        if self.whole and wanted > 1:
            blocks = blocks.groupBy("grp").applyInArrow(_merged(columns, self.groups, mean), _BLOCK)
        else:
            blocks = blocks.select("grp", *_PIECE_TYPES, F.lit(None).cast("binary").alias("score")).mapInArrow(
                _unscored(self.groups, columns, mean), _BLOCK)
        self.blocks = self._held(blocks)
        if wanted > 1:
            pieces.unpersist()

    def _held(self, blocks: DataFrame) -> DataFrame:
        return checkpointed(blocks).persist(StorageLevel.MEMORY_AND_DISK)

    def _job(self, work: Callable, ddl: str) -> DataFrame:
        self.shared = self.spark.sparkContext.broadcast(self.state)
        return self.blocks.mapInArrow(_over_blocks(self.shared, work), ddl)

    def fit(self) -> Ensemble:
        done, most = 0, max((m.trees for m in self.learners), default=0)
        while done < most:
            rounds = min(ROUNDS_AT_ONCE, self.kept_trees, most - done) if self.whole else 1
            self._grow(done, rounds)
            done += rounds
            if any(len(kept) + rounds > self.kept_trees for kept in self.state.recent.values()):
                self._write_scores()
        return self

    def _grow(self, number: int, rounds: int) -> None:
        """The next trees of all models that are still learning."""
        learning = {m: min(rounds, learner.trees - number) for m, learner in enumerate(self.learners) if learner.trees > number}
        self.state.round = number
        if self.whole:
            self.state.growing = learning
            rows = self._job(_whole_trees, _TREE).toArrow().to_pylist()
            self.shared.destroy()
            grown = {(r["model"], r["round"]): _tree(r) for r in rows}
        else:
            grown = {(m, number): tree for m, tree in self._grow_by_levels(list(learning)).items()}
        for m, times in learning.items():
            trees = [grown.get((m, n), Tree.root()) for n in range(number, number + times)]
            self.trees[m] += trees
            if not self.learners[m].growth.mean:
                self.state.recent.setdefault(m, []).extend(trees)
        self.state.growing = {}

    def _grow_by_levels(self, learning: list[int]) -> dict[int, Tree]:
        columns = self.state.layout.columns
        fits = lambda rows: rows * columns <= self.block_cells
        growing = {m: _Growing.start(fits(self.rows)) for m in learning}
        while any(len(t.open) for t in growing.values()):
            self.state.growing = {m: t for m, t in growing.items() if len(t.open)}
            sums = self._job(_level_sums, _CELLS).groupBy("model", "node", "cell").agg(
                F.sum("g").alias("g"), F.sum("h").alias("h"), F.sum("n").alias("n"))
            nodes = sum(len(t.open) for t in self.state.growing.values())
            spread = min(nodes, int(self.spark.conf.get("spark.sql.shuffle.partitions")))
            found = sums.repartition(spread, "model", "node").mapInArrow(_level_splits(self.shared), _SPLITS).toArrow()
            self.shared.destroy()
            for m, tree in self.state.growing.items():
                mine = found.filter(pc.equal(found["model"], m))
                splits = Splits(*(mine[f"s_{n}"].to_numpy() for n in _SPLIT_NAMES))
                splits = Splits(**{n: getattr(splits, n)[np.argsort(splits.node)].astype(
                    {"node": np.int64, "column": np.int64, "code": np.int64, "missing_left": bool}.get(n, np.float64))
                    for n in _SPLIT_NAMES})
                self._next_level(tree, splits, self.learners[m].growth, fits)
        self.state.growing = {m: t for m, t in growing.items() if len(t.small)}
        if self.state.growing:
            done = self._job(_small_rows, _NODE_ROWS).groupBy("model", "node").applyInArrow(
                _finish(self.shared), "node int, " + _TREE).toArrow().to_pylist()
            self.shared.destroy()
            for r in sorted(done, key=lambda r: (r["model"], r["node"])):
                growing[r["model"]].graft(r["node"], _tree(r))
        return {m: t.done() for m, t in growing.items()}

    @staticmethod
    def _next_level(tree: _Growing, splits: Splits, growth: Growth, fits: Callable) -> None:
        if not len(splits.node):
            tree.open = np.zeros(0, np.int64)
            return
        depth = tree.depth_of[int(splits.node[0])]
        if growth.max_depth and depth >= growth.max_depth:
            splits.column[:] = -1
        children = tree.grow(splits, splits.node, growth)
        cut = splits.column >= 0
        rows = np.stack([splits.left_rows[cut], (splits.rows - splits.left_rows)[cut]], 1).ravel()
        tree.depth_of.update(dict.fromkeys(children.tolist(), depth + 1))
        if growth.max_depth and depth + 1 >= growth.max_depth:
            children, rows = children[:0], rows[:0]  # leaves by their depth; their values are known
        small = fits(rows)
        tree.small = np.concatenate([tree.small, children[small]])
        tree.open = children[~small]

    def _write_scores(self) -> None:
        if not self.state.recent:
            return
        old, shared = self.blocks, None
        new = self._job(_scored, _BLOCK)
        shared = self.shared
        self.blocks = self._held(new)
        old.unpersist()
        shared.destroy()
        self.state.recent = {}

    def held_out_scores(self) -> DataFrame:
        """(model, y, score) of the rows each learner did not see."""
        return self._job(_held_out, _HELD_OUT)

    def model(self, m: int = 0) -> TreeModel:
        return TreeModel(self.binning, self.trees[m], "logistic")

    def close(self) -> None:
        self.blocks.unpersist()


@dataclass
class TreeModel:
    """Fitted trees: ``logistic`` adds them up to log-odds, ``mean`` averages them."""

    binning: Binning
    trees: list[Tree]
    kind: str

    def score(self, df: DataFrame) -> Column:
        """Probability of class 1 as a column of ``df``. Workers hold all trees; with ``transform`` they hold some at a time."""
        return self._added(df, self.trees)[0]

    def _added(self, df: DataFrame, trees: list[Tree], begun: Column | None = None, more: bool = False) -> tuple[Column, Broadcast]:
        """``begun`` plus what ``trees`` add to it, or without ``more`` the probability that results; and what workers hold."""
        slim = [replace(t, gain=t.gain[:0], cover=t.cover[:0]) for t in trees]
        shared = df.sparkSession.sparkContext.broadcast((self.binning, slim, self.kind, len(self.trees)))
        names = [f"b{i}" for i in range(len(self.binning.projected(df)))]

        @F.pandas_udf("double")
        def probability(frames: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
            binning, trees, kind, every = shared.value
            for frame in frames:
                columns = [pa.array(frame[n], from_pandas=not binning.vector or n != "b0") for n in names]
                codes = binning.codes(columns)
                total = frame["begun"].to_numpy(np.float64, copy=True)
                for tree in trees:
                    total += tree.value[tree.leaves(codes, binning.layout)]
                if not more:
                    total = 1 / (1 + np.exp(-total)) if kind == "logistic" else total / max(every, 1)
                yield pd.Series(total)

        begun = F.lit(0.0) if begun is None else begun
        return probability(F.struct(*[c.alias(n) for c, n in zip(self.binning.projected(df), names)], begun.alias("begun"))), shared

    def _parts(self) -> list[list[Tree]]:
        """The trees in their order, ``SCORED_BYTES`` of them at a time."""
        out, size = [[]], 0
        for tree in self.trees:
            own = sum(getattr(tree, n).nbytes for n in _TYPES if n not in ("gain", "cover"))
            if out[-1] and size + own > SCORED_BYTES:
                out, size = [*out, []], 0
            out[-1].append(tree)
            size += own
        return out

    def transform(self, df: DataFrame) -> DataFrame:
        """Adds ``probability`` (a vector of both classes) and ``prediction``. Trees beyond ``SCORED_BYTES`` (forests grown
        until nodes are pure) are added up in several passes, each checkpointed."""
        *before, last = self._parts()
        begun, p = None, F.col("_p")
        for trees in before:
            total, shared = self._added(df, trees, begun, more=True)
            with held(df.withColumn("_p", total)) as part:
                df, begun = checkpointed(part), p
            shared.destroy()
        scored = df.withColumn("_p", self._added(df, last, begun)[0])
        return scored.withColumns({
            "probability": array_to_vector(F.array(1.0 - p, p)), "prediction": (p >= 0.5).cast("double")}).drop("_p")

    def tree_table(self, spark: SparkSession) -> DataFrame:
        """(tree, node, feature, threshold, category, missing_left, left, right, value, gain, cover): one row per node."""
        numeric, categories = list(self.binning.cuts), list(self.binning.categories)
        rows = []
        for t, tree in enumerate(self.trees):
            for i in range(len(tree.column)):
                c, code = int(tree.column[i]), int(tree.code[i])
                name = threshold = category = None
                if 0 <= c < len(numeric):
                    cuts = self.binning.cuts[numeric[c]]
                    name, threshold = numeric[c], float(cuts[code]) if code < len(cuts) else float("inf")
                elif c >= 0:
                    name = categories[c - len(numeric)]
                    category = self.binning.categories[name][code]
                leaf = c < 0
                rows.append((t, i, name, threshold, category, None if leaf or category is not None else bool(tree.missing_left[i]),
                             None if leaf else int(tree.left[i]), None if leaf else int(tree.right[i]),
                             float(tree.value[i]), float(tree.gain[i]), float(tree.cover[i])))
        return spark.createDataFrame(rows, "tree int, node int, feature string, threshold double, category string, "
                                           "missing_left boolean, left int, right int, value double, gain double, cover double")

    def importances(self) -> dict[str, float]:
        """Share of each feature: mean gain of its splits (logistic), or mean over trees of its share of gains (mean)."""
        layout, names = self.binning.layout, self.binning.names
        total, splits = np.zeros(len(names)), np.zeros(len(names))
        for tree in self.trees:
            inner = tree.column >= 0
            at = layout.feature[layout.offsets[tree.column[inner]] + tree.code[inner]]
            at = np.where(layout.is_category[tree.column[inner]], at, tree.column[inner])
            own = np.bincount(at, weights=tree.gain[inner], minlength=len(names))
            if self.kind == "logistic":
                total += own
                splits += np.bincount(at, minlength=len(names))
            elif own.sum() > 0:
                total += own / own.sum()
        if self.kind == "logistic":
            total = total / np.maximum(splits, 1)
        return dict(zip(names, (total / total.sum() if total.sum() > 0 else total).tolist()))

    def save(self, spark: SparkSession, path: str) -> None:
        """Bins and trees as one Parquet folder; an earlier model there is replaced."""
        meta = json.dumps({"cuts": list(self.binning.cuts.items()), "categories": list(self.binning.categories.items()),
                           "vector": self.binning.vector, "kind": self.kind})
        rows = [(i, "", *(v for k, v in _tree_row(0, 0, t).items() if k.startswith("t_"))) for i, t in enumerate(self.trees)]
        ddl = "number int, meta string, " + _TREE.removeprefix("model int, round int, ")
        rows.append((-1, meta, *(b"" for _ in _TYPES)))
        spark.createDataFrame(rows, ddl).coalesce(1).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> TreeModel:
        rows = [r.asDict() for r in spark.read.parquet(path).orderBy("number").collect()]
        meta = json.loads(rows[0]["meta"])
        binning = Binning(dict(meta["cuts"]), dict(meta["categories"]), meta["vector"])
        return cls(binning, [_tree(r) for r in rows[1:]], meta["kind"])


def fit_boosted(df: DataFrame, label: str, config: dict, exclude: tuple[str, ...] = (), weight: Column | None = None,
                seed: int = 42, vector: str | None = None, names: list[str] | None = None, keys: list[str] | None = None,
                **limits) -> TreeModel:
    """One model of boosted trees on a 0/1 label, from raw columns or from one vector column."""
    binning = fit_binning(df, (label, *exclude), int(config.get("max_bins", 256)), vector, names)
    fit = Ensemble(df, label, binning, [boost_learner(config, seed=seed)], weight, keys=keys, **limits).fit()
    fit.close()
    return fit.model()


def fit_forest(df: DataFrame, label: str, trees: int = 200, max_depth: int = 0, exclude: tuple[str, ...] = (),
               weight: Column | None = None, seed: int = 42, vector: str | None = None, names: list[str] | None = None,
               keys: list[str] | None = None, trees_at_once: int = 64, **limits) -> TreeModel:
    """A forest on a 0/1 label; ``max_depth`` 0 grows until nodes are pure. Trees are grown side by side."""
    binning = fit_binning(df, (label, *exclude), 256, vector, names)
    one = forest_learner(len(binning.names), max_depth)
    grown: list[Tree] = []
    for first in range(0, trees, trees_at_once):
        learners = [replace(one, seed=seed * 1_000 + t) for t in range(first, min(trees, first + trees_at_once))]
        fit = Ensemble(df, label, binning, learners, weight, keys=keys, **limits).fit()
        fit.close()
        grown += [t for own in fit.trees for t in own]
    return TreeModel(binning, grown, "mean")
