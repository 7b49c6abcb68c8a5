"""Boosted trees and forests against a plain split search; level-wise growth against growth in one task."""

import math
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tidemark.operators import trees
from tidemark.operators.binning import Layout, fit_binning
from tidemark.operators.evaluation import binary_metrics
from tidemark.operators.trees import Growth, Tree, grow_here
from tidemark.plans import ensembles
from tidemark.plans.ensembles import Ensemble, TreeModel, _dealt, boost_learner, fit_boosted, fit_forest, forest_learner
from tidemark.plans.training import feature_importance, train_boosted, train_forest, with_scores

CONFIG = {"n_estimators": 3, "max_depth": 3, "learning_rate": 0.3, "subsample": 1.0, "colsample_bytree": 1.0,
          "min_child_weight": 1.0, "reg_alpha": 0.0, "reg_lambda": 1.0}


def rows(n=300, seed=5):
    r = np.random.default_rng(seed)
    out = []
    for i in range(n):
        x, z, k = round(float(r.normal()), 2), float(r.integers(0, 9)), "uvwx"[int(r.integers(0, 4))]
        y = int(r.random() < 1 / (1 + math.exp(-(2 * x + (k == "u") + (z > 6)))))
        out.append((i, x if r.random() > 0.15 else None, z, k if r.random() > 0.1 else None, y))
    return out


@pytest.fixture(scope="module")
def data(spark):
    return spark.createDataFrame(rows(), "id bigint, x double, z double, k string, y int").repartition(3).cache()


def shrink(g, alpha):
    return math.copysign(max(abs(g) - alpha, 0.0), g)


def brute_tree(samples, grads, config, depth=0):
    """(gain, description, left, right) or (leaf value): every cut, category and missing side is tried."""
    lam, alpha, mcw = config["reg_lambda"], config["reg_alpha"], config["min_child_weight"]
    score = lambda gh: shrink(gh[0], alpha) ** 2 / (gh[1] + lam)
    total = lambda idx: (sum(grads[i][0] for i in idx), sum(grads[i][1] for i in idx))
    here = list(samples)
    leaf = -config["learning_rate"] * shrink(total(here)[0], alpha) / (total(here)[1] + lam)
    if depth == config["max_depth"] or len(here) < 2:
        return leaf
    tries = []
    for c in ("x", "z"):
        values = sorted({samples[i][c] for i in here if samples[i][c] is not None})
        for cut in [*values[1:], math.inf]:
            for missing_left in (False, True):
                tries.append(((c, cut, missing_left), [
                    i for i in here if (missing_left if samples[i][c] is None else samples[i][c] < cut)]))
    for cat in ("v", "w", "x", None):
        tries.append((("k", cat, None), [i for i in here if samples[i]["k"] != cat]))
    best = (1e-6, None, None, None)
    for what, left in tries:
        right = [i for i in here if i not in set(left)]
        a, b = total(left), total(right)
        if not left or not right or a[1] < mcw or b[1] < mcw:
            continue
        gain = score(a) + score(b) - score(total(here))
        if gain > best[0] + 1e-9:
            best = (gain, what, left, right)
    if best[1] is None:
        return leaf
    sub = lambda idx: brute_tree({i: samples[i] for i in idx}, grads, config, depth + 1)
    return best[0], best[1], sub(best[2]), sub(best[3])


def shape(model: TreeModel, t: int, node: int = 0):
    """A fitted tree as (gain, left, right) and leaf values."""
    tree: Tree = model.trees[t]
    if tree.column[node] < 0:
        return round(float(tree.value[node]), 9)
    return (round(float(tree.gain[node]), 9), shape(model, t, int(tree.left[node])), shape(model, t, int(tree.right[node])))


def brute_shape(tree):
    return round(tree, 9) if isinstance(tree, float) else (round(tree[0], 9), brute_shape(tree[2]), brute_shape(tree[3]))


@pytest.mark.parametrize("change", [{}, {"reg_lambda": 7.5}, {"reg_alpha": 3.0}, {"min_child_weight": 9.0}])
@pytest.mark.parametrize("cells", [1 << 20, 90])
def test_first_trees_equal_a_split_search(data, change, cells):
    config = {**CONFIG, **change}
    model = fit_boosted(data, "y", config, ("id",), keys=["id"], block_cells=cells)
    samples = {r["id"]: r.asDict() for r in data.collect()}
    margin = dict.fromkeys(samples, 0.0)

    def value(tree, s):
        while not isinstance(tree, float):
            c, at, missing_left = tree[1]
            left = s[c] != at if c == "k" else (missing_left if s[c] is None else s[c] < at)
            tree = tree[2] if left else tree[3]
        return tree

    for t in range(2):
        p = {i: 1 / (1 + math.exp(-m)) for i, m in margin.items()}
        grads = {i: (p[i] - samples[i]["y"], p[i] * (1 - p[i])) for i in samples}
        want = brute_tree(samples, grads, config)
        assert shape(model, t) == brute_shape(want)
        margin = {i: m + value(want, samples[i]) for i, m in margin.items()}


def same(a: TreeModel, b: TreeModel):
    for s, t in zip(a.trees, b.trees, strict=True):
        assert sorted(zip(s.column.tolist(), s.code.tolist(), np.round(s.cover, 6).tolist(), np.round(s.value, 9).tolist())) == sorted(
            zip(t.column.tolist(), t.code.tolist(), np.round(t.cover, 6).tolist(), np.round(t.value, 9).tolist()))


def test_levels_and_tasks_grow_the_same_trees(data):
    config = {**CONFIG, "n_estimators": 4, "max_depth": 4, "subsample": 0.7, "colsample_bytree": 0.6}
    one = fit_boosted(data, "y", config, ("id",), keys=["id"])
    same(one, fit_boosted(data, "y", config, ("id",), keys=["id"], block_cells=120, kept_trees=2))
    same(one, fit_boosted(data, "y", config, ("id",), keys=["id"], block_cells=1, kept_trees=3))  # levels only
    assert len({t.column[0] for t in one.trees}) > 1  # columns are drawn per tree
    other = fit_boosted(data, "y", {**config, "reg_lambda": 50.0}, ("id",), keys=["id"])
    assert any(not np.array_equal(a.value, b.value) for a, b in zip(one.trees, other.trees))


def test_models_side_by_side_equal_models_alone(spark, data):
    folded = data.withColumn("fold", (F.col("id") % 3).cast("int"))
    binning = fit_binning(data, ("id", "y"))
    configs = [CONFIG, {**CONFIG, "n_estimators": 5, "subsample": 0.8}]
    learners = [boost_learner(c, f) for c in configs for f in range(3)]
    fit = Ensemble(folded, "y", binning, learners, fold="fold", keys=["id"]).fit()
    alone = Ensemble(folded, "y", binning, [learners[4]], fold="fold", keys=["id"]).fit()
    same(fit.model(4), alone.model())
    scores = fit.held_out_scores().groupBy("model").count().collect()
    assert sorted((r["model"], r["count"]) for r in scores) == [(m, 100) for m in range(6)]
    got = sorted(r["score"] for r in fit.held_out_scores().where("model = 1").collect())
    want = sorted(r["pred_proba"] for r in with_scores(fit.model(1), folded.where("fold = 1")).collect())
    assert got == pytest.approx(want)


def test_scores_importances_and_tables(spark, data, tmp_path):
    model = train_boosted(data, "y", {**CONFIG, "n_estimators": 20}, ("id",), keys=["id"])
    scored = with_scores(model, data)
    assert scored.columns == [*data.columns, "pred_proba"]
    assert binary_metrics(scored, "y", "pred_proba").first()["auc"] > 0.85
    assert {r["pred_proba"] for r in with_scores(model, data, mode="label").collect()} == {0.0, 1.0}
    top = feature_importance(spark, model).collect()
    assert top[0]["feature"] == "x" and sum(r["importance"] for r in top) == pytest.approx(1)
    assert {r["feature"] for r in top} == {"x", "z", "k_v", "k_w", "k_x", "k_nan"}
    nodes = model.tree_table(spark)
    assert nodes.where("tree = 0 AND node = 0").first()["cover"] > 0 and nodes.select("tree").distinct().count() == 20
    model.save(spark, str(tmp_path / "m"))
    again = TreeModel.load(spark, str(tmp_path / "m"))
    unseen = spark.createDataFrame([(1, None, float("nan"), "never", 0), (2, math.inf, None, None, 1)], data.schema)
    for df in (data, unseen):
        assert [r[0] for r in df.select(again.score(df)).collect()] == [r[0] for r in df.select(model.score(df)).collect()]


def test_forest(spark, data):
    forest = train_forest(data, "y", ("id",), trees=12, keys=["id"], trees_at_once=5)
    assert binary_metrics(with_scores(forest, data), "y", "pred_proba").first()["auc"] > 0.95
    # No depth limit: leaves are pure.
    assert all(v in (0, 1) or v == pytest.approx(round(v)) for t in forest.trees for v in t.value[t.column < 0]) or len(
        {(r["x"], r["z"], r["k"]) for r in data.collect()}) < data.count()
    same(forest, train_forest(data, "y", ("id",), trees=12, keys=["id"]))
    levels = train_forest(data, "y", ("id",), trees=4, max_depth=4, keys=["id"], block_cells=200)
    assert max(len(t.column) for t in levels.trees) <= 31
    assert binary_metrics(with_scores(levels, data), "y", "pred_proba").first()["auc"] > 0.75


def test_vector_column_and_odd_frames(spark, data):
    vectors = data.select("y", array_to_vector(F.array(F.coalesce("x", F.lit(0.0)), "z")).alias("features"))
    wide = data.select("y", F.coalesce("x", F.lit(0.0)).alias("feature_0"), F.col("z").alias("feature_1"))
    same(fit_boosted(vectors, "y", CONFIG, vector="features"), fit_boosted(wide, "y", CONFIG))
    empty = fit_boosted(data.where("false"), "y", CONFIG, ("id",))
    assert [r[0] for r in data.limit(2).select(empty.score(data)).collect()] == [0.5, 0.5]
    one_class = fit_forest(data.where("y = 1"), "y", 2, exclude=("id",))
    assert {r[0] for r in data.select(one_class.score(data)).collect()} == {1.0}
    with pytest.raises(ValueError, match="no column"):
        fit_boosted(data.select("y"), "y", CONFIG)


def test_cuts_are_order_statistics_of_many_rows(spark):
    n = 40_000
    values = spark.range(n).select((F.col("id") * 7919 % n).cast("double").alias("x"), F.lit(0).alias("y"))
    exact = sorted({float(math.ceil(i / 256 * n) - 1) for i in range(1, 256)})
    assert fit_binning(values, ("y",)).cuts["x"] == exact
    vectors = values.select(array_to_vector(F.array("x")).alias("v"))
    assert fit_binning(vectors, vector="v", names=["x"]).cuts["x"] == exact


def test_rows_of_like_bins_are_learned_from_as_one(spark):
    few = spark.createDataFrame([(i, float(i * 7 % 11), "uvw"[i * 5 % 3], int(i * 2654435761 % 97 < 30 + i % 11 * 4)) for i in range(3000)],
                                "id bigint, x double, k string, y int").withColumn("fold", (F.col("id") % 3).cast("int")).repartition(4)
    binning = fit_binning(few, ("id", "y", "fold"))
    learners = [boost_learner({**CONFIG, "subsample": 0.7, "reg_lambda": lam}, f) for lam in (1.0, 3.0) for f in range(3)]
    fits = [Ensemble(few, "y", binning, learners, fold="fold", keys=["id"], block_cells=cells).fit() for cells in (1 << 20, 500, 60)]
    assert [f.whole for f in fits] == [True, True, False]  # 33 combinations of 2 bins
    for m in range(len(learners)):
        same(fits[0].model(m), fits[1].model(m))
        same(fits[0].model(m), fits[2].model(m))
    counts = fits[1].held_out_scores().groupBy("model").count().collect()
    assert sorted((r["model"], r["count"]) for r in counts) == [(m, 1000) for m in range(6)]
    assert len(fits[1].blocks.select("codes").first()["codes"]) == 4 * 2 * 33


def test_blocks_of_averaging_models_carry_no_scores(data):
    binning = fit_binning(data, ("id", "y"))
    forest = Ensemble(data, "y", binning, [forest_learner(len(binning.names), seed=t) for t in range(64)], keys=["id"], block_cells=300)
    assert {len(r["score"]) for r in forest.blocks.select("score").collect()} == {0}
    boosted = Ensemble(data, "y", binning, [boost_learner(CONFIG)], keys=["id"], block_cells=300)
    assert all(len(r["score"]) == 8 * (len(r["codes"]) // 12) for r in boosted.blocks.collect())


def test_models_are_dealt_by_cost():
    learners = [boost_learner({**CONFIG, "n_estimators": n, "max_depth": 5}) for n in (900, 100, 100, 800, 100, 100)]
    groups = _dealt(learners, 2)
    assert sorted(m for g in groups for m in g) == list(range(6))
    loads = [sum(learners[m].trees for m in g) for g in groups]
    assert max(loads) - min(loads) <= 100


def test_no_sums_are_taken_at_the_greatest_depth(monkeypatch):
    from tidemark.operators import trees
    from tidemark.operators.binning import Layout

    levels, cell_sums = [], trees.cell_sums
    monkeypatch.setattr(trees, "cell_sums", lambda *a: levels.append(a[-1]) or cell_sums(*a))
    codes, n = np.arange(64, dtype=np.int32)[:, None], np.ones(64)
    tree = grow_here(codes, np.select([codes[:, 0] < 9, codes[:, 0] < 30, codes[:, 0] < 41], [-1.0, 1.0, -2.0], 0.5), 0.25 * n, n, Layout([63], []), Growth(max_depth=2, min_child_weight=0), 1)
    assert levels == [1, 2] and (tree.column >= 0).sum() == 2
    assert tree.value[tree.column < 0].all() and tree.cover[tree.column < 0].sum() == 16


def most_held(work):
    """(result, MB of arrays that ``work`` held at most)."""
    tracemalloc.start()
    try:
        return work(), tracemalloc.get_traced_memory()[1] / (1 << 20)
    finally:
        tracemalloc.stop()


@pytest.mark.parametrize("kind", ["logistic", "mean"])
def test_workers_score_with_some_trees_at_a_time(spark, data, monkeypatch, kind):
    fit = fit_boosted if kind == "logistic" else fit_forest
    model = fit(data, "y", *([{**CONFIG, "n_estimators": 9}] if kind == "logistic" else [9]), exclude=("id",), keys=["id"])
    want = {r["id"]: r["p"] for r in data.select("id", model.score(data).alias("p")).collect()}
    sent, broadcast, limit = [], spark.sparkContext.broadcast, 3 * 24 * max(len(t.column) for t in model.trees)
    monkeypatch.setattr(type(spark.sparkContext), "broadcast", lambda self, value: sent.append(value) or broadcast(value))
    monkeypatch.setattr(ensembles, "SCORED_BYTES", limit, raising=False)
    got = {r["id"]: r["pred_proba"] for r in with_scores(model, data).collect()}
    assert got == want and len(sent) > 2
    assert all(sum(getattr(t, n).nbytes for t in value[1] for n in t.__dict__) <= limit for value in sent)
    assert sum(len(value[1]) for value in sent) == 9


def test_growing_a_tree_holds_sums_of_some_nodes_at_a_time(monkeypatch):
    r = np.random.default_rng(3)
    layout = Layout([60] * 20, [])
    codes, y, n = r.integers(0, 61, (30_000, 20), np.int32), r.integers(0, 2, 30_000).astype(float), np.ones(30_000)
    growth = Growth(max_depth=12, reg_lambda=0.0, min_child_weight=0.0, columns=0.3, per_node=True, mean=True)
    grown, most = most_held(lambda: grow_here(codes, y, n, n, layout, growth, 5))
    assert most < 20  # 36 MB when all nodes of a level are summed up at once
    monkeypatch.setattr(trees, "CELLS_AT_ONCE", 1 << 30)
    whole = grow_here(codes, y, n, n, layout, growth, 5)
    assert len(whole.column) > 1000 and all(np.array_equal(getattr(grown, f), getattr(whole, f)) for f in whole.__dict__)


def piece(r, rows):
    """Rows of 12 columns that have few combinations of bins."""
    codes = r.integers(0, 4, (rows, 1), np.int32) + r.integers(0, 1000, (rows, 1), np.int32) * np.arange(12, dtype=np.int32)
    each = np.arange(rows)
    return ensembles._piece(codes, each, (codes[:, 0] % 2).astype(np.float32), np.ones(rows), np.full(rows, -1, np.int32), each,
                            r.integers(0, 1 << 62, rows).astype(np.uint64))


def test_pieces_are_joined_one_at_a_time():
    r = np.random.default_rng(4)
    pieces = [piece(r, 20_000) for _ in range(60)]
    table = pa.Table.from_batches([ensembles._batch([{"grp": 0, **p} for p in pieces], "grp int, " + ensembles._PIECE)])
    merged, most = most_held(lambda: ensembles._merged(12, [[0]], True)(table).to_pylist()[0])
    assert len(merged["codes"]) == 4000 * 12 * 4 and len(merged["draw"]) == 8 * 60 * 20_000 and merged["score"] == b""
    assert most < 8 * len(merged["draw"]) / (1 << 20)
    read = lambda p, n: np.frombuffer(p[n], ensembles._PIECE_TYPES[n])

    def listed(p):
        kind = read(p, "kind")
        return np.column_stack([read(p, "codes").reshape(-1, 12)[read(p, "profile")][kind], read(p, "y")[kind], read(p, "draw")])

    rows = np.concatenate([listed(p) for p in pieces])
    assert np.array_equal(listed(merged)[np.argsort(read(merged, "draw"))], rows[np.argsort(rows[:, -1])])


def test_rows_are_drawn_some_at_a_time(monkeypatch):
    layout = Layout([1003] * 12, [])
    block = ensembles._Block({**piece(np.random.default_rng(6), 1_000_000), "score": b""}, layout)
    learner = forest_learner(12, seed=9)
    got, most = most_held(lambda: block.gradients(learner, 0, np.zeros(block.n)))
    assert most < 16  # 31 MB when all rows are drawn at once
    monkeypatch.setattr(ensembles, "DRAWS_AT_ONCE", 1 << 30)
    want = block.gradients(learner, 0, np.zeros(block.n))
    assert all(np.array_equal(a, b) for a, b in zip(got, want)) and got[3].sum() == pytest.approx(632_121, rel=0.01)
