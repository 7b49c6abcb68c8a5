"""Answers against plain sorting of all products."""

import math

import numpy as np
import pytest

from tidemark.llm.queries import op11_threshold_topk
from tidemark.llm.threshold_topk import _gathered, _sufficient, top_products

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>"


def brute(rows, k, every, scale=1024):
    usable = [(i, [math.floor(float(x) * scale) for x in v]) for i, v in rows
              if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for n, (i, v) in enumerate(usable):
        if i is None or i % every:
            continue
        scores = sorted(((-sum(a * b for a, b in zip(v, w)), j is None, j or 0) for m, (j, w) in enumerate(usable) if m != n))
        out += [(i, r + 1, None if none else j, -s) for r, (s, none, j) in enumerate(scores[:k])]
    return sorted(out, key=repr)


def answer(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def vectors(n, d, seed):
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 0.3, (5, d))
    return [(i, [float(np.float32(x)) for x in centres[i % 5] + rng.normal(0, 0.1, d)]) for i in range(n)]


@pytest.mark.parametrize("lists,wave_bytes", [(1, 1 << 20), (3, 1 << 20), (4, 800), (40, 1 << 20)])
def test_against_brute_force(spark, lists, wave_bytes):
    rows = vectors(400, 12, 1)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert answer(top_products(df, k=7, every=20, lists=lists, wave_bytes=wave_bytes)) == brute(rows, 7, 20)


def test_odd_rows(spark):
    same = [0.5, -0.25, 0.125]
    rows = [(0, same), (0, same), (100, None), (200, [1.0, None, 2.0]), (300, [float("nan"), 1.0, 1.0]),
            (400, [float("inf"), 0.0, 0.0]), (None, same), (None, [9.0, 9.0, 9.0]), (500, [-1.0, -2.0]), (600, []),
            (700, [0.0, 0.0, 0.0]), *[(i, same) for i in range(1, 60)]]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], f"{SCHEMA}, row int, score string").repartition(4)
    assert answer(top_products(df)) == brute(rows, 10, 100)
    assert answer(top_products(df.where("vec_id = 700"))) == []
    assert answer(top_products(df.where("false"))) == []
    few = [(0, same), (100, [1.0, 0.0, 0.0]), (3, [0.0, 1.0, 0.0])]
    assert answer(top_products(spark.createDataFrame(few, SCHEMA))) == brute(few, 10, 100)


def test_large_components(spark):
    rows = [(i, [float((-1) ** i * (1 << 18) + i), 3.0 * i]) for i in range(0, 300)]
    assert answer(top_products(spark.createDataFrame(rows, SCHEMA), every=50)) == brute(rows, 10, 50)
    with pytest.raises(OverflowError):
        top_products(spark.createDataFrame([(0, [1e30]), (1, [1e30])], SCHEMA)).collect()


def test_phases_pass_over_most_entries():
    rng = np.random.default_rng(3)
    x, q = rng.integers(-100, 100, (2000, 16)).astype(float), rng.integers(-100, 100, (16, 5)).astype(float)
    lists = [x[:, s] @ q[s] for s in (slice(0, 8), slice(8, 16))]
    score = sum(lists)
    r, c = _gathered(lists, 11)
    floor = np.array([np.sort(score[r[c == j], j])[-10] for j in range(5)])
    r, c = _sufficient(lists, floor)
    assert len(r) < 0.25 * score.size
    for j in range(5):
        assert set(np.flatnonzero(score[:, j] >= floor[j])) <= set(r[c == j])


def test_query(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()]
    df = op11_threshold_topk(spark, SF_DIR)
    assert dict(df.dtypes) == {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "bigint"}
    assert answer(df) == brute(rows, 10, 100)
