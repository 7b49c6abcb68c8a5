"""Gradients against differences, accuracy on held-out documents, defined results."""

import zlib

import numpy as np

from tidemark.llm.language_id import WINDOW, ByteNet, cut, identify, learn
from tidemark.llm.queries import op10_language_id


def test_gradient_equals_differences():
    rng = np.random.default_rng(0)
    net = ByteNet(["a", "b", "c"], state=3)
    for p in (net.ahead, net.behind):
        p.table, p.weights = p.table.astype(np.float64), p.weights.astype(np.float64)
    windows = rng.integers(0, 5, (4, WINDOW)).astype(np.uint8)
    weight = rng.normal(size=(WINDOW, 3, 4))

    def value():
        return sum(float((w * h).sum()) for w, h in zip(weight, net.ahead.states(np.ascontiguousarray(windows.T))))

    kept = []
    list(net.ahead.states(np.ascontiguousarray(windows.T), kept))
    table, weights = net.ahead.gradient(kept, list(weight))
    for own, grad in ((net.ahead.table, table), (net.ahead.weights, weights)):
        for at in [(0, 1), (4, 2), (8, 0)]:
            before = own[at]
            own[at] = before + 1e-3
            up = value()
            own[at] = before - 1e-3
            down = value()
            own[at] = before
            assert abs((up - down) / 2e-3 - grad[at]) < 0.02 * (1 + abs(grad[at]))


def test_cut_covers_every_byte():
    texts = [b"", b"x", b"y" * WINDOW, b"z" * (2 * WINDOW + 1)]
    windows, lengths, owner = cut(texts)
    for i, t in enumerate(texts):
        assert b"".join(w[:n].tobytes() for w, n, o in zip(windows, lengths, owner) if o == i) == t


def test_defined_results(spark):
    rows = [(1, None, "en"), (2, "", "en"), (3, "123 !? ._", "en"), (4, "hello there world", "en"), (8, "bonjour le monde", "fr"),
            (None, "und so weiter", None), (4, "hello there world", "en"), (9, "h" * 300000, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr("*", "1 AS order", "'q' AS held_out")
    net = learn(df, steps=5)
    assert net.labels == ["en", "fr"]
    got = identify(df, net).collect()
    assert len(got) == len(rows)
    for r in got:
        assert 0 <= r.score <= 1
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert (r.lang_pred == "und") == (r.doc_id in (1, 2, 3))
    assert {r.lang_pred for r in identify(df.withColumn("lang", df.lang.substr(1, 0)).withColumn("text", df.text.substr(1, 0))).collect()} == {"und"}
    assert identify(df.where("false")).count() == 0


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = [r for r in op10_language_id(spark, sf).collect() if r.held_out]
    right = sum(truth[r.doc_id] == r.lang_pred for r in got) / len(got)
    assert len(got) > 100 and right > 0.95, right
