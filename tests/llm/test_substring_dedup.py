"""Removed repeats against brute force over all windows."""

import hashlib

import pytest

from tidemark.llm.queries import op1_substring_dedup
from tidemark.llm.substring_dedup import remove_repeats, repeated_spans
from tidemark.llm.words import documents

SF_DIR = "/root/testdata/sf0.001"


def brute(rows, k):
    words = {i: (t or "").encode().split() for i, t in rows}
    least = {}
    for i in sorted(words):
        for p in range(len(words[i]) - k + 1):
            least.setdefault(tuple(words[i][p:p + k]), i)
    out = {}
    for i, w in words.items():
        gone = set()
        for p in range(len(w) - k + 1):
            if least[tuple(w[p:p + k])] < i:
                gone.update(range(p, p + k))
        out[i] = (len(w), len(gone), b" ".join(x for p, x in enumerate(w) if p not in gone).decode())
    return out


def run(spark, rows, k):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    return {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in remove_repeats(df, k).collect()}


def test_planted(spark):
    base = " ".join(f"w{i}" for i in range(120))
    loop = "a b c " * 60
    other = " ".join(f"x{i}" for i in range(30))
    rows = [
        (5, base), (2, other + " " + " ".join(base.split()[10:80]) + " tail"), (9, base), (11, None), (12, ""),
        (13, "  \n "), (20, loop), (21, "z " + loop), (22, " ".join(base.split()[30:80])),
        (23, " ".join(base.split()[30:79])), (24, "y " * 20000 + " ".join(base.split()[20:100])), (25, "é ü " * 70),
        (26, "q é ü " + "é ü " * 60), (30, base[:300] + " " + base), (31, "x" * 100000 + " " + base),
    ]
    for k in (50, 20, 7):
        assert run(spark, rows, k) == brute(rows, k)


def test_empty_and_extra_columns(spark):
    assert run(spark, [], 50) == {}
    df = spark.createDataFrame([(1, "a b", "p", 3, 4), (1, "a b", None, 3, 4)],
                               "doc_id long, text string, place string, source int, copied int")
    assert [(r.doc_id, r.n_removed) for r in remove_repeats(df, 2).collect()] == [(1, 0), (1, 0)]


def test_texts_that_share_an_id(spark):
    base, own = [f"w{i}" for i in range(120)], [f"x{i}" for i in range(60)]
    j = " ".join
    rows = [(1, j(base)), (5, "long " * 3 + j(own) + " " + j(base[20:100]) + " end"), (5, "short one"), (5, j(base)),
            (7, j(own)), (7, "z " + j(own[5:]) + " z"), (9, "last"), (9, "q " * 70 + j(base[:60]))]
    for parts in (1, 3):
        df = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
        got = sorted((r.doc_id, r.n_words, r.kept) for r in remove_repeats(df, 50).collect())
        assert got == sorted([
            (1, 120, j(base)), (5, 144, j(["long"] * 3 + own + ["end"])), (5, 2, "short one"), (5, 120, ""),
            (7, 60, ""), (7, 57, "z z"), (9, 1, "last"), (9, 130, j(["q"] * 70))])
    # Both texts of the smaller id are sources.
    rows = [(1, "a " + j(base)), (1, j(own) + " b"), (2, "c " + j(base[10:]) + " d " + j(own))]
    got = {r.kept for r in remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), 50).collect()}
    assert got == {"a " + j(base), j(own) + " b", "c d"}


def test_spans_name_their_source(spark):
    base = [f"w{i}" for i in range(90)]
    rows = [(1, " ".join(base)), (2, "a b " + " ".join(base[5:75])), (3, "c " + " ".join(base[5:75]) + " d")]
    _, spans = repeated_spans(documents(spark.createDataFrame(rows, "doc_id long, text string")), 50)
    texts = {i: t.split() for i, t in rows}
    got = spans.collect()
    assert {(r.doc_id, r.start, r.n_words) for r in got} == {(2, 2, 70), (3, 1, 70)}
    for r in got:
        assert (texts[r.doc_id][r.start:r.start + r.n_words]
                == texts[r.origin][r.origin_start:r.origin_start + r.n_words])


def test_query(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    want = brute([(r.doc_id, r.text) for r in docs], 50)
    got = op1_substring_dedup(spark, SF_DIR).collect()
    assert {(r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got} == {
        (i, n, g, hashlib.sha256(t.encode()).hexdigest()) for i, (n, g, t) in want.items()}
    assert any(r.n_removed for r in got)
