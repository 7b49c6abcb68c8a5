"""Hits against brute force, with one set and with several."""

import re

from tidemark.llm.decontamination import contamination
from tidemark.llm.queries import op9_decontamination

SF_DIR = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, n):
    grams = {}
    for i, t in items:
        w = words(t)
        size = min(n, len(w))
        for p in range(len(w) - size + 1) if size else ():
            grams.setdefault(tuple(w[p:p + size]), set()).add(i)
    sizes = {len(g) for g in grams}
    out = []
    for d, t in docs:
        w, hit, named = words(t), set(), set()
        for size in sizes:
            for p in range(len(w) - size + 1):
                if (g := tuple(w[p:p + size])) in grams:
                    hit.update(range(p, p + size))
                    named |= grams[g]
        out.append((d, len(w), len(hit), sorted(x for x in named if x is not None)))
    return sorted(out, key=repr)


def found(df):
    return sorted(((r.doc_id, r.n_words, sum(b - a for a, b in zip(r.starts, r.stops)), r["items"]) for r in df.collect()),
                  key=repr)


def test_planted(spark):
    test = " ".join(f"Q{i}" for i in range(25))
    items = [(1, test), (2, "short item, here"), (3, None), (4, ""), (5, test), (None, "nameless words stand here")]
    docs = [(1, None), (2, ""), (3, "a b c " + test.lower() + " d"), (4, "x-q3 q4/Q5 q6 q7;q8 q9 q10 q11 q12 y"),
            (5, "Short ITEM here short"), (6, "z " * 50000 + "short item here"), (7, "nameless words stand here"),
            (7, "nameless words stand here"), (8, "é\x00É q1"), (9, test + " " + test)]
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    i = spark.createDataFrame(items, "item_id long, text string")
    want = brute(docs, items, 10)
    assert found(contamination(d, i)) == want
    assert found(contamination(d, i, max_windows=5)) == want
    cleaned = {r.doc_id: r.cleaned for r in contamination(d, i, max_windows=5).collect()}
    assert cleaned[3] == "a b c  d" and cleaned[5] == " short" and cleaned[1] is None and cleaned[8] == "é\x00É q1"
    assert {r.doc_id: r.cleaned for r in contamination(d, i).collect()} == cleaned


def test_null_ids_with_several_sets(spark):
    test = " ".join(f"q{i}" for i in range(25))
    docs = [(None, "a " + test + " b"), (None, "c " + test), (None, "clean"), (None, None), (1, test + " d")]
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(2)
    i = spark.createDataFrame([(1, test)], "item_id long, text string")
    assert found(contamination(d, i, max_windows=5)) == brute(docs, [(1, test)], 10)
    assert {r.cleaned for r in contamination(d, i, max_windows=5).collect()} == {"a  b", "c ", "clean", None, " d"}


def test_empty_and_extra_columns(spark):
    d = spark.createDataFrame([(1, "a b", "s", 1)], "doc_id long, text string, items string, hash int")
    none = spark.createDataFrame([], "item_id long, text string")
    assert found(contamination(d, none)) == [(1, 2, 0, [])]
    assert found(contamination(d.where("false"), d.withColumnRenamed("doc_id", "item_id"))) == []


def test_query(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    got = op9_decontamination(spark, SF_DIR).collect()
    want = brute(docs, items, 10)
    assert sorted(((r.doc_id, r.n_words, r.n_hit, r.n_items) for r in got)) == sorted((a, b, c, len(d)) for a, b, c, d in want)
    assert any(r.contaminated for r in got)
