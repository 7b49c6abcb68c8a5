"""run() and its stages against brute force."""

import re
from collections import defaultdict

import corpus_pipeline
from test_decontamination import WORD
from test_jaccard_join import brute as brute_classes
from test_substring_dedup import brute as brute_repeats

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def cleaned(text, hit):
    """Text without runs of hit words."""
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text)
    spans, at, out = [m.span() for m in WORD.finditer(lowered)], 0, ""
    for i, (a, b) in enumerate(spans):
        if i in hit:
            if i - 1 not in hit:
                out += text[at:a]
            at = b
    return out + text[at:]


def expected(rows, items):
    texts = {i: t for i, t in rows if i is not None and t and re.search(r"[^\W\d_]", t)}
    first = {i: c for i, _, c in brute_classes(sorted(texts.items()))}
    texts = {i: t for i, t in texts.items() if first[i] == i}
    repeats = brute_repeats(sorted(texts.items()), 50)
    texts = {i: (repeats[i][2] if repeats[i][1] else t) for i, t in texts.items() if repeats[i][1] < repeats[i][0]}
    grams = defaultdict(set)
    for i, t in items:
        w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        for p in range(len(w) - min(10, len(w)) + 1 if w else 0):
            grams[min(10, len(w))].add(tuple(w[p:p + min(10, len(w))]))
    out = {}
    for i, t in texts.items():
        w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t))
        hit = {q for size, own in grams.items() for p in range(len(w) - size + 1) if tuple(w[p:p + size]) in own
               for q in range(p, p + size)}
        if len(hit) < len(w) or not w:
            out[i] = cleaned(t, hit) if hit else t
    return out


def stages_until_packing(spark, docs, sf_dir):
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf_dir)
    return docs


def test_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    got = stages_until_packing(spark, docs, SF_DIR)
    assert got.columns == docs.columns
    rows = got.collect()
    want = expected([(r.doc_id, r.text) for r in docs.collect()], items)
    assert {r.doc_id: r.text for r in rows} == want and len(rows) == len(want) < docs.count()
    assert all(r.n_chars == len(r.text) for r in rows)


def test_odd_rows(spark):
    rows = [(None, "no id here", "en", "s", 1), (1, None, None, None, None), (2, "", "en", "s", 0), (3, "?!", "en", "s", 2),
            (4, "some words in a text", "en", None, 20), (4, "another row of the same id", "en", "s", 20),
            (5, "some words in a text", None, "s", 20), (6, "x" * 200000, "fr", "s", 200000)]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = stages_until_packing(spark, docs, SF_DIR).collect()
    assert {(r.doc_id, r.text) for r in got} == {
        (4, "another row of the same id"), (5, "some words in a text"), (6, "x" * 200000)}
    assert stages_until_packing(spark, docs.where("false"), SF_DIR).count() == 0


def test_run(spark):
    rows = corpus_pipeline.run(spark, SF_DIR).collect()
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    assert {r.doc_id for r in rows} == set(expected([(r.doc_id, r.text) for r in docs], items))
    assert sum(r.length for r in rows) == sum({r.doc_id: r.doc_tokens for r in rows}.values())
