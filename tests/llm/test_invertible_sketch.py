"""Recovered differences against set differences; edited texts and neighbours against a plain walk."""

import hashlib
import random

from pyspark.sql import functions as F

from tidemark.llm.invertible_sketch import difference, fingerprints, paragraphs
from tidemark.llm.queries import op6_document_fingerprints

SF_DIR = "/root/testdata/sf0.001"


def test_differences_are_recovered(spark):
    rng, rows = random.Random(4), []
    for k in (0, 1, 2, 5, 20, 100, 700):
        for other in (0, 1, k // 10, k):
            shared = [rng.randrange(-2**63, 2**63) for _ in range(k)]
            rows.append((shared + [rng.randrange(-2**63, 2**63) for _ in range(other)],
                         shared + [rng.randrange(-2**63, 2**63) for _ in range(other // 2)]))
    rows.append(([0, 1, -1], [0]))
    df = spark.createDataFrame(rows, "a array<long>, b array<long>").repartition(2)
    for r in df.select("a", "b", difference(F.col("a"), F.col("b")).alias("d")).collect():
        want = {(1, x) for x in set(r.a) - set(r.b)} | {(-1, x) for x in set(r.b) - set(r.a)}
        assert {(d.n, d.k) for d in r.d} == want and len(r.d) == len(want)


def check(got, docs):
    docs = sorted(((i, t or "") for i, t in docs), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    rows = {(r.doc_id, r.n_chars, r.edited_sha256): r for r in got}
    prints = {}
    assert len(got) == len(docs)
    for (i, t), (_, after) in zip(docs, docs[1:] + docs[:1]):
        half = len(t) // 2
        edited = t[:len(t) - half] + after[:half]
        r = rows[(i, len(t), hashlib.sha256(edited.encode()).hexdigest())]
        assert prints.setdefault(t, r.fingerprint) == r.fingerprint
        assert prints.setdefault(edited, r.edited_fingerprint) == r.edited_fingerprint
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        assert (r.near_next == 1) >= (t == after)
    return rows


def test_planted(spark):
    rng = random.Random(1)
    text = lambda n: " ".join(rng.choice(["ab", "cé.", "d\n", "日本.", "e!"]) + str(rng.randrange(99)) for _ in range(n))
    docs = [(i * 7 % 61 - 9, text(rng.randrange(60))) for i in range(50)] + [
        (100, None), (101, ""), (102, "\n\n"), (103, "x"), (104, "same"), (105, "same"), (None, "nobody"),
        (103, "y twice"), (103, "y twice"), (5000, text(30000)), (1 << 40, "far away"), (-(1 << 40), "far before")]
    df = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, block int").repartition(3)
    for block in (4, 512):
        check(fingerprints(df, block=block).collect(), docs)
    assert fingerprints(df.where("false")).count() == 0


def test_short_sentences_are_paragraphs(spark):
    docs = [(1, "One. Two! Three? Four. Five. Six."), (2, "Uno. Due! Tre? Quattro. Cinque. Sei.")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert [r.n for r in df.select(F.size(paragraphs(F.col("text"))).alias("n")).collect()] == [6, 6]
    assert all(0 < r.near_edited < 1 and r.near_next == 0 for r in fingerprints(df).collect())


def test_query(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    got = op6_document_fingerprints(spark, SF_DIR).collect()
    check(got, docs)
    assert sum(r.near_edited > r.near_next for r in got) > 0.9 * len(got)
    own = spark.createDataFrame(docs, "doc_id long, text string").select("doc_id", paragraphs(F.col("text")).alias("p"))
    sets = [set(r.p) for r in own.orderBy("doc_id").collect()]
    for r, a, b in zip(sorted(got), sets, sets[1:] + sets[:1]):
        assert abs(r.near_next - len(a & b) / len(a | b)) < 1e-12
