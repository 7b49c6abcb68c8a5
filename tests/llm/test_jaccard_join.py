"""Classes against brute force over all pairs; components against union-find."""

import random

import numpy as np
import pyarrow as pa

from tidemark.llm import jaccard_join
from tidemark.llm.graph import components
from tidemark.llm.jaccard_join import near_classes
from tidemark.llm.queries import op4_jaccard_join
from tidemark.llm.words import SPACED_LOWER, find_words

SF_DIR = "/root/testdata/sf0.001"


def shingle_set(text):
    w = bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode()).split()
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def find(parent, x):
    while parent[x] != x:
        parent[x] = parent[parent[x]]
        x = parent[x]
    return x


def brute(rows):
    sets = [(i, shingle_set(t)) for i, t in rows]
    parent = {i: i for i, _ in sets}
    for x in range(len(sets)):
        for y in range(x):
            a, b = sets[x][1], sets[y][1]
            if a and b and 4 * min(len(a), len(b)) >= 3 * max(len(a), len(b)):
                both = len(a & b)
                if 100 * both >= 75 * (len(a) + len(b) - both):
                    u, v = sorted((find(parent, sets[x][0]), find(parent, sets[y][0])))
                    parent[v] = u
    return sorted((i, len(s), find(parent, i)) for i, s in sets)


def got(df):
    return sorted((r.doc_id, r.n_shingles, r.component_id) for r in df.collect())


def mutated(rng, words, rate):
    return [rng.choice("abcdefgh") * 3 + str(rng.random()) if rng.random() < rate else w for w in words]


def planted():
    rng = random.Random(3)
    rows = [(900, None), (901, ""), (902, " \n"), (903, "one two"), (904, "One two"), (905, "two one"), (906, "a a a a a a a")]
    n = 0
    for group, (size, length, rate) in enumerate([(40, 150, 0.03), (30, 80, 0.05), (25, 300, 0.02), (10, 20, 0.03)]):
        base = [f"g{group}w{i}" for i in range(length)]
        for _ in range(size):
            rows.append((n, " ".join(mutated(rng, base, rng.random() * rate * 2))))
            n += 1
    passage = [f"p{i}" for i in range(60)]
    for _ in range(60):
        own = [f"u{n}x{i}" for i in range(rng.randrange(5, 60))]
        rows.append((n, " ".join(own[:5] + passage + own[5:])))
        n += 1
    chain = [f"c{i}" for i in range(400)]
    for k in range(12):  # each linked with its neighbours only
        rows.append((n, " ".join(chain[k * 12:k * 12 + 120])))
        n += 1
    rows += [(n + 1, rows[8][1]), (n + 2, rows[8][1].upper()), (n + 3, "long " * 30000), (n + 4, "long " * 20000)]
    rng.shuffle(rows)
    return rows


def test_planted(spark, monkeypatch):
    rows = planted()
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, n int, component string").repartition(4)
    want = brute(rows)
    assert len({c for _, _, c in want}) < len(rows) - 50
    assert got(near_classes(df)) == want


def test_planted_without_windows(spark, monkeypatch):
    rows = planted()[:120]
    monkeypatch.setattr(jaccard_join, "WINDOW_ROWS", 0)
    assert got(near_classes(spark.createDataFrame(rows, "doc_id long, text string"))) == brute(rows)


def test_empty(spark):
    assert got(near_classes(spark.createDataFrame([], "doc_id long, text string"))) == []
    same = spark.createDataFrame([(1, "a b c d e f"), (1, "a b c d e f")], "doc_id long, text string")
    assert got(near_classes(same)) == [(1, 2, 1), (1, 2, 1)]


def test_components(spark):
    rng = random.Random(1)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(400, 500)]
    parent = {x: x for p in links for x in p}
    for a, b in links:
        u, v = sorted((find(parent, a), find(parent, b)))
        parent[v] = u
    found = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    linked = {x for a, b in links if a != b for x in (a, b)}
    assert found == {x: find(parent, x) for x in linked}


def test_query(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    assert got(op4_jaccard_join(spark, SF_DIR)) == brute(docs)


def test_a_pair_meets_once(spark, monkeypatch):
    """Copies too far from each other share hundreds of shingles; the join makes a row or two for each pair, not for
    each shingle. Classes are those of brute force."""
    rng, base = random.Random(8), [f"w{i}" for i in range(1200)]
    rows = []
    for n in range(16):
        edited = set(rng.sample(range(1200), 24))
        rows.append((n, " ".join(f"e{n}x{i}" if i in edited else w for i, w in enumerate(base))))
    made, meetings = [], jaccard_join._meetings
    monkeypatch.setattr(jaccard_join, "_meetings", lambda mixed, percent: made.append(meetings(mixed, percent)) or made[-1])
    assert got(near_classes(spark.createDataFrame(rows, "doc_id long, text string"))) == brute(rows)
    pairs = made[0].select("doc_id", "p_doc_id").distinct().count()
    assert 60 < pairs and made[0].count() < 4 * pairs


def test_driver_gets_a_byte_for_each_slot(spark, monkeypatch):
    docs = spark.createDataFrame([(i, " ".join(f"w{i * j % 97}" for j in range(30))) for i in range(200)],
                                 "doc_id long, text string").repartition(3)
    kind, received = type(docs), []
    for name in ("collect", "toLocalIterator"):
        def told(self, *args, own=getattr(kind, name), **options):
            rows = list(own(self, *args, **options))
            received.append(sum(len(v) for row in rows for v in row if isinstance(v, (bytes, bytearray))))
            return rows
        monkeypatch.setattr(kind, name, told)
    levels, bound = jaccard_join.slot_levels(docs, 5)
    assert 0 < sum(received) <= jaccard_join.SLOTS
    monkeypatch.undo()
    counts = np.zeros(jaccard_join.SLOTS, np.int64)
    texts = pa.array([r.text for r in docs.collect()])
    for own in jaccard_join.shingles(find_words(texts, SPACED_LOWER), 5):
        np.add.at(counts, (own & np.uint64(jaccard_join.SLOTS - 1)).astype(np.int64), 1)
    want = np.floor(np.log2(np.maximum(counts / max(1.0, counts.mean()), 1)))
    assert np.array_equal(levels, want) and bound == counts[want == 0].max()
