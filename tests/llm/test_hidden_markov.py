"""Recursions against sums over all state paths, training against likelihood, base scores against counts."""

import itertools
import math
import zlib
from collections import Counter
from pathlib import Path

import numpy as np

from tidemark.llm import hidden_markov as hm
from tidemark.llm.queries import op5_hidden_markov
from tidemark.session import checkpoint_dir

SF_DIR = "/root/testdata/sf0.001"


def random_chain(rng, states, symbols):
    return hm.Chain(rng.dirichlet(np.ones(states)), rng.dirichlet(np.ones(states), states),
                    rng.dirichlet(np.ones(symbols), states).T)


def test_recursions_equal_sums_over_paths():
    rng = np.random.default_rng(0)
    chain = random_chain(rng, 3, 5)
    texts = [rng.integers(0, 5, n) for n in (4, 1, 6, 2, 4)]
    symbols, first = np.concatenate(texts), np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    start, move, posterior, like = chain.expected(symbols, first)
    want_start, want_move, want_post = np.zeros(3), np.zeros((3, 3)), []
    for text, own in zip(texts, like):
        paths = {}
        for path in itertools.product(range(3), repeat=len(text)):
            p = chain.start[path[0]] * chain.emit[text[0], path[0]]
            for t in range(1, len(text)):
                p *= chain.move[path[t - 1], path[t]] * chain.emit[text[t], path[t]]
            paths[path] = float(p)
        total = sum(paths.values())
        assert abs(math.log(total) - own) < 1e-4
        post = np.zeros((len(text), 3))
        for path, p in paths.items():
            want_start[path[0]] += p / total
            for t, s in enumerate(path):
                post[t, s] += p / total
                if t:
                    want_move[path[t - 1], s] += p / total
        want_post.append(post)
    assert np.allclose(start, want_start, atol=1e-3) and np.allclose(move, want_move, atol=1e-3)
    assert np.allclose(posterior, np.concatenate(want_post), atol=1e-3)
    assert np.allclose(chain.forward(symbols, first), like)


def tokens(text):
    return bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode()).split() + [None]


def base(docs):
    train = Counter()
    for i, t in docs:
        if i is None or zlib.crc32(str(i).encode()) % 10:
            train.update(tokens(t))
    n, v = sum(train.values()), len(train)
    return n, [(i, len(tokens(t)), sum(train[x] > 0 for x in tokens(t)),
                sum(math.log10((train[x] + 0.1) / (n + 0.1 * (v + 1))) for x in tokens(t))) for i, t in docs]


def check(got, docs):
    n, want = base(docs)
    assert {r.train_tokens for r in got} <= {n}
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[3])
    got = sorted(((r.doc_id, r.n_tokens, r.n_known, r.base_score, r.score) for r in got), key=key)
    for a, b in zip(got, sorted(want, key=key), strict=True):
        assert a[:3] == b[:3] and abs(a[3] - b[3]) < 1e-6 * (1 + abs(b[3])) and a[4] < 0


def test_planted(spark, monkeypatch):
    docs = [(1, None), (2, ""), (3, "A b a\x0bB ã"), (4, "rare words here"), (4, "rare words here"), (None, "a b"),
            (6, "w " * 30000), (30, "never seen")] + [(i, f"a b c{i % 7} d{i}") for i in range(40, 140)]
    df = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, n int").repartition(3)
    check(hm.score_held_out(df).collect(), docs)
    # Few symbols and known words: most counts come from the join, and base scores stay the same.
    for name, value in (("KNOWN", 6), ("SYMBOLS", 3), ("SHARED", 4)):
        monkeypatch.setattr(hm, name, value)
    # Workers import the module anew, so their bounds stay; the lexicon carries its own.
    assert hm.score_held_out(df.where("false")).count() == 0


def test_rare_words_keep_their_own_counts(spark, monkeypatch):
    # Two topics that share no word; only three words have a symbol that workers hold.
    rng = np.random.default_rng(5)
    docs = [(i, " ".join(f"{'ab'[i % 2]}{rng.integers(40)}" for _ in range(80))) for i in range(60)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    monkeypatch.setattr(hm, "SYMBOLS", 3)
    monkeypatch.setattr(hm, "KNOWN", 6)
    lexicon, chain, likes, counts = hm.fit(df, passes=4)
    assert likes == sorted(likes)
    factors = {r.word: np.array(r.factor) for r in chain.factors.collect()}
    assert len(factors) == lexicon.distinct - 3  # the end and two words have symbols
    assert max(f.max() / f.min() for f in factors.values()) > 2
    # Within a group, shares of words and of a word never seen add up to 1 in each state.
    sizes = {r.word: r.n for r in counts.collect()}
    groups = {}
    for w, f in factors.items():
        g = w & (hm.SHARED - 1)
        share = (sizes[w] + hm.ADD) / (lexicon.shared_count[g] + hm.ADD * (lexicon.shared_words[g] + 1))
        groups[g] = groups.get(g, 0) + share * f
    for g, total in groups.items():
        unseen = hm.ADD / (lexicon.shared_count[g] + hm.ADD * (lexicon.shared_words[g] + 1))
        assert np.allclose(total + unseen, 1, atol=1e-3)
    rows = hm.score(df, lexicon, chain, counts).collect()
    with_own = sum(r.score for r in rows)
    chain.factors = None
    assert with_own > sum(r.score for r in hm.score(df, lexicon, chain, counts).collect())
    mixed = spark.createDataFrame([(1, None), (2, "never seen a1"), (3, docs[0][1])], "doc_id long, text string")
    assert all(np.isfinite(r.score) for r in hm.score(mixed, lexicon, chain, counts).collect())


def test_query(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    got = op5_hidden_markov(spark, SF_DIR).collect()
    check(got, docs)


def test_training_helps(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    lexicon, chain, likes, counts = hm.fit(df, passes=3)
    assert likes == sorted(likes)
    rows = hm.score(df, lexicon, chain, counts).collect()
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)
    assert np.allclose(chain.emit.sum(axis=0), 1, atol=1e-3) and np.allclose(chain.move.sum(axis=1), 1, atol=1e-4)


def test_passes_leave_little_behind(spark, monkeypatch):
    # Nearly all words are rare, and a pass writes over what an earlier one wrote.
    monkeypatch.setattr(hm, "SYMBOLS", 3)
    monkeypatch.setattr(hm, "KNOWN", 6)
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    lexicon, counts = hm.build_lexicon(hm.word_counts(df)), hm.word_counts(df).count()
    folder = Path(checkpoint_dir(spark).removeprefix("file:"))
    before = set(folder.glob("tidemark-*"))
    hm.train(df.select("doc_id", "text"), lexicon, passes=4)
    made = [f for d in set(folder.glob("tidemark-*")) - before for f in d.rglob("*.parquet")]
    size = sum(f.stat().st_size for f in made)
    assert size < 100 * counts, (size, counts)
