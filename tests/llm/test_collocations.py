"""Phrases against plain counting; intervals of the index against plain search."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from tidemark.llm.collocations import collocations
from tidemark.llm.phrase_index import PhraseIndex

SF_DIR = "/root/testdata/sf0.001"
NAMES = ("lang", "rank", "phrase", "a", "l", "r", "cut", "n", "score", "n_left", "n_right")


def pieces(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [re.findall(r"[^\x20\x09]+", x) for x in re.split(r"[.,;:!?\x0A-\x0D]", text)]


def brute(docs, least, longest, top, inside=50):
    f, n = Counter(), Counter()
    for text, lang in docs:
        lang = "und" if lang is None else lang
        for w in pieces(text):
            n[lang] += len(w)
            for size in range(1, longest + 1):
                f.update((lang, *w[i:i + size]) for i in range(len(w) - size + 1))
    common = {p: a for p, a in f.items() if len(p) > 2 and a >= least}
    held, left, right = Counter(), Counter(), Counter()
    for (lang, *w), a in common.items():
        for size in range(2, len(w)):
            for i in range(len(w) - size + 1):
                part = (lang, *w[i:i + size])
                held[part] = max(held[part], a)
        if len(w) > 2:
            left[lang, *w[1:]] += 1
            right[lang, *w[:-1]] += 1
    rows = []
    for (lang, *w), a in common.items():
        if 100 * held[lang, *w] >= inside * a and held[lang, *w]:
            continue
        cuts = [(1000000 * a * a // (f[lang, *w[:k]] * f[lang, *w[k:]]), k) for k in range(1, len(w))]
        score, k = min(cuts)
        rows.append((lang, " ".join(w), a, f[lang, *w[:k]], f[lang, *w[k:]], k, n[lang], score, left[lang, *w], right[lang, *w]))
    rows.sort(key=lambda r: (r[0], -r[7], -r[2], r[1].encode()))
    out, seen = [], Counter()
    for r in rows:
        seen[r[0]] += 1
        if seen[r[0]] <= top:
            out.append((r[0], seen[r[0]], *r[1:]))
    return out


def answer(df):
    return sorted((tuple(r[n] for n in NAMES) for r in df.collect()), key=lambda r: (r[0], r[1]))


@pytest.mark.parametrize("seed", range(8))
def test_index_both_ways(seed):
    rng = random.Random(seed)
    size, n = rng.randint(1, 5), rng.randint(1, 120)
    s = np.array([rng.randint(1, size) for _ in range(n)])
    joined = np.array([rng.random() < 0.8 for _ in range(n - 1)], bool)
    index = PhraseIndex.of(s, joined, size, 5)
    known, sides = np.ones(size, bool), [rng.random() < 0.5 for _ in range(4)]
    found = index.words()
    for length, left in enumerate(sides, start=2):
        found = index.extended(found.take(found.count > 0), left, known)
        want = Counter(tuple(s[i:i + length].tolist()) for i in range(n - length + 1) if joined[i:i + length - 1].all())
        assert {tuple(w): c for w, c in zip(found.words.tolist(), found.count.tolist())} == want


def made(seed, n=60):
    rng = random.Random(seed)
    vocabulary = ["a", "b", "B", "cc", "d-d", "É", "é", "x\x00y", "longer-than-eight-bytes", "longer-than-eight-byteS"]
    return [(" ".join(rng.choice(vocabulary) + rng.choice(["", "", "", ".", "\n", ",", "\t"]) for _ in range(rng.randint(0, 80))),
             rng.choice(["en", "de", None, "und"])) for _ in range(n)]


@pytest.mark.parametrize("longest,shard_bytes", [(2, 1 << 20), (3, 400), (5, 3000)])
def test_against_counting(spark, longest, shard_bytes):
    docs = made(longest)
    df = spark.createDataFrame(docs, "text string, lang string").repartition(3)
    got = answer(collocations(df, least=4, longest=longest, top=30, shard_bytes=shard_bytes))
    assert got == brute(docs, 4, longest, 30) and got


def test_odd_rows(spark):
    docs = [(None, "en"), ("", None), (" .\n", "en"), ("the the the", "en"), ("w " * 40000, "fr"), *[("same text here", "en")] * 12,
            *[("Same text here", None)] * 12]
    df = spark.createDataFrame([(*d, i, "k", 1) for i, d in enumerate(docs)],
                               "text string, lang string, doc_id long, word string, f int").repartition(4)
    assert answer(collocations(df)) == brute(docs, 10, 3, 2000)
    assert answer(collocations(df.where("false"))) == []


def test_whole_corpus_with_bounded_tables(spark, monkeypatch):
    """Bitmaps full of wrong bits and joins without broadcast give the same rows."""
    from tidemark.llm import collocations as module

    monkeypatch.setattr(module, "_MOST_BITS", 1 << 8)
    monkeypatch.setattr(module, "_LEAST_BITS", 1 << 8)
    monkeypatch.setattr(module, "BROADCAST_BYTES", 0)
    docs = [(r.text, r.lang) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    got = answer(collocations(spark.read.parquet(f"{SF_DIR}/documents.parquet"), top=300))
    assert got == brute(docs, 10, 3, 300)
