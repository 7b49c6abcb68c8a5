"""Runs against brute force: every period, every place."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from tidemark.llm.periodic_runs import find_runs, periodic_runs
from tidemark.llm.queries import op13_periodic_runs

SF_DIR = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_runs(w, least=6):
    out = []
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j + q - i >= max(least, 4 * q):
                part = w[i:j + q]
                if all(part[p:] != part[:-p] for p in range(1, q)):
                    out.append((i, j + q - i, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute(doc_id, text, looped=True):
    w = WORD.findall(text or "")
    n, h = len(w), 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if looped and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(w)
    gone = {i for s, m, q in runs for i in range(s + q, s + m)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else (None,) * 3
    lines = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
    return (doc_id, len(runs), *best, best[1] and 1000 * best[1] // best[2], hashlib.sha256(lines.encode()).hexdigest(),
            hashlib.sha256(" ".join(x for i, x in enumerate(w) if i not in gone).encode()).hexdigest())


NAMES = ("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


def digests(df):
    return sorted((tuple(r[n] for n in NAMES) for r in df.collect()), key=repr)


@pytest.mark.parametrize("seed", range(60))
def test_find_runs(seed):
    rng = random.Random(seed)
    docs = []
    for _ in range(rng.randint(1, 6)):
        w, letters = [], rng.choice([1, 2, 3, 50])
        while len(w) < rng.randint(0, 250):
            part = [rng.randrange(letters) for _ in range(rng.randint(1, 30))]
            w += part * rng.choice([1, 1, 2, 3, 4, 5, 9]) + part[:rng.randrange(len(part) + 1)]
        docs.append(w)
    first = np.concatenate([[0], np.cumsum([len(w) for w in docs])]).astype(np.int64)
    got = list(zip(*(x.tolist() for x in find_runs(np.array(sum(docs, []), np.int64), first))))
    want = sorted((int(first[d]) + s, int(first[d]) + s + m, q) for d, w in enumerate(docs) for s, m, q in brute_runs(w, 4))
    assert sorted(got) == want


def test_nested_and_fibonacci():
    a, b = [0], [0, 1]
    while len(b) < 900:
        a, b = b, b + a
    inner = ([1, 1, 1, 1, 2] * 4 + [3]) * 6
    for w in (b, inner, [7] * 3000, [1, 2] * 400 + [1, 2, 3] * 300):
        got = sorted((s, e - s, q) for s, e, q in zip(*(x.tolist() for x in find_runs(
            np.array(w, np.int64), np.array([0, len(w)])))))
        assert got == sorted(brute_runs(w, 4))


def test_long_single_word_is_quick():
    n = 300_000
    start, end, period = find_runs(np.zeros(n, np.int64), np.array([0, n]))
    assert (start.tolist(), end.tolist(), period.tolist()) == ([0], [n], [1])


def test_odd_rows(spark):
    docs = [(1, None), (2, ""), (3, " \t\n"), (4, "a a a a a"), (4, "a a a a a a"), (4, "a a a a a a"), (None, "é x " * 9),
            (None, None), (5, "x\x00y " * 7), (6, "abcdefg abcdefg\x0f " * 8), (7, "w " * 30000), (-3, "A a A a A a A a")]
    df = spark.createDataFrame([(*d, 1, "r") for d in docs], "doc_id long, text string, runs int, start string")
    got = {(r.doc_id, r.collapsed, len(r.runs)) for r in periodic_runs(df.repartition(3)).collect()}
    assert (4, "a a a a a", 0) in got and (4, "a", 1) in got and (None, "é x", 1) in got and (None, "", 0) in got
    assert (6, "abcdefg abcdefg\x0f", 1) in got and (7, "w", 1) in got and (1, "", 0) in got
    assert periodic_runs(df.where("false")).collect() == []


def test_query(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    got = digests(op13_periodic_runs(spark, SF_DIR))
    assert got == sorted((brute(*d) for d in docs), key=repr)
    assert any(r[1] for r in got)
