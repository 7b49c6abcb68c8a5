"""Periodic runs of words: catchers over completed power-of-two blocks find squares, which merge into runs.

A text grows word by word. Whenever a block of b words (b a power of two, at a multiple of b) is complete, a catcher
is armed for it: it waits for the block's words to come again 2b to 4b - 1 words later. That is a suffix comparison of
the grown text with itself, advanced through hashes of b words; the catchers of one block length advance together, over
all documents of a bounded block of rows. A catch at distance q that goes on for neighbouring catchers is a square of
period q; catches in a row merge into one run, whose ends are then found word by word. One-word catchers take the
periods 1 to 3.

A run of period q and 4 q words or more holds five completed blocks of its level in a row, so shorter rows of catches
are no run. Periods come in ascending levels: a catch inside a known run whose period divides q is that run again, and
at most one known run covers it, the one that reaches furthest. So work is in proportion to words times levels, also
in texts of one repeated word, and every run has its smallest period.

Hashes only propose; words are compared by ids that stand for their exact bytes. Nothing is shuffled, a row's answer
depends on its own text alone.

Defined results: a null or empty text has no words and no run, its collapsed text is empty; a null id is carried and is
never edited by ``looped_tails``; repeated rows are judged each on its own; other columns are ignored.
"""

from __future__ import annotations

import zlib
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .word_ids import word_ids
from .words import SPACED, Words, documents, find_words, map_blocks, mix

_U = np.uint64
#: A run has at least this many periods and, when reported, this many words.
MIN_PERIODS = 4
MIN_WORDS = 6

RUNS = ("doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, "
        "start long, length long, period long, exponent_milli long, collapsed string")


class _Known:
    """Runs found so far, as (start, end, period) in the block's words."""

    def __init__(self):
        self.start = self.end = self.period = np.zeros(0, np.int64)
        self._reach = np.zeros(0, np.int64)

    def add(self, start: np.ndarray, end: np.ndarray, period: np.ndarray) -> None:
        start, end, period = (np.concatenate(x) for x in zip(
            (self.start, self.end, self.period), (start, end, period)))
        order = np.lexsort((period, start))
        self.start, self.end, self.period = start[order], end[order], period[order]
        # Furthest end of all runs that start no later, with that run's index.
        self._reach = np.maximum.accumulate(self.end << 32 | np.arange(len(self.end)))

    def covers(self, start: np.ndarray, end: np.ndarray, period: np.ndarray) -> np.ndarray:
        """Does a run of a smaller period that divides ``period`` hold all words of [start, end)."""
        at = np.searchsorted(self.start, start, side="right") - 1
        out = np.zeros(len(start), bool)
        some = np.flatnonzero(at >= 0)
        run = self._reach[at[some]] & 0xFFFFFFFF
        out[some] = ((self.end[run] >= end[some]) & (period[some] % self.period[run] == 0)
                     & (period[some] > self.period[run]))
        return out


def _segments(equal: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal stretches of True of at least ``least`` places, as (start, end)."""
    edge = np.diff(np.concatenate([[False], equal, [False]]).astype(np.int8))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    long = end - start >= least
    return start[long], end[long]


def find_runs(ids: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, smallest period) of all maximal runs of four periods and more, in places of ``ids``.

    ``first`` holds the first word of each document and the number of words; no run crosses documents."""
    known, counts = _Known(), np.diff(first)
    doc = np.repeat(np.arange(len(counts)), counts)
    for q in (1, 2, 3):
        if len(ids) > q:
            start, end = _segments((ids[:-q] == ids[q:]) & (doc[:-q] == doc[q:]), (MIN_PERIODS - 1) * q)
            _keep(known, start, end + q, np.full(len(start), q))
    place = np.arange(len(ids)) - first[doc]
    at, grams, b = np.arange(len(ids)), mix(ids.astype(_U) + _U(1)), 1
    while True:
        grams, b = _doubled(grams, b), 2 * b
        long = counts >= 2 * b * MIN_PERIODS
        if not long.any():
            return known.start, known.end, known.period
        inside = long[doc[at]]
        if not inside.all():
            at, grams = at[inside], grams[inside]
        _catch(known, ids, first, doc, place, at, grams, b)


def _keep(known: _Known, start: np.ndarray, end: np.ndarray, period: np.ndarray) -> None:
    new = ~known.covers(start, end, period)
    if new.any():
        known.add(start[new], end[new], period[new])


def _doubled(grams: np.ndarray, b: int) -> np.ndarray:
    """Hashes of 2b words from those of b words. Those that cross the end of a document are never used."""
    out = np.zeros(len(grams), _U)
    if len(grams) > b:
        out[:-b] = mix(grams[:-b] * _U(0x9E3779B97F4A7C15) ^ (grams[b:] + _U(b)))
    return out


def _catch(known: _Known, ids, first, doc, place, at, grams, b: int) -> None:
    """Arm a catcher for every completed block of b words, collect catches 2b to 4b - 1 words on, add their runs."""
    owner = doc[at]
    whole = first[owner + 1] - at >= b
    key = grams ^ mix(owner.astype(_U))
    armed = np.flatnonzero(whole & (place[at] & (b - 1) == 0))
    bits = max(10, int(16 * len(armed)).bit_length())
    waiting = np.zeros(1 << bits, bool)
    low = (key & _U((1 << bits) - 1)).astype(np.int64)
    waiting[low[armed]] = True
    seen = np.flatnonzero(waiting[low] & whole)
    # Places with equal blocks in ascending order, addressed by rank of the block and place.
    order = np.argsort(key[seen], kind="stable")
    ordered = key[seen][order]
    rank = np.cumsum(np.concatenate([[False], ordered[1:] != ordered[:-1]]))
    size = len(at)
    listed = rank * size + seen[order]
    own = np.empty(len(seen), np.int64)
    own[order] = rank
    base = own[np.searchsorted(seen, armed)] * size
    lo = np.searchsorted(listed, base + np.minimum(armed + 2 * b, size))
    hi = np.searchsorted(listed, base + np.minimum(armed + 4 * b, size))
    times = hi - lo
    total = int(times.sum())
    if not total:
        return
    source = np.repeat(armed, times)
    target = listed[np.arange(total) - np.repeat(np.cumsum(times) - times, times) + np.repeat(lo, times)] % size
    same = owner[source] == owner[target]
    source, period = source[same], (target - source)[same]
    order = np.lexsort((source, period))
    source, period = source[order], period[order]
    if not len(source):
        return
    # Catches of neighbouring blocks at one distance merge.
    new = np.ones(len(source), bool)
    new[1:] = (period[1:] != period[:-1]) | (source[1:] - source[:-1] != b) | (owner[source[1:]] != owner[source[:-1]])
    head = np.flatnonzero(new)
    tail = np.append(head[1:], len(source)) - 1
    enough = tail - head >= 4
    q, start, last = period[head[enough]], at[source[head[enough]]], at[source[tail[enough]]]
    fresh = ~known.covers(start, last + b + q, q)
    found: list[tuple[int, int, int]] = []
    for i, j, p in zip(start[fresh].tolist(), last[fresh].tolist(), q[fresh].tolist()):
        d = doc[i]
        a, z = max(int(first[d]), i - b + 1), min(int(first[d + 1]) - p, j + 2 * b)
        for s, e in zip(*_segments(ids[a:z] == ids[a + p:z + p], (MIN_PERIODS - 1) * p)):
            found.append((a + int(s), a + int(e) + p, p))
    if found:
        _keep(known, *np.array(found, np.int64).T)


def looped_tail(doc_id: int | None, n: int) -> np.ndarray | None:
    """The edit by which a tenth of the documents get a periodic tail: which original word stands at each place.

    None where a document stays as it is."""
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    out = np.arange(n)
    out[a:] = a + (out[a:] - a) % p
    return out


def _work(looped: bool):
    def work(block: pa.RecordBatch) -> dict:
        words = find_words(block.column("text"), SPACED)
        ids, _ = word_ids(words)
        keys, origin = block.column("doc_id").to_pylist(), np.arange(len(words))
        edited = set()
        for d, n in enumerate(words.counts.tolist()) if looped else ():
            if (places := looped_tail(keys[d], n)) is not None:
                a = int(words.first[d])
                origin[a:a + n] = a + places
                edited.add(d)
        start, end, period = find_runs(ids[origin], words.first)
        reported = end - start >= MIN_WORDS
        start, end, period = start[reported], end[reported], period[reported]
        drop = np.zeros(len(words) + 1, np.int64)
        np.add.at(drop, start + period, 1)
        np.add.at(drop, end, -1)
        kept = np.cumsum(drop)[:-1] == 0
        by_doc: dict[int, list[tuple[int, int, int]]] = {}
        owner = words.doc[start] if len(start) else start
        at = words.first[owner] if len(start) else start
        for d, s, n, p in zip(owner.tolist(), (start - at).tolist(), (end - start).tolist(), period.tolist()):
            by_doc.setdefault(d, []).append((s, n, p))
        best = [_greatest(by_doc.get(d, ())) for d in range(len(keys))]
        lists = [sorted(by_doc.get(d, ()), key=lambda r: (r[0], r[2])) for d in range(len(keys))]
        flat = [r for runs in lists for r in runs]
        struct = pa.StructArray.from_arrays([pa.array([r[i] for r in flat], pa.int64()) for i in range(3)],
                                            ["start", "length", "period"])
        offsets = np.concatenate([[0], np.cumsum([len(runs) for runs in lists])]).astype(np.int32)
        return {"doc_id": block.column("doc_id"), "n_words": words.counts,
                "runs": pa.ListArray.from_arrays(pa.array(offsets), struct),
                **{name: pa.array([r and r[i] for r in best], pa.int64())
                   for i, name in enumerate(("start", "length", "period", "exponent_milli"))},
                "collapsed": pa.array([_collapsed(words, d, origin, kept, d in edited, d in by_doc)
                                       for d in range(len(keys))], pa.string())}

    return work


def _greatest(runs) -> tuple[int, int, int, int] | None:
    if not runs:
        return None
    s, n, p = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]))
    return s, n, p, 1000 * n // p


def _collapsed(words: Words, d: int, origin: np.ndarray, kept: np.ndarray, edited: bool, cut: bool) -> str:
    a, z = int(words.first[d]), int(words.first[d + 1])
    if not edited:
        return words.text(d, kept if cut else None).decode()
    own = words.text(d).split(b" ")
    return b" ".join([own[i] for i in (origin[a:z][kept[a:z]] - a).tolist()]).decode()


def periodic_runs(docs_df: DataFrame, looped_tails: bool = False,
                  doc_cols: tuple[str, str] = ("doc_id", "text")) -> DataFrame:
    """One row per document: doc_id, n_words, runs (start, length, period; by start, then period), the run of most
    periods (ties: smallest start, then period; null without runs) and collapsed: the words without those that a run
    holds after its first period, joined by one space. ``looped_tails`` first edits a tenth of the documents."""
    return map_blocks(documents(docs_df, *doc_cols), _work(looped_tails), RUNS)
