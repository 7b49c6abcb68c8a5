"""Benchmark decontamination: a broadcast hash set of test n-grams over the word windows of training documents.

Every window of n consecutive item words (an item of fewer words is one window) enters a hash set. A training document
is reduced to the hashes of its word windows of the same lengths; a bitmap of fixed size passes few of them, a sorted
search finds the entry, and the words themselves verify the hit. Nothing is shuffled: documents are scanned in place.

The set is broadcast only up to ``max_windows`` windows, which are counted first. Beyond that, windows are dealt by
hash into several sets of that bound and the documents are scanned once for each; hits of all scans are joined.

Defined results: a null text has no words and no hit; an item without words has no window; an item whose id is null
marks words but names nothing; rows with equal ids are judged each by its own text; other columns are ignored.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import ALNUM_LOWER, Carried, Words, documents, find_words, map_blocks, ngrams

#: Windows of a broadcast set: about 20 MB with their words.
MAX_WINDOWS = 200_000
_BITS = 20

HITS = "doc_id long, n_words long, starts array<int>, stops array<int>, items array<long>, cleaned string"


def _windows(n: int):
    def work(block: pa.RecordBatch) -> dict | None:
        words = find_words(block.column("text"), ALNUM_LOWER)
        ids = block.column("doc_id").to_pylist()
        out: dict[str, list] = {"item": [], "size": [], "hash": [], "words": []}
        for d, count in enumerate(words.counts.tolist()):
            size, a = min(n, count), int(words.first[d])
            if not size:
                continue
            h = ngrams(words.hashes[a:a + count], size, seed=9).view(np.int64)
            named = [words.word(i) for i in range(a, a + count)]
            for p in range(count - size + 1):
                out["item"].append(ids[d])
                out["size"].append(size)
                out["hash"].append(int(h[p]))
                out["words"].append(b" ".join(named[p:p + size]))
        return out if out["item"] else None

    return work


class GramSet:
    """Windows of several lengths with the items that have them."""

    def __init__(self, table: pa.Table):
        self.by_size = {}
        for size in sorted(set(table["size"].to_pylist())):
            part = table.filter(pc.equal(table["size"], size))
            h = part["hash"].to_numpy().view(np.uint64)
            order = np.argsort(h, kind="stable")
            bitmap = np.zeros(1 << _BITS, bool)
            bitmap[h & np.uint64((1 << _BITS) - 1)] = True
            self.by_size[size] = (h[order], bitmap, [part["words"][int(i)].as_py() for i in order],
                                  [part["items"][int(i)].as_py() for i in order])

    def hits(self, words: Words):
        """(first word, window length, item ids) of each verified place."""
        for size, (known, bitmap, wording, items) in self.by_size.items():
            h = ngrams(words.hashes, size, seed=9)[:max(0, len(words) - size + 1)]
            places = np.flatnonzero(bitmap[h & np.uint64((1 << _BITS) - 1)] & words.within(size))
            at = np.searchsorted(known, h[places])
            found = at < len(known)
            found[found] = known[at[found]] == h[places[found]]
            for p, i in zip(places[found].tolist(), at[found].tolist()):
                own = b" ".join(words.word(j) for j in range(p, p + size))
                while i < len(known) and known[i] == h[p]:
                    if wording[i] == own:
                        yield p, size, items[i]
                    i += 1


def _scan(shared, carried: Carried):
    def work(block: pa.RecordBatch) -> dict:
        texts = block.column("text")
        words = find_words(texts, ALNUM_LOWER)
        marks = np.zeros(len(words) + 1, np.int32)
        named: dict[int, set] = {}
        for p, size, items in shared.value.hits(words):
            marks[p] += 1
            marks[p + size] -= 1
            named.setdefault(int(words.doc[p]), set()).update(items)
        runs = _runs(np.cumsum(marks)[:len(words)] > 0, words)
        return {"doc_id": block.column("doc_id"), "n_words": words.counts,
                "starts": [runs.get(d, ((), ()))[0] for d in range(len(texts))],
                "stops": [runs.get(d, ((), ()))[1] for d in range(len(texts))],
                "items": [sorted(named.get(d, ())) for d in range(len(texts))],
                "cleaned": _cleaned(texts, words, runs), **carried.of(block)}

    return work


def _runs(hit: np.ndarray, words: Words) -> dict[int, tuple[list[int], list[int]]]:
    """Per document with hits: where runs of hit words start and end (exclusive), as places in the document."""
    places = np.flatnonzero(hit)
    if not len(places):
        return {}
    new = np.ones(len(places), bool)
    new[1:] = (np.diff(places) != 1) | (np.diff(words.doc[places]) != 0)
    heads, tails = places[new], places[np.append(np.flatnonzero(new)[1:] - 1, len(places) - 1)]
    out: dict[int, tuple[list[int], list[int]]] = {}
    for d, a, b in zip(words.doc[heads].tolist(), words.place[heads].tolist(), words.place[tails].tolist()):
        starts, stops = out.setdefault(d, ([], []))
        starts.append(a)
        stops.append(b + 1)
    return out


def _cleaned(texts: pa.Array, words: Words, runs: dict) -> pa.Array:
    """Texts without the runs, from a run's first byte to its last; an unhit text stays as it is, null included."""
    if not runs:
        return texts.cast(pa.string())
    out = texts.to_pylist()
    # Byte 0 of the block is that of its first text; words know block offsets only.
    base = np.concatenate([[0], np.cumsum([len((t or "").encode()) for t in out])])
    for d, (starts, stops) in runs.items():
        body, first, at, parts = out[d].encode(), int(words.first[d]), 0, []
        for a, b in zip(starts, stops):
            parts.append(body[at:int(words.starts[first + a] - base[d])])
            at = int(words.ends[first + b - 1] - base[d])
        out[d] = b"".join([*parts, body[at:]]).decode()
    return pa.array(out, pa.string())


def _drop(carried: Carried):
    """Merge the runs of several scans."""
    def work(block: pa.RecordBatch) -> dict:
        texts = block.column("text")
        words = find_words(texts, ALNUM_LOWER)
        marks = np.zeros(len(words) + 1, np.int32)
        for name, step in (("starts", 1), ("stops", -1)):
            listed = block.column(name)
            sizes = pc.list_value_length(listed).fill_null(0).to_numpy(zero_copy_only=False)
            at = listed.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            np.add.at(marks, at + np.repeat(words.first[:-1], sizes), step)
        runs = _runs(np.cumsum(marks)[:len(words)] > 0, words)
        return {"doc_id": block.column("doc_id"), "n_words": words.counts,
                "starts": [runs.get(d, ((), ()))[0] for d in range(len(texts))],
                "stops": [runs.get(d, ((), ()))[1] for d in range(len(texts))],
                "items": [sorted(set(x or ())) for x in block.column("items").to_pylist()],
                "cleaned": _cleaned(texts, words, runs), **carried.of(block)}

    return work


def contamination(docs_df: DataFrame, items_df: DataFrame, n: int = 10, max_windows: int = MAX_WINDOWS,
                  doc_cols: tuple[str, str] = ("doc_id", "text"), item_cols: tuple[str, str] = ("item_id", "text"),
                  carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: doc_id, n_words, starts and stops of runs of hit words, items with a window in the
    document, cleaned (the text without those runs), and ``carry``."""
    carried, spark = Carried(docs_df, carry), docs_df.sparkSession
    docs = documents(docs_df, *doc_cols, carried)
    grams = map_blocks(documents(items_df, *item_cols), _windows(n), "item long, size int, hash long, words binary")
    grams = grams.groupBy("size", "hash", "words").agg(F.array_sort(F.collect_set("item")).alias("items"))
    count = grams.count()
    sets = max(1, math.ceil(count / max_windows))
    if sets == 1:
        shared = spark.sparkContext.broadcast(GramSet(grams.toArrow()))
        return carried.renamed(map_blocks(docs, _scan(shared, carried), HITS + carried.ddl))
    keyed = docs.withColumn("digest", F.sha2("text", 256))
    scans = []
    for i in range(sets):
        part = grams.where(F.pmod(F.xxhash64("hash", "size"), F.lit(sets)) == i)
        shared = spark.sparkContext.broadcast(GramSet(part.toArrow()))
        scans.append(map_blocks(keyed, _hit_only(shared), "doc_id long, digest string, starts array<int>, "
                                                          "stops array<int>, items array<long>"))
    hits = reduce(DataFrame.unionByName, scans).groupBy("doc_id", "digest").agg(
        F.flatten(F.collect_list("starts")).alias("starts"), F.flatten(F.collect_list("stops")).alias("stops"),
        F.flatten(F.collect_list("items")).alias("items"))
    hits = hits.withColumnsRenamed({"doc_id": "hit_id", "digest": "hit_digest"})
    same = F.col("doc_id").eqNullSafe(F.col("hit_id")) & (F.col("digest") == F.col("hit_digest"))
    met = keyed.join(hits, same, "left")
    return carried.renamed(map_blocks(met, _drop(carried), HITS + carried.ddl))


def _hit_only(shared):
    scan = _scan(shared, Carried(None, ()))

    def work(block: pa.RecordBatch) -> dict | None:
        out = scan(block)
        hit = [d for d, s in enumerate(out["starts"]) if len(s)]
        return None if not hit else {
            "doc_id": block.column("doc_id").take(hit), "digest": block.column("digest").take(hit),
            **{name: [out[name][d] for d in hit] for name in ("starts", "stops", "items")}}

    return work
