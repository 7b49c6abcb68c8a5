"""Substring dedup by compaction of a De Bruijn graph of token k-mers.

Nodes are runs of k-1 words, edges runs of k words (an edge is named by the 64-bit hashes of its two nodes, so by 128
bits). An edge found in several documents is repeated. Repeated edges that follow each other at one source, with no
branch at the node between them, compact into paths; each place of a document that a path covers becomes a span with
source coordinates, and a checksum of the words between both ends of the span, taken at the document and at the
source, verifies it. A span's words are removed from every document but the smallest id that has them.

What keeps it small at scale:

* Exact copies of a text (equal 128 bits of SHA-256) leave the graph: all but the smallest id are covered by that one.
* Only k-mers that can repeat become rows. Each document is reduced to anchors (in every run of ``k - ANCHOR + 1``
  short n-grams the one of least hash), which depend on nothing but the words: two equal k-mers have equal anchors. A
  k-mer whose anchor no other document has is unique and never leaves its task. This loses nothing.
* A passage that millions of documents share is one edge per word; its rows are pre-aggregated before the shuffle, and
  the join back to its places is one that Spark can split.

A document is named by its id and the key of its text, so that texts which share an id keep their own places. In rows
of places the texts of one id are told apart by their rank (0 for all but repeated ids) in the high half of the place.

Defined results: a null text has no words; texts of fewer than k words lose none; of repeated ids none counts as the
other's smaller source, and each row is cut by its own text; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .tables import joined, list_bytes, stored
from .words import SPACED, Carried, Words, documents, find_words, map_blocks, mix, ngrams

#: Words of an anchor.
ANCHOR = 25
#: Bytes of a text's key.
KEY_BYTES = 16
#: Bits of one word pair in a path's checksum: sums over a document of 2^22 words stay below 2^63.
_CHECK_BITS = np.uint64(24)

EDGE = "source long, target long, doc_id long, place long, checksum long"


def _own_anchor(words: Words, k: int) -> np.ndarray:
    """For each k-mer the place of its n-gram of least hash, the last of ties."""
    short = min(ANCHOR, k)
    h = ngrams(words.hashes, short, seed=1)
    best, size, width = np.arange(len(h)), 1, k - short + 1
    # Least of a sliding window by doubling; of equal ones the last, which both windows see alike.
    while size < width:
        step = min(size, width - size)
        left, right = best[:-step], best[step:]
        best = np.where(h[right] <= h[left], right, left)
        size += step
    return best


def anchor_places(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Places (word indexes of the block) and hashes of the anchors of a block's k-mers."""
    m = len(words) - k + 1
    if m <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    found = np.unique(_own_anchor(words, k)[:m][words.within(k)])
    return found, ngrams(words.hashes, min(ANCHOR, k), seed=1)[found]


def _anchors(k: int):
    def work(block: pa.RecordBatch) -> dict:
        texts = block.column("text")
        words = find_words(texts, SPACED)
        found, h = anchor_places(words, k)
        cuts = np.searchsorted(found, words.first)
        places = words.place[found].astype(np.int32)
        split = [(h[a:b].view(np.int64), places[a:b]) for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())]
        keys = [hashlib.sha256((t or "").encode()).digest()[:KEY_BYTES] for t in texts.to_pylist()]
        return {"doc_id": block.column("doc_id"), "key": keys, "n_words": words.counts,
                "anchors": [a for a, _ in split], "places": [p for _, p in split]}

    return work


def _edges(k: int):
    def work(block: pa.RecordBatch) -> dict | None:
        words = find_words(block.column("text"), SPACED)
        m = len(words) - k + 1
        if m <= 0:
            return None
        # A k-mer can repeat only if its own anchor does.
        listed = block.column("places")
        at = listed.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        sizes = pc.list_value_length(listed).fill_null(0).to_numpy(zero_copy_only=False)
        marks = np.zeros(len(words), bool)
        marks[at + np.repeat(words.first[:-1], sizes)] = True
        chosen = np.flatnonzero(marks[_own_anchor(words, k)[:m]] & words.within(k))
        if not len(chosen):
            return None
        nodes = ngrams(words.hashes, k - 1, seed=2).view(np.int64)
        pair = np.zeros(len(words) + 1, np.uint64)
        pair[2:] = np.cumsum(mix(words.hashes[:-1] * np.uint64(0x9E3779B97F4A7C15) ^ words.hashes[1:] + np.uint64(7))
                             >> (np.uint64(64) - _CHECK_BITS))
        doc = words.doc[chosen]
        check = (pair[chosen + 1] - pair[words.first[doc]]).view(np.int64)
        rank = block.column("rank").to_numpy(zero_copy_only=False).astype(np.int64)
        return {"source": nodes[chosen], "target": nodes[chosen + 1],
                "doc_id": block.column("doc_id").to_numpy(zero_copy_only=False)[doc],
                "place": words.place[chosen] + (rank[doc] << 32), "checksum": check}

    return work


def keyed(docs: DataFrame) -> DataFrame:
    """Documents with the key of their text, as ``_anchors`` takes it."""
    digest = F.unhex(F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256))
    return docs.withColumn("key", F.substring(digest, 1, KEY_BYTES))


def text_classes(docs: DataFrame, k: int) -> DataFrame:
    """Per document: key of its text, anchors with places."""
    return map_blocks(docs, _anchors(k), "doc_id long, key binary, n_words long, anchors array<long>, places array<int>")


def repeated_edges(edges: DataFrame) -> DataFrame:
    """Places of edges that several documents have, with the smallest of these as origin."""
    found = edges.groupBy("source", "target").agg(F.min("doc_id").alias("origin"), F.max("doc_id").alias("last"))
    return edges.join(found.where("origin < last").drop("last"), ["source", "target"])


def at_origin(places: DataFrame) -> DataFrame:
    """Each repeated edge once, with its first place at its origin and the degrees of its two nodes."""
    edges = places.where("doc_id = origin").groupBy("source", "target").agg(
        F.first("origin").alias("origin"), F.min("place").alias("origin_place"),
        F.min_by("checksum", "place").alias("origin_checksum"))
    leaving = edges.groupBy("source").agg(F.count(F.lit(1)).alias("leaving"))
    entering = edges.groupBy("target").agg(F.count(F.lit(1)).alias("entering"))
    return edges.join(leaving, "source").join(entering, "target")


def compacted(edges: DataFrame) -> DataFrame:
    """Repeated edges with the nonbranching path they lie on: ``path`` is the place of its first edge at the origin.

    An edge continues the path of the edge one place before it at the same origin, if exactly one repeated edge enters
    and one leaves the node between them.
    """
    order = Window.partitionBy("origin").orderBy("origin_place")
    goes_on = ((F.col("origin_place") == F.lag("origin_place").over(order) + 1)
               & (F.col("leaving") == 1) & (F.lag("entering").over(order) == 1))
    begins = F.when(F.coalesce(goes_on, F.lit(False)), None).otherwise(F.col("origin_place"))
    path = F.last(begins, ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0))
    return edges.withColumn("path", path)


def repeated_spans(docs: DataFrame, k: int = 50) -> tuple[DataFrame, DataFrame]:
    """``(copies, spans)`` of (doc_id, text) rows.

    copies: (doc_id, key) of documents whose whole text a smaller id has and that have a k-mer. spans: one row per
    verified place of a path in a document, (doc_id, key, start, n_words, origin, origin_start): these words also stand
    at the origin, whose id is smaller. Spans of a document may overlap.
    """
    classes = stored(text_classes(docs, k))
    least = classes.groupBy("key").agg(F.min("doc_id").alias("head"))
    rank = F.row_number().over(Window.partitionBy("doc_id").orderBy("key")) - 1
    heads = stored(least.where(F.col("head").isNotNull()).select(F.col("head").alias("doc_id"), "key").withColumn("rank", rank))
    copies = (classes.where(F.col("n_words") >= k).select("doc_id", "key").join(least, "key")
              .where(F.col("doc_id") > F.col("head")).select("doc_id", "key").distinct())

    listed = joined(classes.where(F.size("anchors") > 0), heads, ["doc_id", "key"], "inner", F.lit(36))
    anchors = listed.select("doc_id", "rank", F.inline(F.arrays_zip("anchors", "places"))).toDF(
        "doc_id", "rank", "anchor", "place")
    shared = stored(anchors.groupBy("anchor").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b"))
                    .where("a < b").select("anchor"))
    marked = joined(anchors, shared, ["anchor"], "inner", F.lit(16))
    marked = marked.groupBy("doc_id", "rank").agg(F.collect_list("place").alias("places"))
    marked = stored(joined(marked, heads, ["doc_id", "rank"], "inner", F.lit(36)))

    # Scanning the marked texts twice costs less disk than a table of all candidate edges.
    edges = map_blocks(joined(keyed(docs), marked, ["doc_id", "key"], "inner", list_bytes("places", each=4)), _edges(k), EDGE)
    repeated = stored(repeated_edges(edges))
    paths = compacted(at_origin(repeated))
    places = (repeated.where("doc_id > origin").drop("origin").join(paths, ["source", "target"])
              .select("doc_id", "place", "checksum", "origin", "origin_place", "origin_checksum", "path"))

    # Runs of places that move along one path in step with its origin.
    along = ["doc_id", "origin", "path", (F.col("place") - F.col("origin_place")).alias("shift")]
    steps = places.select(*along, "place", "checksum", "origin_place", "origin_checksum")
    run = Window.partitionBy("doc_id", "origin", "path", "shift").orderBy("place")
    steps = steps.withColumn("run", F.col("place") - F.row_number().over(run))
    # place, origin_place and both checksums grow together along a run: least and greatest are its two ends.
    ends = steps.groupBy("doc_id", "origin", "path", "shift", "run").agg(
        F.min("place").alias("start"), F.max("place").alias("stop"), F.min("origin_place").alias("origin_start"),
        (F.max("checksum") - F.min("checksum")).alias("own"),
        (F.max("origin_checksum") - F.min("origin_checksum")).alias("theirs"))
    place = lambda c: F.col(c).bitwiseAND((1 << 32) - 1).cast("int").alias(c)
    spans = ends.where(F.col("own") == F.col("theirs")).select(
        "doc_id", F.shiftright("start", 32).cast("int").alias("rank"), place("start"),
        (F.col("stop") - F.col("start") + k).cast("int").alias("n_words"), "origin", place("origin_start"))
    return copies, joined(spans, heads, ["doc_id", "rank"], "inner", F.lit(36)).drop("rank")


def _cut(carried: Carried):
    def work(block: pa.RecordBatch) -> dict:
        texts = block.column("text")
        words = find_words(texts, SPACED)
        marks = np.zeros(len(words) + 1, np.int32)
        copied = block.column("copied").fill_null(False).to_numpy(zero_copy_only=False)
        for name, step in (("starts", 1), ("stops", -1)):
            listed = block.column(name)
            sizes = pc.list_value_length(listed).fill_null(0).to_numpy(zero_copy_only=False)
            at = listed.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            np.add.at(marks, at + np.repeat(words.first[:-1], sizes), step)
        gone = (np.cumsum(marks)[:len(words)] > 0) | copied[words.doc]
        removed = np.bincount(words.doc, weights=gone, minlength=len(texts)).astype(np.int64)
        kept = [words.text(d, ~gone if n else None) for d, n in enumerate(removed.tolist())]
        return {"doc_id": block.column("doc_id"), "n_words": words.counts, "n_removed": removed,
                "kept": [k.decode() for k in kept], **carried.of(block)}

    return work


def remove_repeats(df: DataFrame, k: int = 50, id_col: str = "doc_id", text_col: str = "text",
                   carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per row of ``df``: doc_id, n_words, n_removed, kept (the words left, joined by one space), and ``carry``."""
    docs, carried = documents(df, id_col, text_col), Carried(df, carry)
    copies, spans = repeated_spans(docs, k)
    cuts = spans.select("doc_id", "key", "start", (F.col("start") + F.col("n_words")).alias("stop"),
                        F.lit(False).alias("copied"))
    whole = copies.select("doc_id", "key", F.lit(None).cast("int").alias("start"), F.lit(None).cast("int").alias("stop"),
                          F.lit(True).alias("copied"))
    # Equal bounds from several origins are one.
    marks = cuts.unionByName(whole).groupBy("doc_id", "key").agg(
        F.collect_set(F.struct("start", "stop")).alias("spans"), F.max("copied").alias("copied"))
    marks = marks.withColumn("spans", F.filter("spans", lambda s: s["start"].isNotNull()))
    marks = stored(marks.select(
        "doc_id", "key", "copied", F.col("spans.start").alias("starts"), F.col("spans.stop").alias("stops")))
    met = joined(keyed(documents(df, id_col, text_col, carried)), marks, ["doc_id", "key"], "left",
                 list_bytes("starts", "stops", each=4))
    return carried.renamed(map_blocks(met, _cut(carried), "doc_id long, n_words long, n_removed long, kept string" + carried.ddl))
