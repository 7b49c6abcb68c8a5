"""N-gram Jaccard join with adaptive multi-match prefixes.

A document is the set of its word shingles. All sets are ordered by one global order, rare shingles first: a sketch of
fixed size counts shingles in slots, a slot's level is how far it lies above the mean (by powers of two), and the order
is (level, hash). Two sets with Jaccard similarity t or more share at least l shingles among the first
``n - ceil(t n) + l`` of each. A document's l is chosen from the sketch: the more documents its prefix may meet, the
longer the prefix and the more shared shingles a partner must show before the pair is verified; a pair needs the
smaller l of the two, which both prefixes cover. Verification counts the exact intersection of both whole sets.

Classes, not pairs, are returned, which spares groups of copies their pairs and loses no link between them:

* Equal sets are one class by the digest of the set; only their smallest id takes part in what follows.
* Every posting first verifies its documents against its smallest one (a star: as many pairs as postings); components
  of these links are formed.
* Then only pairs of different components are left. In each posting the documents outside its main component meet the
  others that fit: in size, in position, as partners share nothing before the first shingle at which they meet, and by
  small parity bitmaps, whose distance bounds the symmetric difference from below. A pair meets once or little more,
  not at each of the hundreds of shingles it may share: a shingle goes along with the ``_BEFORE`` that come before it
  in the document's postings, and documents that have one of these in common have met there already.
  Pairs are compared by larger bitmaps; those that share enough prefix shingles are verified exactly.

Postings of rare slots are formed by a window, as the sketch bounds their length; those of frequent slots, or all if
that bound is large, by pre-aggregation and a join that Spark can split.

Defined results: a null or empty text has no shingles and no links; a text of fewer words than a shingle is one
shingle of all its words; rows with equal ids are one node of the graph; a null id links with nothing and has a null
component; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .graph import components
from .tables import joined, stored
from .words import SPACED_LOWER, Words, blocks, documents, find_words, map_blocks, ngrams, small_batches

#: Slots of the sketch (a power of two): 4 MB of levels for each worker.
SLOTS = 1 << 22
_CHUNK = 8192
#: Greatest number of shared prefix shingles asked for.
MOST_MATCHES = 8
#: A posting of a slot counted up to this is small enough for one task's window.
WINDOW_ROWS = 200_000
#: Bits of a parity bitmap for each shingle, and its least and greatest length in bits.
_BITS = (2, 512, 1 << 14)
#: Words of the folded bitmap that goes along with postings.
_FOLD = 8
#: Shingles before one that tell whether documents have met already.
_BEFORE = 2


def shingles(words: Words, size: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each document of a block."""
    h = ngrams(words.hashes, size)
    first = words.first.tolist()
    for a, b in zip(first[:-1], first[1:]):
        if b - a >= size:
            yield np.unique(h[a:b - size + 1])
        else:
            yield ngrams(words.hashes[a:b], b - a) if b > a else np.zeros(0, np.uint64)


def bitmap(own: np.ndarray) -> bytes:
    """Parity bitmap: bit i tells whether an odd number of shingles falls on i."""
    bits = min(_BITS[2], max(_BITS[1], 1 << int(_BITS[0] * max(1, len(own)) - 1).bit_length()))
    return np.packbits(np.bincount((own & np.uint64(bits - 1)).astype(np.int64), minlength=bits).astype(np.uint8) & 1,
                       bitorder="little").tobytes()


def _folded(body: bytes, size: int) -> np.ndarray:
    own = np.frombuffer(body, np.uint8)
    return np.bitwise_xor.reduce(own.reshape(-1, size), axis=0)


def _slot(own: np.ndarray, slots: int) -> np.ndarray:
    return (own & np.uint64(slots - 1)).astype(np.int64)


def _count(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(SLOTS, np.int32)
        for block in blocks(batches, "text"):
            sets = list(shingles(find_words(block.column("text"), SPACED_LOWER), size))
            np.add.at(counts, _slot(np.concatenate(sets), SLOTS), 1)
        parts = counts.reshape(-1, _CHUNK)
        for i in np.flatnonzero(parts.any(axis=1)).tolist():
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([parts[i].tobytes()], pa.binary())],
                                             ["chunk", "counts"])

    return run


def _sum(kind: str):
    def run(table: pa.Table) -> pa.Table:
        total = np.zeros(_CHUNK, np.int64)
        for body in table["counts"]:
            total += np.frombuffer(body.as_py(), kind)
        return pa.table({"chunk": table["chunk"][:1], "counts": pa.array([total.tobytes()], pa.binary())})

    return run


def _levels(mean: float):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [np.frombuffer(x, "<i8") for x in batch.column("counts").to_pylist()]
            levels = [np.floor(np.log2(np.maximum(x / mean, 1))).astype(np.uint8) for x in rows]
            bounds = [int(x[level == 0].max(initial=0)) for x, level in zip(rows, levels)]
            yield pa.RecordBatch.from_arrays([batch.column("chunk"), pa.array([x.tobytes() for x in levels], pa.binary()),
                                              pa.array(bounds, pa.int64())], ["chunk", "levels", "bound"])

    return work


def slot_levels(docs: DataFrame, size: int) -> tuple[np.ndarray, int]:
    """Level of each slot, and the greatest count of a slot of level 0. The driver gets a byte for each slot."""
    small_batches(docs.sparkSession)
    schema = "chunk int, counts binary"
    counted = docs.mapInArrow(_count(size), schema).withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(64)))
    partly = counted.groupBy("chunk", "salt").applyInArrow(
        lambda t: _sum("<i4")(t.select(["chunk", "counts"])), schema)
    counts = stored(partly.groupBy("chunk").applyInArrow(_sum("<i8"), schema))
    each = counts.mapInArrow(_total, "n long").agg(F.sum("n")).first()[0] or 0
    levels, bound = np.zeros((SLOTS // _CHUNK, _CHUNK), np.uint8), 0
    rows = counts.mapInArrow(_levels(max(1.0, each / SLOTS)), "chunk int, levels binary, bound long")
    for row in rows.collect():  # a fixed number of rows
        levels[row["chunk"]] = np.frombuffer(row["levels"], np.uint8)
        bound = max(bound, row["bound"])
    return levels.ravel(), bound


def _total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n = [int(np.frombuffer(x, "<i8").sum()) for x in batch.column("counts").to_pylist()]
        yield pa.RecordBatch.from_arrays([pa.array(n, pa.int64())], ["n"])


def _classes(size: int):
    def work(block: pa.RecordBatch) -> dict:
        own = list(shingles(find_words(block.column("text"), SPACED_LOWER), size))
        return {"doc_id": block.column("doc_id"), "n": np.array([len(s) for s in own], np.int64),
                "key": [hashlib.sha256(s.tobytes()).digest()[:16] for s in own]}

    return work


def matches_asked(levels: np.ndarray, n: int, base: int) -> int:
    """l of a document: grows with the logarithm of the frequent postings its prefix meets."""
    met = float((np.exp2(levels[:base].astype(np.float64)) - 1).sum())
    return int(min(MOST_MATCHES, n - base + 1, 1 + np.log2(1 + met)))


def _ordered(own: np.ndarray, levels: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Prefix of a set in the global order, the levels of its shingles, and the matches it asks for."""
    level = levels[_slot(own, len(levels))]
    order = np.argsort(level, kind="stable")  # hashes are sorted already
    base = len(own) - -(-percent * len(own) // 100) + 1
    asked = matches_asked(level[order], len(own), base)
    head = order[:base + asked - 1]
    return own[head], level[head], asked


def _heads(block: pa.RecordBatch, levels: np.ndarray, size: int, percent: int) -> tuple[list, list]:
    sets = list(shingles(find_words(block.column("text"), SPACED_LOWER), size))
    return sets, [_ordered(s, levels, percent) if len(s) else (s, s, 0) for s in sets]


def _prefixes(shared, size: int, percent: int):
    def work(block: pa.RecordBatch) -> dict:
        _, heads = _heads(block, shared.value, size, percent)
        return {"doc_id": block.column("doc_id"), "tokens": [t.view(np.int64) for t, _, _ in heads],
                "frequent": [level > 0 for _, level, _ in heads]}

    return work


def _infos(shared, size: int, percent: int):
    def work(block: pa.RecordBatch) -> dict:
        sets, heads = _heads(block, shared.value, size, percent)
        return {"doc_id": block.column("doc_id"), "n": [len(s) for s in sets],
                "asked": [asked for _, _, asked in heads], "bits": (bits := [bitmap(s) for s in sets]),
                "fold": [_folded(b, 8 * _FOLD).view(np.int64) for b in bits]}

    return work


def _verified(size: int, percent: int):
    def work(block: pa.RecordBatch) -> dict | None:
        # Texts of a are often the same in successive rows.
        known: dict[int, np.ndarray] = {}
        for side in ("a", "b"):
            fresh = dict(zip(block.column(side).to_pylist(), range(block.num_rows)))
            fresh = {k: i for k, i in fresh.items() if k not in known}
            texts = block.column(f"text_{side}").take(pa.array(fresh.values(), pa.int64()))
            known |= dict(zip(fresh, shingles(find_words(texts, SPACED_LOWER), size)))
        pairs = [(a, b) for a, b in zip(block.column("a").to_pylist(), block.column("b").to_pylist())
                 if _similar(known[a], known[b], percent)]
        return {"a": [p[0] for p in pairs], "b": [p[1] for p in pairs]} if pairs else None

    return work


def _similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    if percent * max(len(a), len(b)) > 100 * min(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def _near(percent: int):
    """Pairs that their bitmaps do not rule out: the symmetric difference is at least the bitmaps' distance."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for i, (x, y, n, m) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("x", "y", "n", "m")))):
                size = min(len(x), len(y))
                apart = int(np.bitwise_count(_folded(x, size) ^ _folded(y, size)).sum())
                # both = (n + m - difference) / 2 must reach percent of n + m - both
                if (100 + percent) * (n + m - apart) >= 2 * percent * (n + m):
                    keep.append(i)
            yield batch.select(["a", "b", "asked"]).take(pa.array(keep, pa.int64()))

    return run


def _checked(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """Pairs (a, b) whose sets are similar."""
    with_b = pairs.join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b")
    with_a = with_b.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a")
    return stored(map_blocks(with_a.select("a", "b", "text_a", "text_b"), _verified(size, percent), "a long, b long",
                             text="text_b"))


def _several(rows: DataFrame, bounded: bool) -> DataFrame:
    """Rows whose token several documents have, with the smallest of them as ``first``."""
    if bounded:
        w = Window.partitionBy("token")
        return rows.withColumns({"first": F.min("doc_id").over(w), "last": F.max("doc_id").over(w)}).where(
            "first < last").drop("last")
    found = rows.groupBy("token").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    return rows.join(found.where("first < last").select("token", "first"), "token")


def near_classes(df: DataFrame, size: int = 5, percent: int = 75, id_col: str = "doc_id", text_col: str = "text"
                 ) -> DataFrame:
    """One row per row of ``df``: doc_id, n_shingles, component_id (the smallest id reachable by links)."""
    docs, spark = documents(df, id_col, text_col), df.sparkSession
    classes = stored(map_blocks(docs, _classes(size), "doc_id long, n long, key binary"))
    sets = classes.where("n > 0").groupBy("key").agg(F.min("doc_id").alias("head"))
    heads = stored(sets.select(F.col("head").alias("doc_id")).distinct())
    links = _links(spark, joined(docs, heads, ["doc_id"], "left_semi", F.lit(16)), size, percent)

    same = classes.join(sets, "key").where("doc_id <> head").select(F.col("head").alias("a"), F.col("doc_id").alias("b"))
    found = components(links.unionByName(same))
    named = classes.join(found.withColumnRenamed("node", "doc_id"), "doc_id", "left")
    return named.select("doc_id", F.col("n").alias("n_shingles"),
                        F.coalesce("component", "doc_id").alias("component_id"))


def _links(spark: SparkSession, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """Links (a, b) that connect what the join connects, of documents with distinct sets."""
    levels, bound = slot_levels(docs, size)
    shared = spark.sparkContext.broadcast(levels)
    prefixes = map_blocks(docs, _prefixes(shared, size, percent), "doc_id long, tokens array<long>, frequent array<boolean>")
    tokens = prefixes.select("doc_id", F.posexplode(F.arrays_zip("tokens", "frequent")).alias("at", "e")).select(
        "doc_id", "at", F.col("e.tokens").alias("token"), F.col("e.frequent").alias("frequent"))
    rare = _several(tokens.where("NOT frequent").drop("frequent"), bound <= WINDOW_ROWS)
    postings = stored(rare.unionByName(_several(tokens.where("frequent").drop("frequent"), False)))
    met_first = stored(postings.groupBy("doc_id").agg(F.min("at").alias("alone")))
    texts = stored(joined(docs, met_first.select("doc_id"), ["doc_id"], "left_semi", F.lit(16)))
    infos = map_blocks(texts, _infos(shared, size, percent), "doc_id long, n int, asked int, bits binary, fold array<long>")
    # The first shingle that partners share is in both prefixes, so none before a document's first posting is shared.
    infos = stored(infos.join(met_first, "doc_id").withColumn("open", F.col("n") - F.col("alone")))

    stars = postings.where("doc_id <> first").select(F.col("first").alias("a"), F.col("doc_id").alias("b")).distinct()
    linked = _checked(_plausible(stars, infos, percent).drop("asked"), texts, size, percent)

    labels = infos.select("doc_id", "n", "open", "fold").join(
        components(linked).withColumnRenamed("node", "doc_id"), "doc_id", "left").withColumn(
        "component", F.coalesce("component", "doc_id"))
    # A document that meets others too late has no partner of any size. What comes before a shingle is known of ids with
    # one text only.
    labels = stored(labels.where(F.col("open") * 100 >= F.col("n") * percent).drop("open").withColumn(
        "single", F.count(F.lit(1)).over(Window.partitionBy("doc_id")) == 1))
    named = stored(postings.drop("first").join(labels.select("doc_id", "component").distinct(), "doc_id"))
    mixed = named.groupBy("token").agg(F.min("component").alias("low"), F.max("component").alias("high"),
                                       F.mode("component", True).alias("main")).where("low < high")
    mixed = named.join(mixed.select("token", "main"), "token")
    met = _meetings(stored(_preceded(mixed).join(labels.drop("component"), "doc_id")), percent)
    pairs = _plausible(met.select(F.least("p_doc_id", "doc_id").alias("a"), F.greatest("p_doc_id", "doc_id").alias("b"))
                       .distinct(), infos, percent)
    return linked.unionByName(_checked(_matching(pairs, named), texts, size, percent))


def _preceded(rows: DataFrame) -> DataFrame:
    """Rows of postings with the tokens before each in its document."""
    w = Window.partitionBy("doc_id").orderBy("at")
    earlier = F.array(*(F.lag("token", i).over(w) for i in range(1, _BEFORE + 1)))
    return rows.withColumn("before", F.filter(earlier, lambda t: t.isNotNull()))


def _meetings(mixed: DataFrame, percent: int) -> DataFrame:
    """Documents of different components that meet in a posting, one of them outside its main component. Each pair that
    is similar is there at the first shingle that both share."""
    outside = mixed.where("component <> main").select("token", *(F.col(c).alias(f"p_{c}") for c in (
        "doc_id", "n", "at", "single", "before", "fold", "component")))
    # Bits in which the folded bitmaps differ: the sets differ in as many shingles at least.
    apart = sum((F.bit_count(F.get("fold", F.lit(i)).bitwiseXOR(F.get("p_fold", F.lit(i)))) for i in range(_FOLD)), F.lit(0))
    # A document outside the main component meets all others; of two outside ones the smaller meets the larger. No more
    # can be shared than the shorter rest holds.
    return outside.join(mixed, "token").where(
        (F.col("component") != F.col("p_component"))
        & ((F.col("component") == F.col("main")) | (F.col("p_doc_id") < F.col("doc_id")))
        & ((F.col("n") + F.col("p_n")) * percent
           <= F.least(F.col("n") - F.col("at"), F.col("p_n") - F.col("p_at")) * (100 + percent))
        & ((F.col("n") + F.col("p_n") - apart) * (100 + percent) >= (F.col("n") + F.col("p_n")) * (2 * percent))
        & ~(F.col("single") & F.col("p_single") & F.arrays_overlap("before", "p_before")))


def _matching(pairs: DataFrame, named: DataFrame) -> DataFrame:
    """Pairs (a, b) that share as many prefix shingles as both ask for."""
    a, b = (named.select(F.col("doc_id").alias(side), "token").distinct() for side in "ab")
    shared = pairs.join(a, "a").join(b, ["b", "token"]).groupBy("a", "b").agg(
        F.count(F.lit(1)).alias("shared"), F.min("asked").alias("asked"))
    return stored(shared.where("shared >= asked").select("a", "b"))


def _plausible(pairs: DataFrame, infos: DataFrame, percent: int) -> DataFrame:
    """Pairs that fit in size and whose bitmaps are near, with the prefix shingles they are to share."""
    a = infos.select(F.col("doc_id").alias("a"), "n", F.col("asked").alias("asked_a"), F.col("bits").alias("x"), "open")
    b = infos.select(F.col("doc_id").alias("b"), F.col("n").alias("m"), F.col("asked").alias("asked_b"),
                     F.col("bits").alias("y"), F.col("open").alias("open_b"))
    fit = pairs.join(a, "a").join(b, "b").where(
        (F.least("n", "m") * 100 >= F.greatest("n", "m") * percent)
        & ((F.col("n") + F.col("m")) * percent <= F.least("open", "open_b") * (100 + percent)))
    asked = F.least("asked_a", "asked_b").alias("asked")
    return stored(fit.select("a", "b", asked, "x", "y", "n", "m").mapInArrow(_near(percent), "a long, b long, asked int"))
