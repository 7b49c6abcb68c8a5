"""Phrase collocations: an FM-index per shard lists phrases with their counts, which are summed across shards.

Shards are bounded blocks of documents. Each is indexed once over its own word ids (``phrase_index``) and written to
the shared folder: vocabulary, counts and the two symbol arrays, 8 bytes a word. Rounds then read the indexes only.

A phrase is frequent only if all its parts are, so each round extends what the round before left: single words are
extended to the right, pairs and longer phrases to the left and right in turn, and a phrase is counted only if both of
its parts of one word less passed. What passed is told to the shards by a bitmap of at most 16 MB, whatever its number:
a wrong bit costs an entry that the sum across shards drops again, never a phrase. Counts are summed by 64-bit keys of
words, whose seed is changed until no frequent word shares its key with another word.

Hot words and phrases are summed within each shard and within each task before the shuffle, and the ranking keeps a
language's first rows in every task before one task orders them.

Defined results: a null text is empty, a null language is ``und``; repeated rows count each; other columns and the ids
are ignored. Arithmetic on counts is exact: products are taken as 38-digit decimals.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .phrase_index import PhraseIndex, Phrases
from .tables import stored
from .word_ids import word_ids
from .words import Words, arrow_schema, byte_table, find_words, gathered, small_batches

#: Bytes of text in a shard; a longer document is a shard of its own.
SHARD_BYTES = 2 << 20
#: A table of counts or words up to this size is broadcast to the joins that score phrases; a plan has several of them.
BROADCAST_BYTES = 4 << 20
#: The bitmap of frequent phrases has 16 bits for each, within these bounds.
_LEAST_BITS, _MOST_BITS = 1 << 16, 1 << 27

#: What ends a piece of text, and what else ends a word.
PIECE_ENDS = ".,;:!?\n\x0b\x0c\r"
_TABLE = byte_table(PIECE_ENDS + "\t ", lower=True)
_TABLE[0] = 0xFF
_ENDS = np.zeros(256, np.int8)
_ENDS[[ord(c) for c in PIECE_ENDS]] = 1

_INDEX = "lang array<string>, word array<string>, counts array<int>, before binary, after binary"
_U = np.uint64


def _joined(words: Words) -> np.ndarray:
    """Does the next word of each but the last continue its piece."""
    ends = np.concatenate([[0], np.cumsum(_ENDS[words.raw], dtype=np.int64)])
    return (words.doc[1:] == words.doc[:-1]) & (ends[words.starts[1:]] == ends[words.ends[:-1]])


def _shard(block: pa.RecordBatch, depth: int) -> dict | None:
    words = find_words(block.column("text"), _TABLE)
    if not len(words):
        return None
    ids, sample = word_ids(words)
    tongues = block.column("lang").fill_null("und").dictionary_encode()
    tongue = tongues.indices.to_numpy(zero_copy_only=False).astype(np.int64)[words.doc]
    pairs, symbols = np.unique(ids * len(tongues.dictionary) + tongue, return_inverse=True)
    index = PhraseIndex.of(symbols + 1, _joined(words), len(pairs), depth)
    wording = pa.array([words.word(i).replace(b"\xff", b"\x00").decode() for i in sample.tolist()], pa.string())
    return {"lang": tongues.dictionary.take(pa.array(pairs % len(tongues.dictionary))),
            "word": wording.take(pa.array(pairs // len(tongues.dictionary))), "counts": pa.array(index.counts, pa.int32()),
            "before": index.before.tobytes(), "after": index.after.tobytes()}


def _build(depth: int, shard_bytes: int):
    schema = arrow_schema(_INDEX)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in gathered(batches, "text", shard_bytes):
            row = _shard(block, depth)
            if row is not None:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([v]) if isinstance(v, bytes) else pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), v)
                     for v in row.values()], schema=schema)

    return run


def _turned(key: Column, by: int) -> Column:
    return F.shiftleft(key, by).bitwiseOR(F.shiftrightunsigned(key, 64 - by))


def _spot(columns: list[str]) -> Column:
    """Where a phrase stands in a bitmap, from its words' keys; ``_spots`` is the same over arrays."""
    out = F.col(columns[0])
    for c in columns[1:]:
        out = _turned(out, 21).bitwiseXOR(F.col(c))
    return out


def _spots(keys: np.ndarray, bits: int) -> np.ndarray:
    out = keys[:, 0].copy()
    for i in range(1, keys.shape[1]):
        out = (out << _U(21) | out >> _U(43)) ^ keys[:, i]
    return out & _U(bits - 1)


class _Bitmap:
    def __init__(self, level: DataFrame, columns: list[str], count: int):
        self.bits = min(_MOST_BITS, max(_LEAST_BITS, 1 << (16 * count).bit_length()))
        at = _spot(columns).bitwiseAND(F.lit(self.bits - 1))
        cells = level.select(F.shiftright(at, 6).alias("cell"), F.expr("1L").alias("one"), at.bitwiseAND(63).cast("int").alias("bit"))
        cells = cells.groupBy("cell").agg(F.bit_or(F.expr("shiftleft(one, bit)")).alias("mask")).toArrow()
        self.cells = np.zeros(self.bits >> 6, _U)
        self.cells[cells["cell"].to_numpy()] = cells["mask"].to_numpy().view(_U)

    def has(self, keys: np.ndarray) -> np.ndarray:
        at = _spots(keys, self.bits)
        return (self.cells[(at >> _U(6)).astype(np.int64)] >> (at & _U(63)) & _U(1)).astype(bool)


def _phrases(index: PhraseIndex, keys: np.ndarray, passed: list[_Bitmap]) -> Phrases:
    """Phrases of one word more than there are bitmaps, whose parts pass them."""
    known = passed[0].has(keys[:, None])
    out = index.words().take(known)
    for size, bitmap in enumerate([None, *passed[1:]], start=1):
        if bitmap is not None:
            out = out.take(bitmap.has(keys[out.words - 1]))
        left = size % 2 == 0
        out = index.extended(out, left, known, len(passed) - size)
        if bitmap is not None:
            rest = out.words[:, :-1] if left else out.words[:, 1:]
            out = out.take(bitmap.has(keys[rest - 1]))
    return out


def _enumerate(shared, names: list[str]):
    schema = arrow_schema(", ".join(f"{n} long" for n in [*names, "n"]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                keys, counts = (batch.column(c)[row].values.to_numpy(zero_copy_only=False) for c in ("keys", "counts"))
                before, after = (np.frombuffer(batch.column(c)[row].as_buffer(), np.int32) for c in ("before", "after"))
                keys = keys.view(_U)
                found = _phrases(PhraseIndex(before, after, counts), keys, shared.value)
                for a in range(0, len(found), 1 << 16):
                    part = found.take(slice(a, a + (1 << 16)))
                    named = keys[part.words - 1].view(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.ascontiguousarray(named[:, i])) for i in range(len(names))] + [pa.array(part.count)],
                        schema=schema)

    return run


def _keyed(index: DataFrame, seed: int) -> DataFrame:
    return index.withColumn("keys", F.zip_with("lang", "word", lambda x, w: F.xxhash64(F.lit(seed), x, w)))


def _seed(words: DataFrame, least: int) -> int:
    """The first seed under which no frequent word shares its key with another word."""
    for seed in range(64):
        keys = words.groupBy(F.xxhash64(F.lit(seed), "lang", "word").alias("key")).agg(
            F.count(F.lit(1)).alias("words"), F.max("f").alias("f"))
        if keys.where((F.col("words") > 1) & (F.col("f") >= least)).isEmpty():
            return seed
    raise RuntimeError("no seed keeps the keys of frequent words apart")


@contextmanager
def _few_rows(spark: SparkSession, rows: int = 4) -> Iterator[None]:
    """Batches of few rows while indexes, a few MB each, are read and go to the workers; the session's sizes afterwards."""
    names = ("spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.parquet.columnarReaderBatchSize")
    before = [spark.conf.get(name) for name in names]
    for name in names:
        spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        for name, value in zip(names, before):
            spark.conf.set(name, value)


def _met(left: DataFrame, right: DataFrame, on: list[str], size: int) -> DataFrame:
    return left.join(F.broadcast(right) if size <= BROADCAST_BYTES else right.hint("merge"), on)


def collocations(docs_df: DataFrame, least: int = 10, longest: int = 3, top: int = 2000, inside: int = 50,
                 shard_bytes: int = SHARD_BYTES, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The ``top`` phrases of 2 to ``longest`` words of each language that stand at least ``least`` times: lang, rank,
    phrase, a (its count), l and r (counts of the two parts of its lowest-scoring cut), cut (words of the first part),
    n (words of the language), score = floor(1000000 a a / (l r)), and n_left, n_right: how many frequent phrases of one
    word more add a word to that side. A phrase inside a longer one that has ``inside`` percent of its count is dropped."""
    spark = docs_df.sparkSession
    small_batches(spark)
    docs = docs_df.select(F.col(f"`{text_col}`").cast("string").alias("text"), F.col(f"`{lang_col}`").cast("string").alias("lang"))
    # Small row groups and a page for each row: writers, readers and codecs hold one of them in memory.
    index = stored(docs.mapInArrow(_build(max(1, longest - 1), shard_bytes), _INDEX),
                   **{"parquet.block.size": str(16 << 20), "parquet.page.row.count.limit": "1"})
    listed = index.select(F.explode(F.arrays_zip("lang", "word", "counts")).alias("w")).select("w.*")
    with _few_rows(spark):
        words = stored(listed.groupBy("lang", "word").agg(F.sum("counts").alias("f")))
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    seed = _seed(words, least)
    keyed = _keyed(index, seed)
    frequent = stored(words.where(F.col("f") >= least).withColumn("k1", F.xxhash64(F.lit(seed), "lang", "word")))
    levels, counts, passed = [frequent.select("k1", "f")], [frequent.count()], []
    for size in range(2, longest + 1):
        names = [f"k{i}" for i in range(1, size + 1)]
        passed.append(_Bitmap(levels[-1], names[:-1], counts[-1]))
        shared = spark.sparkContext.broadcast(passed)
        with _few_rows(spark):
            found = keyed.select("keys", "counts", "before", "after").mapInArrow(
                _enumerate(shared, names), ", ".join(f"{n} long" for n in [*names, "n"]))
            level = stored(found.groupBy(*names).agg(F.sum("n").alias("f")).where(F.col("f") >= least))
        shared.destroy()
        levels.append(level)
        counts.append(level.count())
    width = frequent.agg(F.sum(F.octet_length("word") + F.octet_length("lang") + 24)).first()[0] or 0
    kept = [_scored(levels, counts, size, frequent, width, inside) for size in range(2, longest + 1)]
    ordered = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = reduce(DataFrame.unionByName, kept).withColumn("rank", F.row_number().over(ordered).cast("long"))
    ranked = ranked.where(F.col("rank") <= top)
    # One row for each language, met by what the ranking left.
    return ranked.join(totals, "lang").select(
        "lang", "rank", "phrase", "a", "l", "r", "cut", "n", "score", "n_left", "n_right")


def _scored(levels: list[DataFrame], counts: list[int], size: int, words: DataFrame, width: int, inside: int) -> DataFrame:
    names = [f"k{i}" for i in range(1, size + 1)]
    out = levels[size - 1].withColumnRenamed("f", "a")
    for part in range(1, size):
        for side, own in (("first", names[:part]), ("last", names[size - part:])):
            if part > 1:
                other = levels[part - 1].select(*(F.col(f"k{i + 1}").alias(c) for i, c in enumerate(own)),
                                                F.col("f").alias(f"{side}{part}"))
                out = _met(out, other, own, counts[part - 1] * 8 * (part + 1))
    for i, c in enumerate(names):
        named = [F.col("k1").alias(c), F.col("word").alias(f"w{i}")]
        named += [F.col("lang"), F.col("f").alias("first1")] if i == 0 else []
        named += [F.col("f").alias("last1")] if i == size - 1 else []
        out = _met(out, words.select(*named), [c], width)
    if size < len(levels):
        for side, own in (("n_right", names), ("n_left", [f"k{i}" for i in range(2, size + 2)])):
            longer = levels[size].groupBy(*(F.col(c).alias(f"k{i + 1}") for i, c in enumerate(own))).agg(
                F.max("f").alias(f"{side}_f"), F.count(F.lit(1)).alias(side))
            out = out.join(longer, names, "left")
        held = F.greatest(F.coalesce("n_left_f", F.lit(0)), F.coalesce("n_right_f", F.lit(0)))
        out = out.where(held * 100 < F.col("a") * inside)
    else:
        out = out.withColumns({"n_left": F.lit(None).cast("long"), "n_right": F.lit(None).cast("long")})
    exact = "decimal(38,0)"
    square = F.col("a").cast(exact) * F.col("a").cast(exact) * F.lit(1_000_000).cast(exact)
    cuts = F.array(*(F.struct(
        F.call_function("div", square, F.col(f"first{k}").cast(exact) * F.col(f"last{size - k}").cast(exact)).alias("score"),
        F.lit(k).alias("cut"), F.col(f"first{k}").alias("l"), F.col(f"last{size - k}").alias("r"))
        for k in range(1, size)))
    out = out.withColumn("best", F.array_min(cuts))
    return out.select(
        "lang", F.concat_ws(" ", *(f"w{i}" for i in range(size))).alias("phrase"), "a", "best.l", "best.r",
        F.col("best.cut").cast("long").alias("cut"), "best.score",
        F.coalesce("n_left", F.lit(0)).cast("long").alias("n_left"), F.coalesce("n_right", F.lit(0)).cast("long").alias("n_right"))
