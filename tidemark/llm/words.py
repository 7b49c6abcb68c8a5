"""Words of whole texts as NumPy arrays: boundaries, hashes and n-gram hashes of one bounded block of documents."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import give_back

#: Bytes of text that one block holds; a longer document is a block of its own.
BLOCK_BYTES = 1 << 21
#: Rows that Spark hands to Python at once, so that a batch of long documents stays small.
BATCH_ROWS = 256

_U = np.uint64
_MASKS = np.array([(1 << (8 * n)) - 1 for n in range(8)] + [(1 << 64) - 1], dtype=_U)


def byte_table(separators: str, lower: bool) -> np.ndarray:
    """256 bytes: what each byte of a text counts as; 0 ends a word. Bytes above 0x7F always belong to words."""
    table = np.arange(256, dtype=np.uint8)
    if lower:
        table[65:91] += 32
    for b in separators.encode("ascii"):
        table[b] = 0
    return table


#: Words between ASCII white space.
WHITE = " \t\n\x0b\x0c\r"
SPACED = byte_table(WHITE, lower=False)
SPACED_LOWER = byte_table(WHITE, lower=True)
#: Words of letters, digits and anything beyond ASCII, A-Z lower-cased.
ALNUM_LOWER = byte_table("".join(chr(b) for b in range(128) if not chr(b).isalnum()), lower=True)
# NUL is its own value in the tables of spaced words; any unused value of UTF-8 keeps it a word byte.
SPACED[0] = SPACED_LOWER[0] = 0xFF


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values (multiply and shift)."""
    x = x ^ (x >> _U(30))
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def _joined(left: np.ndarray, left_words: int, right: np.ndarray, right_words: int, seed: int) -> np.ndarray:
    n = len(left) + left_words - 1 - (left_words + right_words) + 1
    if n <= 0:
        return np.zeros(0, _U)
    a = left[:n] * _U(0x9E3779B97F4A7C15) + _U(seed)
    return mix(a ^ (right[left_words:left_words + n] * _U(0xD6E8FEB86659FD93) + _U(left_words)))


def ngrams(h: np.ndarray, n: int, seed: int = 0) -> np.ndarray:
    """Hash of the n values that start at each place: len(h) - n + 1 of them. Built by doubling, so it costs log n."""
    out, words, power, size = None, 0, h if not seed else mix(h ^ _U(seed * 0x9E3779B97F4A7C15 & (1 << 64) - 1)), 1
    while True:
        if n & size:
            out, words = (power, size) if out is None else (_joined(out, words, power, size, seed), words + size)
        if words == n:
            return out
        power, size = _joined(power, size, power, size, seed), size * 2


@dataclass
class Words:
    """The words of a block of documents, in order of documents and places."""

    data: np.ndarray  # bytes of the block as the table maps them, 8 zero bytes after the end
    raw: np.ndarray  # the same bytes unmapped
    starts: np.ndarray
    ends: np.ndarray
    doc: np.ndarray  # index of the document of each word
    first: np.ndarray  # index of the first word of each document, one more at the end

    def __len__(self) -> int:
        return len(self.starts)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @cached_property
    def place(self) -> np.ndarray:
        """Place of each word in its document."""
        return np.arange(len(self.starts)) - self.first[self.doc]

    @cached_property
    def hashes(self) -> np.ndarray:
        """64-bit hash of each word's bytes and length."""
        n = len(self.data) - 7
        eight = np.ndarray((n,), "<u8", self.data.tobytes(), 0, (1,))
        length = self.ends - self.starts
        h = mix((eight[self.starts] & _MASKS[np.minimum(length, 8)]) ^ (length.astype(_U) << _U(56)))
        at, more = 8, np.flatnonzero(length > 8)
        while len(more):
            rest = length[more] - at
            part = eight[self.starts[more] + at] & _MASKS[np.minimum(rest, 8)]
            h[more] = mix(h[more] * _U(0x9E3779B97F4A7C15) ^ part)
            at, more = at + 8, more[rest > 8]
        return h

    def within(self, n: int) -> np.ndarray:
        """For each place an n-gram may start at: does it lie in one document."""
        m = len(self) - n + 1
        return self.doc[:m] == self.doc[n - 1:] if m > 0 else np.zeros(0, bool)

    def word(self, i: int) -> bytes:
        return self.data[self.starts[i]:self.ends[i]].tobytes()

    def text(self, d: int, keep: np.ndarray | None = None) -> bytes:
        """Words of document d (only the kept ones), unmapped, joined by one space."""
        a, b = int(self.first[d]), int(self.first[d + 1])
        if a == b:
            return b""
        words = self.raw[self.starts[a]:self.ends[b - 1]].tobytes().translate(None).split()
        return b" ".join(words) if keep is None else b" ".join(w for w, k in zip(words, keep[a:b].tolist()) if k)


def find_words(texts: pa.Array, table: np.ndarray) -> Words:
    """Words of each text; a null text has none."""
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    body = texts.buffers()[2]
    raw = np.frombuffer(body, np.uint8)[offsets[0]:offsets[-1]] if body is not None else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0]
    data = np.zeros(len(raw) + 8, np.uint8)
    np.take(table, raw, out=data[:len(raw)])
    inside = data[:len(raw)] != 0
    before, after = np.zeros(len(raw), bool), np.zeros(len(raw), bool)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    if len(raw):
        before[offsets[:-1][offsets[:-1] < len(raw)]] = False
        after[offsets[1:][offsets[1:] > 0] - 1] = False
    starts, ends = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    first = np.searchsorted(starts, offsets)
    doc = np.repeat(np.arange(len(texts)), np.diff(first))
    return Words(data, raw, starts, ends, doc, first)


def blocks(batches: Iterator[pa.RecordBatch], text: str, limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that a block's texts have at most ``limit`` bytes; a longer text is alone in its block."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.binary_length(batch.column(text)).fill_null(0).to_numpy(zero_copy_only=False)
        start, held = 0, 0
        for i, size in enumerate(sizes.tolist()):
            if held and held + size > limit:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size
        yield batch.slice(start)


def gathered(batches: Iterator[pa.RecordBatch], text: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Put small batches together to blocks of up to ``limit`` bytes of text."""
    held, size = [], 0
    for block in blocks(batches, text, limit):
        own = pc.sum(pc.binary_length(block.column(text))).as_py() or 0
        if held and size + own > limit:
            yield pa.concat_batches(held)
            held, size = [], 0
        held.append(block)
        size += own
    if held:
        yield pa.concat_batches(held)


def map_blocks(df: DataFrame, work: Callable[[pa.RecordBatch], dict | None], schema: str, text: str = "text",
               limit: int = BLOCK_BYTES) -> DataFrame:
    """``work`` on every bounded block of ``df``; it returns columns by name, in the order of ``schema``."""
    small_batches(df.sparkSession)
    arrow = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, text, limit):
            out = work(block)
            if out is not None:
                yield pa.RecordBatch.from_arrays(
                    [v if isinstance(v, pa.Array) else pa.array(v, t.type) for v, t in zip(out.values(), arrow)],
                    schema=arrow)
        block = out = None
        give_back()

    return df.mapInArrow(run, schema)


def arrow_schema(schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    return to_arrow_schema(_parse_datatype_string(schema))


def small_batches(spark: SparkSession) -> None:
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) != BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


class Carried:
    """Further columns that go through an operator untouched, under names that cannot clash inside."""

    def __init__(self, df: DataFrame, columns: tuple[str, ...] | list[str]):
        self.names = list(columns)
        self.inside = [f"carried_{i}" for i in range(len(self.names))]
        self.ddl = "".join(f", {n} {df.schema[c].dataType.simpleString()}" for n, c in zip(self.inside, self.names))

    def columns(self) -> list[Column]:
        return [F.col(f"`{c}`").alias(n) for c, n in zip(self.names, self.inside)]

    def of(self, block: pa.RecordBatch) -> dict:
        return {n: block.column(n) for n in self.inside}

    def renamed(self, df: DataFrame) -> DataFrame:
        return df.withColumnsRenamed(dict(zip(self.inside, self.names)))


def documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", carried: Carried | None = None) -> DataFrame:
    """Id and text under the names the operators use; other columns never clash, as only carried ones come along."""
    return df.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"),
                     *(carried.columns() if carried else []))
