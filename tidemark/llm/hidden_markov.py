"""A hidden Markov language model over words.

Latent states emit words; the end of a text is a word of its own, so that texts of any length share one distribution.
The most frequent words are symbols of the chain that every worker holds. Other words are symbols whose emissions are a
table: an emission is that of a group of words (by hash), times the word's share of the group by its exact count, times
a factor for each state, learned from the word's own expected counts. A word never seen has the factor 1. Texts are dealt
to blocks and rare words to buckets; a block sends each bucket the words it has, packed, and gets back what is known of
them over the whole corpus, so that tables grow with the words of the corpus and no row is made for a word.

Training is Baum-Welch: every pass runs the scaled forward and backward recursions over all training texts, whole, in
parallel over partitions; each task sums expected counts per word and transition, Spark adds these up over tasks, and
the driver holds only the parameters of fixed size (states x symbols). States start from a few texts that differ most
among a fixed number of candidates; this start is the only thing taken from a sample. Scoring is the forward recursion
over the whole text, exact up to rounding.

Counts of all words are a table. Those of symbols are broadcast (a fixed bound); the rest come by way of the buckets.

Defined results: a null text counts as empty and is its end alone; a null id is not held out; rows with equal ids are
scored each by its own text; other columns are ignored. Words are told apart by 64-bit hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import new_path, stored
from .words import SPACED_LOWER, blocks, documents, find_words, gathered, small_batches

STATES = 8
PASSES = 3
#: Words whose emissions every worker holds, and groups of all others.
SYMBOLS = 1 << 17
SHARED = 1 << 10
#: Words whose counts every worker holds.
KNOWN = 1 << 18
#: Texts that the states may start from.
CANDIDATES = 64
ADD = 0.1
#: Bytes of text whose words are counted together, and of those that are stepped together.
_COUNTED = 8 << 20
_TOGETHER = 2 << 20
#: Bytes of text in a block, whose rare words and sums travel together; a longer text is more.
_BLOCK_BYTES = 12 << 20
#: Rare words of a bucket, and symbols in a row of sums.
_BUCKET_WORDS = 1 << 14
_CHUNK = 512
#: Places of the table that finds a known word by the low bits of its hash.
_FOUND_BY = 1 << 20

END = np.uint64(0x9E3779B97F4A7C15)

#: Words of a bucket that a block has, their counts (64 bits) and the shares of the states in these; or sums in ``shares``.
PACKED = "bucket int, block int, words binary, n binary, shares binary"
_PACKED = pa.schema([("bucket", pa.int32()), ("block", pa.int32()), ("words", pa.binary()), ("n", pa.binary()),
                     ("shares", pa.binary())])


def held_out(id_col: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(id_col.cast("string")), F.lit(10)) == 0, F.lit(False))


def sequences(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts, each with its end, and where each begins (and the last ends)."""
    words = find_words(texts, SPACED_LOWER)
    h = np.insert(words.hashes, words.first[1:], END)
    return h, words.first + np.arange(len(words.first))


def _gathered_map(df: DataFrame, work, schema: str) -> DataFrame:
    small_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in gathered(batches, "text", _COUNTED):
            yield pa.RecordBatch.from_pydict(work(block))

    return df.mapInArrow(run, schema)


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n) over all texts."""
    def work(block: pa.RecordBatch) -> dict:
        h, n = np.unique(sequences(block.column("text"))[0], return_counts=True)
        return {"word": h.view(np.int64), "n": n}

    return _gathered_map(docs, work, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))


@dataclass
class Lexicon:
    """Counts of the most frequent words, their symbols, and sums over the symbols that the others share."""

    words: np.ndarray  # hashes by their low bits
    counts: np.ndarray
    symbols: np.ndarray  # symbol of each known word
    n_symbols: int
    shared_count: np.ndarray
    shared_words: np.ndarray
    tokens: int
    distinct: int

    def __post_init__(self):
        low = (self.words & np.uint64(_FOUND_BY - 1)).astype(np.int64)
        self.first = np.searchsorted(low, np.arange(_FOUND_BY + 1)).astype(np.int32)

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbol of each word, and its place among the known words or -1."""
        low = (h & np.uint64(_FOUND_BY - 1)).astype(np.int64)
        at, end = self.first[low], self.first[low + 1]
        found = np.full(len(h), -1, np.int32)
        open_ = np.flatnonzero(at < end)
        while len(open_):  # few words share a place
            same = self.words[at[open_]] == h[open_]
            found[open_[same]] = at[open_[same]]
            open_ = open_[~same]
            at[open_] += 1
            open_ = open_[at[open_] < end[open_]]
        symbol = (self.n_symbols + shared_symbol(h)).astype(np.int32)
        known = found >= 0
        symbol[known] = self.symbols[found[known]]
        return symbol, found

    def share(self, symbol: np.ndarray, count: np.ndarray) -> np.ndarray:
        """log10 of a word's share of its symbol: 0 where it has its own."""
        s = np.maximum(symbol - self.n_symbols, 0)
        return np.where(symbol < self.n_symbols, 0.0, np.log10(
            (count + ADD) / (self.shared_count[s] + ADD * (self.shared_words[s] + 1))))

    def base(self, count: np.ndarray) -> np.ndarray:
        return np.log10((count + ADD) / (self.tokens + ADD * (self.distinct + 1)))

    def unigram(self) -> np.ndarray:
        """Smoothed share of each symbol in the training tokens."""
        own = np.zeros(self.n_symbols + SHARED)
        np.add.at(own, self.symbols, self.counts)
        own[self.n_symbols:] = self.shared_count
        return (own + ADD) / (own + ADD).sum()


def shared_symbol(h: np.ndarray) -> np.ndarray:
    return (h & np.uint64(SHARED - 1)).astype(np.int64)


def build_lexicon(counts: DataFrame) -> Lexicon:
    total = counts.agg(F.sum("n"), F.count(F.lit(1))).first()
    first = F.col("word") == int(END.view(np.int64))  # the end always has a symbol
    top = counts.orderBy(F.when(first, 0).otherwise(1), F.desc("n"), "word").limit(KNOWN).toArrow()
    words, n = top["word"].to_numpy().view(np.uint64), top["n"].to_numpy()
    symbols = np.where(np.arange(len(words)) < SYMBOLS, np.arange(len(words)), SYMBOLS + shared_symbol(words))
    shared_count, shared_words = np.zeros(SHARED), np.zeros(SHARED)
    if len(words) > SYMBOLS:
        last_n, last_word = int(n[SYMBOLS - 1]), int(words[SYMBOLS - 1].view(np.int64))
        rest = counts.where(~first & ((F.col("n") < last_n) | ((F.col("n") == last_n) & (F.col("word") > last_word))))
        for row in rest.groupBy(F.col("word").bitwiseAND(SHARED - 1).alias("s")).agg(
                F.sum("n").alias("n"), F.count(F.lit(1)).alias("k")).collect():  # at most SHARED rows
            shared_count[row["s"]], shared_words[row["s"]] = row["n"], row["k"]
    order = np.argsort(words & np.uint64(_FOUND_BY - 1), kind="stable")
    own = words[order], n[order], symbols[order]
    return Lexicon(*own, SYMBOLS, shared_count, shared_words, int(total[0] or 0), int(total[1]))


def _bits(lexicon: Lexicon) -> int:
    """Words are dealt to 2 ** bits buckets by the first bits of their hashes, about ``_BUCKET_WORDS`` to each."""
    return min(20, max(4, math.ceil(math.log2(max(1, lexicon.distinct) / _BUCKET_WORDS))))


def _blocked(docs: DataFrame, *columns: str) -> DataFrame:
    """``columns`` with the block of each text: blocks are the same in every pass, as rows are dealt by what they hold."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    block = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 + size // _BLOCK_BYTES)).cast("int")
    return docs.select(block.alias("block"), *columns)


def _packed(rows: list[tuple]) -> pa.Table:
    return pa.table(list(zip(*rows)) or [[]] * len(_PACKED), schema=_PACKED)


def _array(column: pa.ChunkedArray, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind)


def _with_facts(texts: DataFrame, facts: DataFrame | None, work, schema: str) -> DataFrame:
    """``work`` on each block's texts and what is known of its rare words."""
    if facts is None:
        return texts.groupBy("block").applyInArrow(lambda block: work(block, None), schema)
    return texts.groupBy("block").cogroup(facts.groupBy("block")).applyInArrow(work, schema)


#: Shares travel as 16 bits: 512 steps to each halving, as far down as single precision goes; the last stands for 0.
_SHARE = np.append(np.exp2(np.arange(65535) / -512), 0).astype(np.float32)


def _short(shares: np.ndarray) -> np.ndarray:
    steps = np.rint(-512 * np.log2(np.maximum(shares, 1e-300)))
    return np.where(shares > 0, np.clip(steps, 0, 65534), 65535).astype("<u2")


def _shares(column, states: int, kind: str = "<u2") -> np.ndarray:
    own = _array(column, kind).reshape(-1, states)
    return _SHARE[own] if kind == "<u2" else own


class _Block:
    """Sequences of a block's texts in parts that are stepped together, and its distinct rare words."""

    def __init__(self, texts: pa.Table, lexicon: Lexicon):
        self.number = texts["block"][0].as_py()
        # Texts of like length are stepped together, so that few steps serve many.
        texts = texts.take(np.argsort(pc.binary_length(texts["text"]).fill_null(0).to_numpy(), kind="stable"))
        self.batches = list(blocks(texts.combine_chunks().to_batches(), "text", _TOGETHER))
        found = [sequences(batch.column("text")) for batch in self.batches]
        self.parts = [(first, *lexicon.find(h)) for h, first in found]
        self.rare = [symbols >= lexicon.n_symbols for _, symbols, _ in self.parts]
        rare = [h[own] for (h, _), own in zip(found, self.rare)]
        self.names = np.unique(np.concatenate(rare))  # by hash, and so by bucket
        self.place = [np.searchsorted(self.names, h) for h in rare]

    def buckets(self, bits: int) -> Iterator[tuple[int, int, int]]:
        """Each bucket that the block has words of, and where they begin and end."""
        own, first = np.unique((self.names >> np.uint64(64 - bits)).astype(np.int64), return_index=True)
        return zip(own.tolist(), first.tolist(), [*first[1:].tolist(), len(self.names)])

    def facts(self, facts: pa.Table, states: int) -> tuple[np.ndarray, np.ndarray]:
        """Count of each rare word, and the shares of the states in it, as the buckets sent them."""
        facts = facts.sort_by("bucket")
        n = _array(facts["n"], "<i8")
        if len(n) != len(self.names):
            raise RuntimeError("texts changed between two passes")
        return n, _shares(facts["shares"], states)

    def rows(self, i: int) -> np.ndarray:
        """Row of each word of part i in a table of factors that begins with a row of ones."""
        rows = np.zeros(len(self.rare[i]), np.int32)
        rows[self.rare[i]] = self.place[i] + 1
        return rows


class Chain:
    """Parameters: start (states), move (states x states), emit (symbols x states), ratio (groups x states: tokens of a
    group over its expected count); and the table of factors (word, n, factor), with what it is read from (``packed``),
    which stay on the driver's side."""

    def __init__(self, start: np.ndarray, move: np.ndarray, emit: np.ndarray, ratio: np.ndarray | None = None,
                 factors: DataFrame | None = None, packed: DataFrame | None = None):
        self.start, self.move, self.emit = (x.astype(np.float32) for x in (start, move, emit))
        self.ratio, self.factors, self.packed = ratio, factors, packed

    def __getstate__(self):
        return {**self.__dict__, "factors": None, "packed": None}

    def factor(self, words: np.ndarray, n: np.ndarray, shares: np.ndarray) -> np.ndarray:
        """Factors of rare words after a row of ones, from their counts and the shares of the states in these.

        Within a group and a state a word's share is (c / C * n + ADD) / (n + ADD * (words + 1)), with c and C the expected
        counts of word and group and n the group's tokens; the factor is that over its share in all states. The shares of a
        group's words and of one never seen add up to 1.
        """
        ratio = self.ratio[(words & np.uint64(len(self.ratio) - 1)).astype(np.int64)]
        own = (n[:, None] * shares * ratio + ADD) / (n[:, None] + ADD)
        return np.concatenate([np.ones((1, own.shape[1])), own]).astype(np.float32)

    def _emitted(self, symbols: np.ndarray, own) -> np.ndarray:
        """States x words."""
        out = np.empty((len(self.start), len(symbols)), np.float32)
        for s, row in enumerate(np.ascontiguousarray(self.emit.T)):
            np.take(row, symbols, out=out[s])
        if own is not None:
            rare = np.flatnonzero(own[1])
            out[:, rare] *= own[0][own[1][rare]].T
        return out

    def _ahead(self, emitted: np.ndarray, out: np.ndarray, active: list[int], begin: list[int]) -> np.ndarray:
        """Scaled states after each word into ``out``, which may be ``emitted`` itself; and the scales."""
        scales, move = np.empty(emitted.shape[1], np.float32), np.ascontiguousarray(self.move.T)
        for t, n in enumerate(active):
            a = begin[t]
            now = move @ out[:, begin[t - 1]:begin[t - 1] + n] if t else np.repeat(self.start[:, None], n, axis=1)
            now *= emitted[:, a:a + n]
            scale = now.sum(axis=0, out=scales[a:a + n])
            np.divide(now, scale, out=out[:, a:a + n])
        return scales

    def forward(self, symbols: np.ndarray, first: np.ndarray, own=None) -> np.ndarray:
        """Natural log likelihood of each text."""
        order, active, begin, at = _by_place(first)
        emitted = self._emitted(symbols[at], None if own is None else (own[0], own[1][at]))
        return _likes(self._ahead(emitted, emitted, active, begin), order, active)

    def counted(self, symbols: np.ndarray, first: np.ndarray, own=None):
        """Expected counts: start, move, states x words; log likelihoods, and which word each of these is."""
        order, active, begin, at = _by_place(first)
        emitted = self._emitted(symbols[at], None if own is None else (own[0], own[1][at]))
        states = np.empty_like(emitted)
        scales = self._ahead(emitted, states, active, begin)
        emitted /= scales
        move, beta = np.zeros(self.move.shape), np.ones((len(self.start), len(order)), np.float32)
        for t in range(len(active) - 2, -1, -1):
            n, a, after = active[t + 1], begin[t], begin[t + 1]
            seen = emitted[:, after:after + n]
            seen *= beta[:, :n]
            here = states[:, a:a + n]
            move += here @ seen.T
            here *= np.matmul(self.move, seen, out=beta[:, :n])
        states /= states.sum(axis=0)
        return states[:, :len(order)].sum(axis=1), move * self.move, states, _likes(scales, order, active), at

    def expected(self, symbols: np.ndarray, first: np.ndarray, own=None):
        """Expected counts: start, move, per-word states; and the log likelihood."""
        start, move, states, like, at = self.counted(symbols, first, own)
        posterior = np.empty(states.shape[::-1], np.float32)
        posterior[at] = states.T
        return start, move, posterior, like


def _by_place(first: np.ndarray) -> tuple[np.ndarray, list[int], list[int], np.ndarray]:
    """Texts by falling length, how many of them have a word at each place, where those words begin when all are put in
    order of places, and which words they are."""
    sizes = np.diff(first)
    order = np.argsort(-sizes, kind="stable")
    active = np.searchsorted(-sizes[order], -np.arange(sizes.max(initial=0)), side="left")
    begin = np.cumsum(active) - active
    place = np.repeat(np.arange(len(active)), active)
    at = first[:-1][order][np.arange(len(place)) - begin[place]] + place
    return order, active.tolist(), begin.tolist(), at


def _likes(scales: np.ndarray, order: np.ndarray, active: list[int]) -> np.ndarray:
    logs, like, a = np.log(scales), np.zeros(len(order)), 0
    for n in active:
        like[:n] += logs[a:a + n]
        a += n
    out = np.empty_like(like)
    out[order] = like
    return out


def _expected(shared, chain_shared, states: int, bits: int):
    """Rows of expected counts of a block: of rare words, bucket by bucket; of symbols, in chunks numbered from -2
    downward; of start and moves, with the likelihood, in bucket -1."""
    def work(texts: pa.Table, facts: pa.Table | None) -> pa.Table:
        lexicon, chain = shared.value, chain_shared.value
        if not texts.num_rows:
            return _packed([])
        block, factor = _Block(texts, lexicon), None
        if facts is not None:
            factor = chain.factor(block.names, *block.facts(facts, states))
        emit, sums = np.zeros((states, len(chain.emit))), np.zeros((states, len(block.names)))
        n = np.zeros(len(block.names), np.int64)
        start, move, like = np.zeros(states), np.zeros((states, states)), 0.0
        for i, (first, symbols, _) in enumerate(block.parts):
            rows = block.rows(i)
            one, two, posterior, own, at = chain.counted(symbols, first, None if factor is None else (factor, rows))
            start, move, like = start + one, move + two, like + own.sum()
            symbols, rows = symbols[at], rows[at]
            rare = np.flatnonzero(rows)
            place = rows[rare] - 1
            n += np.bincount(place, minlength=len(n))
            for s in range(states):
                emit[s] += np.bincount(symbols, weights=posterior[s], minlength=emit.shape[1])
                sums[s] += np.bincount(place, weights=posterior[s, rare], minlength=len(n))
        emit, shares = emit.T, _short((sums / sums.sum(axis=0)).T)
        rows = [(bucket, block.number, block.names[a:b].tobytes(), n[a:b].tobytes(), shares[a:b].tobytes())
                for bucket, a, b in block.buckets(bits)]
        small = np.concatenate([[like], start, move.ravel()])
        rows.append((-1, block.number, b"", b"", small.tobytes()))
        for i, a in enumerate(range(0, len(emit), _CHUNK)):
            rows.append((-2 - i, block.number, b"", b"", emit[a:a + _CHUNK].astype("<f4").tobytes()))
        return _packed(rows)

    return work


def _summed(states: int, last: bool):
    """Sums of a bucket over all blocks. Rare words go back to the blocks that have them, or after the ``last`` pass are
    listed once."""
    def work(rows: pa.Table) -> pa.Table:
        bucket = rows["bucket"][0].as_py()
        if bucket < 0:
            total = sum(np.frombuffer(x, "<f8" if bucket == -1 else "<f4").astype("<f8") for x in rows["shares"].to_pylist())
            return _packed([(bucket, -1, b"", b"", total.tobytes())])
        words, at = np.unique(_array(rows["words"], "<u8"), return_inverse=True)
        own = _array(rows["n"], "<i8")
        n = np.bincount(at, weights=own).astype("<i8")
        shares = own[:, None] * _shares(rows["shares"], states)
        shares = np.stack([np.bincount(at, weights=shares[:, s]) for s in range(states)], axis=1) / n[:, None]
        if last:
            return _packed([(bucket, -1, words.tobytes(), n.tobytes(), shares.astype("<f4").tobytes())])
        shares = _short(shares)
        ends = np.cumsum([len(x) // 8 for x in rows["words"].to_pylist()]).tolist()
        return _packed([(bucket, block, b"", n[at[a:b]].tobytes(), shares[at[a:b]].tobytes())
                        for block, a, b in zip(rows["block"].to_pylist(), [0, *ends], ends)])

    return work


def _factors(packed: DataFrame, chain: Chain, states: int) -> DataFrame:
    """(word, n, factor) of all rare words."""
    shared = packed.sparkSession.sparkContext.broadcast(chain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, n = _array(batch.column("words"), "<u8"), _array(batch.column("n"), "<i8")
            factor = shared.value.factor(words, n, _shares(batch.column("shares"), states, "<f4"))[1:]
            yield pa.RecordBatch.from_arrays([
                pa.array(words.view(np.int64)), pa.array(n),
                pa.ListArray.from_arrays(np.arange(len(n) + 1, dtype=np.int32) * states, factor.ravel())],
                ["word", "n", "factor"])

    return packed.mapInArrow(run, "word long, n long, factor array<float>")


def _started(docs: DataFrame, lexicon: Lexicon, states: int) -> Chain:
    """States that lean to texts which differ most from each other."""
    picked = docs.where(F.length("text") >= 200).orderBy(F.xxhash64("text")).limit(CANDIDATES).toArrow()
    unigram, m = lexicon.unigram(), lexicon.n_symbols + SHARED
    rng = np.random.default_rng(17)
    leans = [rng.dirichlet(np.ones(m)) for _ in range(states)]
    if picked.num_rows:
        h, first = sequences(picked["text"].combine_chunks())
        symbols = lexicon.find(h)[0]
        rows = np.stack([np.bincount(symbols[a:b], minlength=m) / (b - a) for a, b in zip(first[:-1], first[1:])])
        unit = np.sqrt(rows)  # then products are affinities of distributions
        chosen = [int(np.argmax(np.diff(first)))]
        while len(chosen) < min(states, len(rows)):
            chosen.append(int(np.argmin((unit @ unit[chosen].T).max(axis=1))))
        for s, i in enumerate(chosen):
            leans[s] = rows[i]
    emit = np.stack([0.6 * unigram + 0.4 * lean for lean in leans], axis=1)
    move = np.full((states, states), 0.1 / max(1, states - 1))
    np.fill_diagonal(move, 0.9)
    return Chain(np.full(states, 1 / states), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))


def train(docs: DataFrame, lexicon: Lexicon, states: int = STATES, passes: int = PASSES) -> tuple[Chain, list[float]]:
    """Baum-Welch over all of ``docs``; also the log likelihood before each pass."""
    sc = docs.sparkSession.sparkContext
    small_batches(docs.sparkSession)
    shared, chain, likes, bits = sc.broadcast(lexicon), _started(docs, lexicon, states), [], _bits(lexicon)
    texts, facts, has_rare = _blocked(docs, "text"), None, bool(lexicon.shared_words.any())
    # A pass reads what the one before wrote, and writes over the one before that.
    paths = [new_path(docs.sparkSession), new_path(docs.sparkSession)]
    for i in range(passes):
        rows = _with_facts(texts, facts, _expected(shared, sc.broadcast(chain), states, bits), PACKED)
        table = stored(rows.groupBy("bucket").applyInArrow(_summed(states, i == passes - 1), PACKED), path=paths[i % 2])
        found = dict(table.where("bucket < 0").select("bucket", "shares").toLocalIterator())  # a fixed number of rows
        if not found:
            break
        small = np.frombuffer(found.pop(-1), "<f8")
        likes.append(float(small[0]))
        counts = np.concatenate([np.frombuffer(found[k], "<f8") for k in sorted(found, reverse=True)]).reshape(-1, states)
        emit = lexicon.unigram()[:, None] + counts  # one token's worth of the overall shares
        start, move = small[1:1 + states] + ADD, small[1 + states:].reshape(states, states) + ADD
        group = counts[lexicon.n_symbols:]
        ratio = np.divide(lexicon.shared_count[:, None], group, out=np.zeros_like(group), where=group > 0)
        facts = table.where("bucket >= 0") if has_rare else None
        chain = Chain(start / start.sum(), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=0), ratio)
        if has_rare and i == passes - 1:
            chain.factors, chain.packed = _factors(facts, chain, states), facts
    return chain, likes


SCORED = "doc_id long, n_tokens long, n_known long, base_score double, score double"
_SCORED = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
                     ("base_score", pa.float64()), ("score", pa.float64())])


def _listed(shared, bits: int):
    """Rare words of a block, bucket by bucket."""
    def work(texts: pa.Table) -> pa.Table:
        block = _Block(texts, shared.value)
        return _packed([(bucket, block.number, block.names[a:b].tobytes(), b"", b"") for bucket, a, b in block.buckets(bits)])

    return work


def _counted(rows: pa.Table) -> pa.Table:
    """A bucket's words with their counts alone."""
    words, order = np.unique(rows["word"].to_numpy().view(np.uint64), return_index=True)
    return _packed([(rows["bucket"][0].as_py(), -1, words.tobytes(), rows["n"].to_numpy()[order].tobytes(), b"")])


def _told(states: int):
    """Counts and shares of a bucket's words for the blocks that have them; 0 for a word never seen."""
    def work(lists: pa.Table, table: pa.Table) -> pa.Table:
        words = np.append(_array(table["words"], "<u8"), np.uint64(0))
        n = np.append(_array(table["n"], "<i8"), 0)
        shares = np.full((len(words), states), 65535, "<u2")
        own = _shares(table["shares"], states, "<f4")
        if len(own):
            shares[:-1] = _short(own)
        rows = []
        for block, body in zip(lists["block"].to_pylist(), lists["words"].to_pylist()):
            wanted = np.frombuffer(body, "<u8")
            at = np.searchsorted(words[:-1], wanted)
            at[words[at] != wanted] = len(words) - 1
            rows.append((lists["bucket"][0].as_py(), block, b"", n[at].tobytes(), shares[at].tobytes()))
        return _packed(rows)

    return work


def _scores(shared, chain_shared, with_factors: bool):
    def work(texts: pa.Table, facts: pa.Table | None) -> pa.Table:
        lexicon, chain = shared.value, chain_shared.value
        if not texts.num_rows:
            return _SCORED.empty_table()
        block, factor = _Block(texts, lexicon), None
        count = np.zeros(len(block.names), np.int64)
        if facts is not None:
            count, shares = block.facts(facts, len(chain.start))
            factor = chain.factor(block.names, count, shares) if with_factors else None
        base, rare_base = lexicon.base(lexicon.counts), lexicon.base(count)
        share = lexicon.share(lexicon.n_symbols + shared_symbol(block.names), count)
        out = []
        for i, (batch, (first, symbols, at)) in enumerate(zip(block.batches, block.parts)):
            rare, place = block.rare[i], block.place[i]
            owner = np.repeat(np.arange(batch.num_rows), np.diff(first))

            def added(common: np.ndarray, own: np.ndarray) -> np.ndarray:
                return (np.bincount(owner[~rare], weights=common, minlength=batch.num_rows)
                        + np.bincount(owner[rare], weights=own, minlength=batch.num_rows))

            none = np.zeros(int((~rare).sum()))
            score = chain.forward(symbols, first, None if factor is None else (factor, block.rows(i))) / math.log(10) + added(none, share[place])
            out.append(pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array(np.diff(first)),
                pa.array(added(none + 1, count[place] > 0).astype(np.int64)), pa.array(added(base[at[~rare]], rare_base[place])),
                pa.array(score)], schema=_SCORED))
        return pa.Table.from_batches(out)

    return work


def score(df: DataFrame, lexicon: Lexicon, chain: Chain, counts: DataFrame, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """One row per row of ``df``: doc_id, n_tokens, n_known, base_score, score (log10)."""
    docs, sc = documents(df, id_col, text_col), df.sparkSession.sparkContext
    small_batches(df.sparkSession)
    shared, chain_shared, bits = sc.broadcast(lexicon), sc.broadcast(chain), _bits(lexicon)
    with_factors = chain.factors is not None
    texts, work = _blocked(docs, "doc_id", "text"), _scores(shared, chain_shared, with_factors)
    if not lexicon.shared_words.any():  # every word that has a count has its own symbol
        return _with_facts(texts, None, work, SCORED)
    if with_factors:
        table = chain.packed
    else:
        bucket = F.shiftrightunsigned("word", 64 - bits).cast("int")
        table = counts.select(bucket.alias("bucket"), "word", "n").groupBy("bucket").applyInArrow(_counted, PACKED)
    lists = texts.groupBy("block").applyInArrow(_listed(shared, bits), PACKED)
    facts = stored(lists.groupBy("bucket").cogroup(table.groupBy("bucket")).applyInArrow(_told(len(chain.start)), PACKED))
    return _with_facts(texts, facts, work, SCORED)


def fit(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", states: int = STATES, passes: int = PASSES):
    """Lexicon, chain, word counts and log likelihoods of the passes, from all rows of ``df``."""
    docs = documents(df, id_col, text_col)
    counts = stored(word_counts(docs))
    lexicon = build_lexicon(counts)
    return lexicon, *train(docs, lexicon, states, passes), counts


def score_held_out(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Learn from the rows that are not held out, score all."""
    lexicon, chain, _, counts = fit(df.where(~held_out(F.col(f"`{id_col}`"))), id_col, text_col)
    return score(df, lexicon, chain, counts, id_col, text_col).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "n_tokens", "n_known",
        F.lit(lexicon.tokens).cast("long").alias("train_tokens"), "base_score", "score")
