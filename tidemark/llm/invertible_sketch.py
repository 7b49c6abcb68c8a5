"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests.

A text is cut into paragraphs: lines, and within a line at the end of every sentence. The distinct 64-bit digests of
the paragraphs go into a sketch: each digest adds 1, itself and a check to one cell in each of three parts. Sketches of two versions are
subtracted cell by cell, which cancels what they share; cells left with a single digest are peeled, which frees others,
until the sketch is empty: then the peeled digests are the paragraphs that differ. A sketch that does not empty was too
small for the difference, and the versions are sketched again at twice the size; after ``RETRIES`` sizes (the last of
which holds many times any difference of two texts) array_except lists the differing digests instead.

Likeness of two versions is the share of paragraphs they have in common, from the recovered difference alone.

Everything is Spark SQL on one row per document: arrays are sorted and folded within the row, nothing is exploded.
Versions meet by one shuffle on blocks of ids; only the first document of each block takes part in a second, small one.

Defined results: a null text counts as empty; two texts without paragraphs are alike (1.0); rows with equal ids follow
each other in the order of their texts, a null id comes first; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Cells of the sketch that is written out as the fingerprint.
FINGER_CELLS = 12
#: Sizes tried, each twice the one before; the first holds the difference that is expected.
RETRIES = 5
#: Peeling rounds; a sketch that empties does so in a few.
ROUNDS = 40
#: Ids of a block.
BLOCK = 512

_PARTS = 3
_ENDS = r"\n+|(?<=[.!?])\s+"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value worked out once."""
    return F.transform(F.array(value), use)[0]


def paragraphs(text: Column) -> Column:
    """Distinct digests of a text's paragraphs."""
    pieces = F.filter(F.split(text, _ENDS), lambda p: F.trim(p) != "")
    return F.array_distinct(F.transform(pieces, lambda p: F.xxhash64(p)))


def _check(digest: Column) -> Column:
    return F.xxhash64(digest, F.lit(7))


def _entries(digest: Column, sign: Column, part_cells: Column) -> list[Column]:
    """What a digest adds to its cells. Digests are hashes: other bits of them place them in each part."""
    return [F.struct(
        (F.pmod(F.shiftright(digest, 21 * part), part_cells) + part_cells * part).cast("int").alias("cell"),
        sign.alias("n"), digest.alias("k"), _check(digest).alias("h")) for part in range(_PARTS)]


def _spread(signed: Column, part_cells: Column) -> Column:
    """Entries of an array of (n, k)."""
    return F.flatten(F.transform(signed, lambda s: F.array(*_entries(s["k"], s["n"], part_cells))))


def _cell(a: Column, b: Column) -> Column:
    return F.struct(b["cell"].alias("cell"), (a["n"] + b["n"]).alias("n"), a["k"].bitwiseXOR(b["k"]).alias("k"),
                    a["h"].bitwiseXOR(b["h"]).alias("h"))


def _merged(entries: Column) -> Column:
    """Cells: entries of equal cell added up, empty cells left out."""
    nothing = F.struct(F.lit(0).alias("cell"), F.lit(0).alias("n"), F.lit(0).cast("long").alias("k"),
                       F.lit(0).cast("long").alias("h"))

    def runs(e: Column) -> Column:
        heads = F.filter(F.transform(e, lambda x, i: F.when((i == 0) | (F.get(e, i - 1)["cell"] != x["cell"]), i)),
                         lambda i: i.isNotNull())
        return let(heads, lambda at: F.transform(at, lambda i, j: F.aggregate(
            F.slice(e, i + 1, F.coalesce(F.get(at, j + 1), F.size(e)) - i), nothing, _cell)))

    return F.filter(let(F.sort_array(entries), runs), lambda c: (c["n"] != 0) | (c["k"] != 0) | (c["h"] != 0))


def _signed(digests: Column, sign: int) -> Column:
    return F.transform(digests, lambda d: F.struct(F.lit(sign).alias("n"), d.alias("k")))


def cells(digests: Column, part_cells: Column) -> Column:
    """Sketch of one version: its cells that hold anything."""
    return _merged(_spread(_signed(digests, 1), part_cells))


def _state(left: Column, found: Column, stuck: Column) -> Column:
    return F.struct(left.alias("cells"), found.alias("found"), stuck.alias("stuck"))


def _peeled(sketch: Column, part_cells: Column) -> Column:
    """State after peeling: cells left, and the digests found with their sign."""
    def step(s: Column) -> Column:
        pure = F.filter(s["cells"], lambda c: (F.abs(c["n"]) == 1) & (c["h"] == _check(c["k"])))
        keys = F.array_distinct(F.transform(pure, lambda c: F.struct(c["n"].alias("n"), c["k"].alias("k"))))
        undone = lambda ks: F.transform(ks, lambda p: F.struct((-p["n"]).alias("n"), p["k"].alias("k")))
        return let(keys, lambda ks: _state(
            _merged(F.concat(s["cells"], _spread(undone(ks), part_cells))), F.concat(s["found"], ks), F.size(ks) == 0))

    none = F.array().cast("array<struct<n:int,k:bigint>>")
    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), _state(sketch, none, F.lit(False)),
                       lambda s, _: F.when(s["stuck"] | (F.size(s["cells"]) == 0), s).otherwise(step(s)))


def difference(a: Column, b: Column, expected: float = 0.75) -> Column:
    """Digests of a and not b (n = 1) and of b and not a (n = -1), recovered from subtracted sketches.

    ``expected`` is the share of all paragraphs that may differ; the first size holds them. The arrays should be
    columns: each is used many times.
    """
    start = F.ceil((F.size(a) + F.size(b)) * (1.5 * expected) / _PARTS) + 4
    both = F.concat(_signed(a, 1), _signed(b, -1))
    unread = F.struct(F.lit(False).alias("done"), F.array().cast("array<struct<n:int,k:bigint>>").alias("found"))

    def attempt(i: Column) -> Column:
        part_cells = (start * F.pow(F.lit(2), i)).cast("long")
        return let(part_cells, lambda size: let(_peeled(_merged(_spread(both, size)), size), lambda s: F.struct(
            (F.size(s["cells"]) == 0).alias("done"), s["found"].alias("found"))))

    tried = F.aggregate(F.sequence(F.lit(0), F.lit(RETRIES - 1)), unread,
                        lambda s, i: F.when(s["done"], s).otherwise(attempt(i)))
    listed = F.concat(_signed(F.array_except(a, b), 1), _signed(F.array_except(b, a), -1))
    return let(tried, lambda s: F.when(s["done"], s["found"]).otherwise(listed))


def likeness(a: Column, b: Column, differing: Column) -> Column:
    """Share of the paragraphs of both versions that both have."""
    union = (F.size(a) + F.size(b) + F.size(differing)) / 2
    return F.when(union == 0, F.lit(1.0)).otherwise(1.0 - F.size(differing) / union)


def written(digests: Column) -> Column:
    """The fingerprint as text: number of paragraphs, then cell, count, digests and checks of each cell in use."""
    part = F.lit(FINGER_CELLS // _PARTS).cast("long")
    shown = F.transform(cells(digests, part), lambda c: F.concat_ws(
        ".", c["cell"].cast("string"), c["n"].cast("string"), F.lower(F.hex(c["k"])), F.lower(F.hex(c["h"]))))
    return F.concat_ws(";", F.size(digests).cast("string"), F.array_join(shown, ";"))


def with_next(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """Rows (doc_id, text) with the text of the row after, by ascending id; the first one's after the last.

    Rows are ordered within blocks of ids. The last of a block gets the first of the next block that has rows, found
    among one row per block, again by blocks.
    """
    order = [F.col("doc_id").asc_nulls_first(), F.col("text")]
    least = F.struct(F.col("doc_id").isNotNull().alias("has_id"), "doc_id", "text")
    placed = docs.withColumn("block", F.coalesce(F.floor(F.col("doc_id") / block), F.lit(-1 << 62)).cast("long"))
    firsts = placed.groupBy("block").agg(F.min(least)["text"].alias("first_text"))
    firsts = firsts.withColumn("group", F.floor(F.col("block") / (block * 8)))
    heads = firsts.groupBy("group").agg(F.min_by("first_text", "block").alias("group_text"))
    ring = Window.orderBy("group")  # one row for every two million ids
    after = heads.select("group", F.coalesce(
        F.lead("group_text").over(ring),
        F.first("group_text").over(ring.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("group_next"))
    in_group = Window.partitionBy("group").orderBy("block")
    block_next = firsts.withColumn("in_group", F.lead("first_text").over(in_group)).join(after, "group").select(
        "block", F.coalesce("in_group", "group_next").alias("block_next"))
    in_block = Window.partitionBy("block").orderBy(*order)
    led = placed.withColumn("in_block", F.lead("text").over(in_block))
    return led.join(block_next, "block").select("doc_id", "text", F.coalesce("in_block", "block_next").alias("next_text"))


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """One row per document with its edited version and the next document: n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next, and the digests recovered for either (changed, changed_next)."""
    docs = df.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                     F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    rows = with_next(docs, block)
    half = F.floor(F.char_length("text") / 2).cast("int")
    rows = rows.withColumns({"n_chars": F.char_length("text").cast("long"), "edited": F.concat(
        F.substring("text", F.lit(1), F.char_length("text") - half), F.substring("next_text", F.lit(1), half))})
    rows = rows.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), paragraphs(F.col("text")).alias("own"),
                       paragraphs(F.col("edited")).alias("new"), paragraphs(F.col("next_text")).alias("next"))
    rows = rows.withColumns({"changed": difference(F.col("own"), F.col("new")),
                             "changed_next": difference(F.col("own"), F.col("next"), 1.0)})
    return rows.select("doc_id", "n_chars", "edited_sha256", written(F.col("own")).alias("fingerprint"),
                       written(F.col("new")).alias("edited_fingerprint"),
                       likeness(F.col("own"), F.col("new"), F.col("changed")).alias("near_edited"),
                       likeness(F.col("own"), F.col("next"), F.col("changed_next")).alias("near_next"),
                       "changed", "changed_next")
