"""CSV records of files that are split although cells may hold line breaks.

Every byte range of a file reports how it moves the quoting state: whether it ends inside a quoted cell if it began
outside one, and if it began inside, and whether a record then ends in it. A prefix over the ranges of a file then tells where each began, and the ranges are
cut into records in parallel. A record that crosses ranges is put together from their pieces by a shuffle of those
pieces alone.

The states are one row per range that begins or ends inside a cell; lines meet them by a broadcast up to a bound, else by
a shuffle that restores the order of lines. A quote opens a cell only where the cell begins, and two of them are one.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ordering import SMALL_TABLE_ROWS
from ..session import checkpointed

_OPEN = re.compile(r'(?:^|,)"')
_CLOSE = re.compile(r'(?:[^"]|"")*"(?!")')
_KEYS = pa.schema([("file", pa.string()), ("block", pa.int64())])


def moved(line: str, inside: bool) -> bool:
    """Does a line end inside a cell, given whether it begins inside one."""
    at = 0
    if inside:
        end = _CLOSE.match(line)
        if not end:
            return True
        at = end.end()
    while start := _OPEN.search(line, at):
        end = _CLOSE.match(line, start.end())
        if not end:
            return True
        at = end.end()
    return False


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, at, line): lines in order within a block, which is a byte range of a file."""
    text = spark.read.option("lineSep", "\n").text(path)
    return text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                       F.monotonically_increasing_id().alias("at"), F.col("value").alias("line"))


def _by_block(batch: pa.RecordBatch) -> Iterator[tuple[str, int, pa.RecordBatch]]:
    """Consecutive lines of one block."""
    if not batch.num_rows:
        return
    files, blocks = batch.column("file"), batch.column("block")
    start = 0
    while start < batch.num_rows:
        file, block = files[start].as_py(), blocks[start].as_py()
        same = pc.and_(pc.equal(files, file), pc.equal(blocks, block)).slice(start)
        other = pc.index(same, False).as_py()
        size = batch.num_rows - start if other < 0 else other
        yield file, block, batch.slice(start, size)
        start += size


_STATE = "file string, block long, out_ends boolean, in_ends boolean, in_rests boolean"


def _transitions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    key, state = None, None
    for batch in batches:
        for file, block, part in _by_block(batch):
            if (file, block) != key:
                if key:
                    yield _state_row(key, state)
                key, state = (file, block), [False, True, False]
            quoted = part.column("line").filter(pc.match_substring(part.column("line"), '"'))
            for line in quoted.to_pylist():  # a line without a quote moves nothing
                line = line.removesuffix("\r")
                state[0], state[1] = moved(line, state[0]), moved(line, state[1])
                state[2] |= not state[1]
    if key:
        yield _state_row(key, state)


def _state_row(key: tuple[str, int], state: list[bool]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([v]) for v in (*key, *state)],
                                      names=["file", "block", "out_ends", "in_ends", "in_rests"])


def _starts(table: pa.Table) -> pa.Table:
    """(file, block, begins, ends, origin) of one file's blocks; ``origin`` began the record open at a block's start."""
    out, inside, origin = [], False, None
    for r in table.sort_by("block").to_pylist():
        ends = r["in_ends"] if inside else r["out_ends"]
        out.append({"file": r["file"], "block": r["block"], "begins": inside, "ends": ends, "origin": origin if inside else None})
        if ends and (not inside or r["in_rests"]):
            origin = r["block"]
        inside = ends
    return pa.Table.from_pylist(out, schema=pa.schema(
        [*_KEYS, ("begins", pa.bool_()), ("ends", pa.bool_()), ("origin", pa.int64())]))


_RECORDS = "file string, block long, part long, is_header boolean, record string, whole boolean"


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records of each block. What its first lines owe to an earlier block, and its open end, come as pieces: ``block``
    is then where the record began and ``part`` the block that the piece is from."""
    key = None
    for batch in batches:
        for file, block, lines in _by_block(batch):
            if (file, block) != key:
                if key:
                    yield _batch(key[0], _open_end(key[1], owed, held, fresh))
                key, held, fresh = (file, block), [], block == 0
                inside = bool(lines.column("begins")[0].as_py())
                owed = lines.column("origin")[0].as_py() if inside else None
            rows = []
            for line in lines.column("line").to_pylist():
                held.append(line)
                if '"' in line:
                    inside = moved(line.removesuffix("\r"), inside)
                if not inside:
                    record = "\n".join(held).removesuffix("\r")
                    rows.append((block if owed is None else owed, block, fresh, record, owed is None))
                    held, owed, fresh = [], None, False
            yield _batch(file, rows)
    if key:
        yield _batch(key[0], _open_end(key[1], owed, held, fresh))


def _open_end(block: int, owed: int | None, held: list[str], fresh: bool) -> list[tuple]:
    """What a block's end leaves open: its own last record, or a middle part of an earlier one."""
    return [(block if owed is None else owed, block, fresh, "\n".join(held), False)] if held else []


def _batch(file: str, rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * 5
    kinds = (pa.int64(), pa.int64(), pa.bool_(), pa.string(), pa.bool_())
    return pa.RecordBatch.from_arrays(
        [pa.array([file] * len(rows), pa.string()), *(pa.array(c, k) for c, k in zip(columns, kinds))],
        names=["file", "block", "part", "is_header", "record", "whole"])


def csv_records(spark: SparkSession, path: str, max_states: int = SMALL_TABLE_ROWS) -> DataFrame:
    """(is_header, record): the records of CSV files, line breaks inside cells included; empty lines are left out."""
    lines = _lines(spark, path)
    states = lines.drop("at").mapInArrow(_transitions, _STATE).groupBy("file").applyInArrow(
        _starts, "file string, block long, begins boolean, ends boolean, origin long")
    # Blocks at whose start or end a cell is open; all others begin and end between records.
    open_blocks = checkpointed(states.where(F.col("begins") | F.col("ends")))
    small = open_blocks.count() <= max_states

    def records(how: str) -> DataFrame:
        met = lines.join(F.broadcast(open_blocks) if small else open_blocks.hint("merge"), ["file", "block"], how)
        if not small:
            met = met.repartition("file", "block").sortWithinPartitions("file", "block", "at")
        return met.select("file", "block", "line", "begins", "origin").mapInArrow(_records, _RECORDS)

    pieces = records("inner").where("NOT whole").groupBy("file", "block").agg(
        F.max("is_header").alias("is_header"), F.array_sort(F.collect_list(F.struct("part", "record"))).alias("parts"))
    joined = F.regexp_replace(F.array_join(F.col("parts.record"), "\n"), "\r\\z", "")
    both = records("left").where("whole").select("is_header", "record").unionByName(
        pieces.select("is_header", joined.alias("record")))
    return both.where(F.length("record") > 0)
