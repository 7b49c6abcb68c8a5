"""Harmonic packing of token sequences.

A capacity C has reciprocal classes: class i takes pieces of up to C/i tokens (more than C/(i+1)), and each of its bins
takes exactly i of them. Bins of a class are filled independently by every worker: a worker is a hash part of document
ids, its pieces of a class are ranked by id and place, and i successive ranks share a bin. What is left over at a
worker (less than one bin for each class) is ranked again over all workers, and what is left of that, a bounded number
of pieces whatever the input, is put together by first fit.

Cuts are free, so a document is cut where classes fill whole: into full sequences, then the longest exact C/i at a time
until the rest is short (below C/16, where a class wastes little anyway). Each id lies in exactly one piece.

Defined results: a null or empty text is one piece of the end id. Rows with equal ids are all packed, told apart by
their texts' checksums; other columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import stored
from .tokens import default_vocabulary, encoder
from .words import documents, map_blocks, partitions

CAPACITY = 1024
#: Rests shorter than C / FINE are not cut further.
FINE = 16

PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, class int"


def cuts(length: int, capacity: int = CAPACITY, fine: int = FINE) -> list[int]:
    """Lengths of the pieces of a document, in order."""
    out = [capacity] * (length // capacity)
    rest = length % capacity
    while rest >= max(2, capacity // fine):
        out.append(capacity // -(-capacity // rest))
        rest -= out[-1]
    return [*out, rest] if rest else out


def _pieces(vocabulary: str, capacity: int, keep_ids: bool):
    def work(block: pa.RecordBatch) -> dict:
        encode, out = encoder(vocabulary).encode, {n: [] for n in ("doc_id", "start", "length", "crc", "tokens", "class")}
        bodies = []
        for key, text in zip(block.column("doc_id").to_pylist(), block.column("text").to_pylist()):
            ids = encode(text or "").astype("<u4")
            start = 0
            for size in cuts(len(ids), capacity):
                body = ids[start:start + size].tobytes()
                for name, value in zip(out, (key, start, size, zlib.crc32(body), len(ids), capacity // size)):
                    out[name].append(value)
                if keep_ids:
                    bodies.append(body)
                start += size
        return {**out, "ids": bodies} if keep_ids else out

    return work


def _ranked(pieces: DataFrame, *group: str) -> DataFrame:
    """Rank in the group and whether the piece's bin gets full."""
    order = ("doc_id", "start", "ids_crc32", "doc_tokens")
    w = Window.partitionBy(*group)
    pieces = pieces.withColumns({"rank": F.row_number().over(w.orderBy(*order)) - 1, "n": F.count(F.lit(1)).over(w)})
    bin_of = F.floor(F.col("rank") / F.col("class")).cast("int")
    return pieces.withColumns({"bin": bin_of, "full": (bin_of + 1) * F.col("class") <= F.col("n")})


def pack(df: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY, keep_ids: bool = False,
         workers: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, class, sequence_id, offset (and ids)."""
    spark = df.sparkSession
    docs = documents(df, id_col, text_col)
    schema = PIECE + (", ids binary" if keep_ids else "")
    pieces = stored(map_blocks(docs, _pieces(vocabulary or default_vocabulary(), capacity, keep_ids), schema))
    columns, workers = pieces.columns, workers or partitions(spark)

    own = _ranked(pieces.withColumn("worker", F.pmod(F.xxhash64("doc_id", "start"), F.lit(workers)).cast("int")),
                  "worker", "class")
    done = own.where("full").select(*columns, F.struct("worker", "class", "bin").alias("sequence"))
    left = stored(own.where("NOT full").select(*columns))

    across = _ranked(left, "class")
    done_across = across.where("full").select(
        *columns, F.struct(F.lit(workers).alias("worker"), "class", "bin").alias("sequence"))
    last = across.where("NOT full").select(*columns)

    def first_fit(group: pd.DataFrame) -> pd.DataFrame:
        # Fewer than i pieces of each class i: a bound that depends on the capacity alone.
        group = group.sort_values(["length", "doc_id", "start"], ascending=[False, True, True], kind="stable")
        room: list[int] = []
        bins = []
        for size in group["length"]:
            at = next((i for i, free in enumerate(room) if free >= size), len(room))
            if at == len(room):
                room.append(capacity)
            room[at] -= size
            bins.append(at)
        return group.drop(columns="all").assign(worker=workers + 1, cls=0, bin=bins)

    fitted = last.withColumn("all", F.lit(0)).groupBy("all").applyInPandas(
        first_fit, f"{schema}, worker int, cls int, bin int").select(
        *columns, F.struct("worker", F.col("cls").alias("class"), "bin").alias("sequence"))

    packed = done.unionByName(done_across).unionByName(fitted)
    inside = Window.partitionBy("sequence").orderBy("doc_id", "start", "ids_crc32", "doc_tokens")
    before = F.sum("length").over(inside.rowsBetween(Window.unboundedPreceding, -1))
    return packed.select(*columns, _number(capacity).alias("sequence_id"), F.coalesce(before, F.lit(0)).alias("offset"))


def _number(capacity: int) -> Column:
    """One number of worker, class and bin."""
    s = F.col("sequence")
    return (s["worker"].cast("long") * (capacity + 1) + s["class"]) * (1 << 28) + s["bin"]
