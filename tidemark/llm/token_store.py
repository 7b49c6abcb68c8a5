"""Token-id shards with keyed access through minimal perfect hashes.

A store is a folder:

* ``shard-00000.ids``: 16 bytes of head (magic, bytes per id: 2 where the vocabulary fits, else 4), then the raw ids of
  all documents of one range of ids, in ascending order. A shard is one Spark partition of a range partitioning, so a
  hot key range is split by the sampled bounds.
* ``index-00000.mph``: the keys of one hash part: a minimal perfect hash, and at each key's slot a stored 32-bit
  fingerprint, its shard, its place in the shard and its number of ids. A key is looked up by one hash of its part, one
  slot and one comparison; a key that was never stored fails the fingerprint (2^-32 by chance).

Both are written by the tasks through the file system of the shared folder, under a name of the attempt, then renamed:
a repeated or lost task leaves one whole file. Only counts per shard reach the driver.

Defined results: a null or empty text is stored as the end id alone. Rows with equal ids are told apart by ``copy``,
0, 1, ... in the order of their texts; a null id is a key of its own, before all others.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import checkpoint_dir

from .perfect_hash import PerfectHash, fingerprint
from .tables import stored
from .tokens import default_vocabulary, encoder
from .words import documents, mix, partitions, small_batches

MAGIC = b"TMIDS001"
HEAD = 16
#: Keys of an index part.
PART_KEYS = 50_000

ENTRY = "doc_id long, copy int, shard int, place long, n_tokens int"


def _opened(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder)


def _write(folder: str, name: str, chunks: Iterator[bytes]) -> None:
    """Write under a name of this attempt, then move: the file is whole or absent."""
    files, path = _opened(folder)
    attempt = f"{path}/.{name}.{uuid.uuid4().hex}"
    with files.open_output_stream(attempt) as out:
        for chunk in chunks:
            out.write(chunk)
    files.move(attempt, f"{path}/{name}")


def _hashed(ids: pd.Series, copies: np.ndarray) -> np.ndarray:
    """Hash of each key (id, copy)."""
    raw = ids.to_numpy().astype(np.int64).view(np.uint64)
    return mix(mix(raw) + copies.astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _named(keys: DataFrame) -> DataFrame:
    """Keys without nulls: a null id becomes id 0 with copies -1, -2, ..."""
    copy = F.when(F.col("doc_id").isNull(), -1 - F.col("copy")).otherwise(F.col("copy")).cast("int")
    return keys.withColumns({"copy": copy, "doc_id": F.coalesce("doc_id", F.lit(0).cast("long"))})


def _part(parts: int) -> Column:
    return F.pmod(F.xxhash64("doc_id", "copy"), F.lit(parts)).cast("int")


@dataclass
class TokenStore:
    folder: str
    parts: int
    entries: DataFrame  # doc_id, copy, shard, place, n_tokens as written
    totals: DataFrame  # shard, start: ids before the shard

    def lookup(self, keys: DataFrame) -> DataFrame:
        """Keys (doc_id, copy) with shard, place and n_tokens from the index files; keys not in the store are left out."""
        folder = self.folder

        def find(group: pd.DataFrame) -> pd.DataFrame:
            name = f"index-{int(group['part'].iloc[0]):05d}.mph"
            files, path = _opened(folder)
            with files.open_input_file(f"{path}/{name}") as f:
                body = f.read()
            placed, at = PerfectHash.from_bytes(body)
            table = np.frombuffer(body, SLOT, offset=at)
            h = _hashed(group["doc_id"], group["copy"].to_numpy())
            slot = placed(h)
            ok = slot >= 0
            ok[ok] = table["print"][slot[ok]] == fingerprint(h[ok])
            got = table[slot[ok]]
            return pd.DataFrame({"doc_id": group["doc_id"].to_numpy()[ok], "copy": group["copy"].to_numpy()[ok],
                                 "shard": got["shard"], "place": got["place"], "n_tokens": got["size"]})

        # A part is loaded once for each salt; keys of a part can be any number.
        keyed = _named(keys).withColumn("part", _part(self.parts))
        salted = keyed.withColumn("salt", F.pmod(F.xxhash64("copy", "doc_id", F.lit(1)), F.lit(4)))
        found = salted.select("doc_id", "copy", "part", "salt").groupBy("part", "salt").applyInPandas(find, ENTRY)
        null = F.col("copy") < 0
        return found.withColumns({"doc_id": F.when(~null, F.col("doc_id")),
                                  "copy": F.when(null, -1 - F.col("copy")).otherwise(F.col("copy"))})

    def read(self, keys: DataFrame) -> DataFrame:
        """Keys with start (ids of all documents before), n_tokens and ids, read from index and shard files."""
        folder, spark = self.folder, keys.sparkSession
        small_batches(spark)

        def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            files, path = _opened(folder)
            shard, source, width = None, None, 2
            for batch in batches:
                bodies = []
                for s, place, n in zip(*(batch.column(c).to_pylist() for c in ("shard", "place", "n_tokens"))):
                    if s != shard:
                        if source is not None:
                            source.close()
                        shard, source = s, files.open_input_file(f"{path}/shard-{s:05d}.ids")
                        width = int(np.frombuffer(source.read_at(HEAD, 0), "<u8")[1])
                    body = source.read_at(n * width, HEAD + place * width)
                    bodies.append(np.frombuffer(body, "<u2" if width == 2 else "<u4").astype("<u4").tobytes())
                out = {c: batch.column(c) for c in ("doc_id", "copy", "shard", "place", "n_tokens")}
                yield pa.RecordBatch.from_arrays([*out.values(), pa.array(bodies, pa.binary())], [*out, "ids"])

        found = self.lookup(keys)
        # Neighbours in a shard are read by one task in file order; a large shard is split over several.
        near = found.repartition(partitions(spark), "shard", F.floor(F.col("place") / (1 << 20)))
        rows = near.sortWithinPartitions("shard", "place").mapInArrow(fetch, ENTRY + ", ids binary")
        return rows.join(F.broadcast(self.totals), "shard").select(
            "doc_id", "copy", (F.col("place") + F.col("start")).alias("start"), F.col("n_tokens").cast("long").alias("n_tokens"),
            "ids")


SLOT = np.dtype([("print", "<u4"), ("shard", "<u4"), ("place", "<i8"), ("size", "<i4")])


def write_store(df: DataFrame, folder: str | None = None, vocabulary: str | None = None, id_col: str = "doc_id",
                text_col: str = "text", shards: int | None = None, part_keys: int = PART_KEYS) -> TokenStore:
    """Encode, write shards in ascending id order, then the index. ``folder`` is shared by driver and executors."""
    spark: SparkSession = df.sparkSession
    folder = folder or f"{checkpoint_dir(spark).rstrip('/')}/tidemark-ids-{uuid.uuid4().hex}"
    vocabulary = vocabulary or default_vocabulary()
    files, path = _opened(folder)
    files.create_dir(path)
    small_batches(spark)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, encode_text = TaskContext.get().partitionId(), encoder(vocabulary).encode
        wide = 2 if encoder(vocabulary).tokenizer.get_vocab_size() <= 1 << 16 else 4
        entries, place, last, copy = [], 0, object(), 0

        def chunks() -> Iterator[bytes]:
            nonlocal place, last, copy
            yield MAGIC + np.array([wide], "<u8").tobytes()
            for batch in batches:
                sizes, copies, places = [], [], []
                for key, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                    ids = encode_text(text or "")
                    copy = copy + 1 if key == last else 0
                    last = key
                    yield ids.astype("<u2" if wide == 2 else "<u4").tobytes()
                    sizes.append(len(ids))
                    copies.append(copy)
                    places.append(place)
                    place += len(ids)
                entries.append(pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(copies, pa.int32()),
                     pa.array([shard] * len(sizes), pa.int32()), pa.array(places, pa.int64()),
                     pa.array(sizes, pa.int32())], ["doc_id", "copy", "shard", "place", "n_tokens"]))

        _write(folder, f"shard-{shard:05d}.ids", chunks())
        yield from entries

    docs = documents(df, id_col, text_col).repartitionByRange(shards or partitions(spark), F.col("doc_id").asc_nulls_first())
    entries = stored(docs.sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text").mapInArrow(encode, ENTRY))

    per_shard = entries.groupBy("shard").agg(F.sum("n_tokens").alias("ids"), F.count(F.lit(1)).alias("keys"))
    rows = sorted(per_shard.collect())  # one row per shard
    parts = max(1, math.ceil(sum(r["keys"] for r in rows) / part_keys))
    starts, before = [], 0
    for r in rows:
        starts.append((r["shard"], before))
        before += r["ids"]
    totals = spark.createDataFrame(starts, "shard int, start long")

    def index(group: pd.DataFrame) -> pd.DataFrame:
        part = int(group["part"].iloc[0])
        h = _hashed(group["doc_id"], group["copy"].to_numpy())
        placed = PerfectHash.build(h)
        table = np.zeros(len(h), SLOT)
        slot = placed(h)
        for name, values in (("print", fingerprint(h)), ("shard", group["shard"]), ("place", group["place"]),
                             ("size", group["n_tokens"])):
            table[name][slot] = values
        _write(folder, f"index-{part:05d}.mph", iter([placed.to_bytes(), table.tobytes()]))
        return pd.DataFrame({"part": [part], "keys": [len(h)]})

    keyed = _named(entries).withColumn("part", _part(parts))
    keyed.groupBy("part").applyInPandas(index, "part int, keys long").agg(F.sum("keys")).collect()
    return TokenStore(folder, parts, entries, totals)

