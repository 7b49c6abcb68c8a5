"""Files read back against direct encoding; perfect hash on known and unknown keys; pieces against the library."""

import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from tidemark.llm.perfect_hash import PerfectHash, fingerprint
from tidemark.llm.queries import op7_token_store
from tidemark.llm.token_store import write_store
from tidemark.llm.tokens import Encoder, default_vocabulary
from tidemark.llm.words import mix

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(default_vocabulary())


def test_encoder_equals_library(library):
    enc = Encoder(default_vocabulary())
    texts = ["", " ", "a", "a  b", "a \n b\n\n c ", "tab\t  x", "don't we'll 'S x'y", "é.!?x, ,a", "   x  y",
             "a\x1cb !\x1c", "<|endoftext|> a <|endoftext|>b", "日本 語  。x", "x" * 5000, "1,2;3 a.b:c", "\x00 \x00", "ª1 a,ª"]
    for text in texts * 2:
        assert enc.encode(text).tolist() == [*library.encode(text, add_special_tokens=False).ids, 0], repr(text)


@pytest.mark.parametrize("n", [0, 1, 2, 100, 20000])
def test_perfect_hash(n):
    keys = mix(np.arange(n, dtype=np.uint64))
    placed, _ = PerfectHash.from_bytes(PerfectHash.build(keys).to_bytes())
    assert sorted(placed(keys).tolist()) == list(range(n))
    other = mix(np.arange(n, 2 * n + 5, dtype=np.uint64))
    slots = placed(other)
    assert ((slots >= -1) & (slots < max(n, 1))).all()
    if n:
        prints = np.zeros(n, np.uint32)
        prints[placed(keys)] = fingerprint(keys)
        assert not (prints[slots[slots >= 0]] == fingerprint(other[slots >= 0])).any()


def test_store(spark, library):
    rows = [(5, "five five"), (None, "nobody"), (1, None), (3, ""), (5, "five"), (5, "five"), (9, "word " * 30000), (-7, "é\tx")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("shard", df_lit()).repartition(3)
    store = write_store(df, shards=4, part_keys=3)
    got = sorted(store.read(store.entries.select("doc_id", "copy")).collect(), key=lambda r: r.start)
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    start = 0
    for r, (i, t) in zip(got, ordered, strict=True):
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 0]
        assert (r.doc_id, r.start, r.n_tokens) == (i, start, len(ids))
        assert np.frombuffer(r.ids, "<u4").tolist() == ids
        start += len(ids)
    unknown = spark.createDataFrame([(5, 0), (6, 0), (5, 9)], "doc_id long, copy int")
    assert [(r.doc_id, r["copy"]) for r in store.read(unknown).collect()] == [(5, 0)]


def df_lit():
    from pyspark.sql import functions as F

    return F.lit("clash")


def test_empty(spark):
    store = write_store(spark.createDataFrame([], "doc_id long, text string"))
    assert store.read(store.entries.select("doc_id", "copy")).collect() == []


def test_query(spark, library):
    docs = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect())
    want, start = {}, 0
    for i, t in docs:
        ids = np.array([*library.encode(t, add_special_tokens=False).ids, 0], "<u4")
        want[i] = (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in op7_token_store(spark, SF_DIR).collect()} == want
