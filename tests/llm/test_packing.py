"""Pieces cover every id once; sequences are gapless, within capacity and full."""

import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from tidemark.llm.packing import cuts, pack
from tidemark.llm.queries import op8_packing
from tidemark.llm.tokens import default_vocabulary

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("n", [1, 2, 63, 64, 65, 700, 1023, 1024, 1025, 5000])
def test_cuts(n):
    assert sum(cuts(n)) == n and all(0 < c <= 1024 for c in cuts(n))


def sequences(rows, capacity):
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return by


def test_planted(spark):
    tok = Tokenizer.from_file(default_vocabulary())
    rows = [(1, None), (2, ""), (3, "a b c"), (4, "word " * 5000), (5, "same"), (5, "same"), (5, "other text"), (None, "n")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, class int").repartition(3)
    got = pack(df, keep_ids=True, workers=3).collect()
    sequences(got, 1024)
    assert len(got) == sum(len(cuts(len(tok.encode(t or "", add_special_tokens=False).ids) + 1)) for _, t in rows)
    long = sorted((r for r in got if r.doc_id == 4), key=lambda r: r.start)
    ids = np.concatenate([np.frombuffer(r["ids"], "<u4") for r in long])
    assert ids.tolist() == [*tok.encode("word " * 5000, add_special_tokens=False).ids, 0]
    assert all(r.ids_crc32 == zlib.crc32(r["ids"]) and r.doc_tokens == len(ids) for r in long)
    assert pack(df.where("false")).count() == 0


def test_query(spark):
    tok = Tokenizer.from_file(default_vocabulary())
    got = op8_packing(spark, SF_DIR).collect()
    by = sequences(got, 1024)
    pieces = defaultdict(list)
    for r in got:
        pieces[r.doc_id].append(r)
    for doc in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect():
        ids, at = np.array([*tok.encode(doc.text, add_special_tokens=False).ids, 0], "<u4"), 0
        for r in sorted(pieces.pop(doc.doc_id), key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(ids[at:at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    assert not pieces
    used = sum(r.length for r in got)
    assert used > 0.97 * 1024 * len(by)
