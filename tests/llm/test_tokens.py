"""The encoder against the tokenizers library around every kind of white space."""

import sys

import pytest

from tidemark.llm import tokens
from tidemark.llm.tokens import _OTHER_SPACE, Encoder, default_vocabulary, encoder


def test_all_white_space():
    assert sorted(_OTHER_SPACE) == sorted(c for c in map(chr, range(sys.maxunicode + 1)) if c.isspace() and c not in " \n")
    e = encoder(default_vocabulary())
    for text in ["one two\n\n three", *(f"one{c}two {c} three{c}" for c in _OTHER_SPACE)]:
        assert e.encode(text).tolist() == [*e.tokenizer.encode(text, add_special_tokens=False).ids, 0]


def test_pieces_are_numbered_as_they_are_looked_up(monkeypatch):
    """New pieces get ids in one pass, are let go beyond the bound, and after a failure."""
    monkeypatch.setattr(tokens, "REMEMBERED", 4)
    e = Encoder(default_vocabulary())
    for text in ["one two two one", "three one, four! \u00e9t\u00e9 42", "one two", "five six seven five", "two five"]:
        assert e.encode(text).tolist() == [*e.tokenizer.encode(text, add_special_tokens=False).ids, 0]
        assert not e.known.fresh and len(e.known) <= 4
    known = dict(e.known)
    with monkeypatch.context() as m:
        m.setattr(e, "_learn", lambda pieces: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            e.encode("one eight")
    assert e.known == known and e.encode("one eight").tolist()[-1] == 0
