"""Token ids of whole texts by a public tokenizer file; its path is a parameter."""

from __future__ import annotations

import os
import re
from functools import lru_cache
from itertools import chain

import numpy as np

#: Id that ends each document.
END_ID = 0
#: Distinct pieces whose ids a worker remembers; further ones are encoded again for each text.
REMEMBERED = 500_000

# A piece is a run of spaces and line feeds with what follows up to the next one, or a word of plain letters that white
# space or a mark follows. The vocabulary's pre-tokenizer joins neither a character to white space after it nor a letter
# to a mark, so a text's ids are those of its pieces put together - as long as a text has no other white space, where a
# longer run could be cut.
_PIECE = re.compile(r"[ \n]?[A-Za-zÀ-ÖØ-öø-ÿ]+(?=[ \n.,;:!?]|\Z)|[ \n]*[^ \n]+|[ \n]+")
# One word of letters is one pre-token: the model merges it without the rest of the library's steps.
_PLAIN = re.compile(r" ?[A-Za-zÀ-ÖØ-öø-ÿ]+")
# Looked for one by one: a search for a character takes a tenth of a pattern's time.
_OTHER_SPACE = [c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n"]


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def byte_letters() -> dict[int, str]:
    """The letter that byte-level vocabularies write for each byte: itself if it is visible, else the next from U+0100."""
    shown = {b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174}
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class _Numbers(dict):
    """Numbers of pieces. A new piece takes the next number as it is looked up, and is listed."""

    def __init__(self):
        super().__init__()
        self.fresh: list[str] = []

    def __missing__(self, piece: str) -> int:
        number = self[piece] = len(self)
        self.fresh.append(piece)
        return number

    def forget(self) -> None:
        for piece in self.fresh:
            del self[piece]
        self.fresh.clear()


class Encoder:
    """Encodes with the tokenizers library, each distinct piece once."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.letters = byte_letters()
        self.known = _Numbers()
        self.ids = np.zeros(1 << 16, np.uint32)
        self.starts = np.zeros(1 << 14, np.int64)
        self.sizes = np.zeros(1 << 14, np.int64)
        self.used = 0

    def _learn(self, pieces: list[str]) -> None:
        model, letters, plain = self.tokenizer.model, self.letters, _PLAIN.fullmatch
        found = [[t.id for t in model.tokenize(p.encode().decode("latin-1").translate(letters))] if plain(p) else
                 self.tokenizer.encode(p, add_special_tokens=False).ids for p in pieces]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        own = np.fromiter(chain.from_iterable(found), np.uint32, int(sizes.sum()))
        i = len(self.known) - len(found)
        if self.used + len(own) > len(self.ids):
            self.ids = np.resize(self.ids, 2 * (self.used + len(own)))
        if i + len(found) > len(self.starts):
            self.starts = np.resize(self.starts, 2 * (i + len(found)))
            self.sizes = np.resize(self.sizes, 2 * (i + len(found)))
        self.ids[self.used:self.used + len(own)] = own
        self.sizes[i:i + len(found)] = sizes
        self.starts[i:i + len(found)] = self.used + np.cumsum(sizes) - sizes
        self.used += len(own)

    def encode(self, text: str) -> np.ndarray:
        """Ids of the whole text and the end id."""
        if not text:
            return np.array([END_ID], np.uint32)
        if any(map(text.__contains__, _OTHER_SPACE)):
            own = self.tokenizer.encode(text, add_special_tokens=False).ids
            return np.array([*own, END_ID], np.uint32)
        pieces, known, before = _PIECE.findall(text), self.known, self.used
        at = np.fromiter(map(known.__getitem__, pieces), np.int64, len(pieces))
        if known.fresh:
            try:
                self._learn(known.fresh)
            except BaseException:
                known.forget()
                raise
        sizes = self.sizes[at]
        ends = np.cumsum(sizes)
        out = np.empty(int(ends[-1]) + 1, np.uint32)
        out[:-1] = self.ids[np.repeat(self.starts[at] - ends + sizes, sizes) + np.arange(ends[-1])]
        out[-1] = END_ID
        if len(known) > REMEMBERED:
            known.forget()
            self.used = before
        known.fresh.clear()
        return out


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder for each Python worker and vocabulary."""
    return Encoder(path)
