"""Dense ids of the words of one block, equal exactly where the words' bytes are."""

from __future__ import annotations

import numpy as np

from .words import Words

_MASKS = np.array([(1 << (8 * n)) - 1 for n in range(8)] + [(1 << 64) - 1], dtype=np.uint64)


def word_ids(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """(id of each word, index of one word with each id). Words are told apart by hash, then compared byte by byte."""
    if not len(words):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    _, sample, ids = np.unique(words.hashes, return_index=True, return_inverse=True)
    if _equal(words, sample[ids]):
        return ids.astype(np.int64), sample
    known: dict[bytes, int] = {}
    ids = np.array([known.setdefault(words.word(i), len(known)) for i in range(len(words))], np.int64)
    return ids, np.unique(ids, return_index=True)[1]


def _equal(words: Words, other: np.ndarray) -> bool:
    """Has every word the bytes of the word at its place in ``other``."""
    length = words.ends - words.starts
    if not np.array_equal(length, length[other]):
        return False
    eight = np.ndarray((len(words.data) - 7,), "<u8", words.data.tobytes(), 0, (1,))
    a, b, at = words.starts, words.starts[other], 0
    left = np.flatnonzero(a != b)
    while len(left):
        mask = _MASKS[np.minimum(length[left] - at, 8)]
        if np.any((eight[a[left] + at] ^ eight[b[left] + at]) & mask):
            return False
        at += 8
        left = left[length[left] > at]
    return True
