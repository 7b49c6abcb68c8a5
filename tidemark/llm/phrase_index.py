"""An FM-index over the word ids of one shard, searched in both directions for all phrases of a length at once.

The pieces of a shard are one sequence of symbols, 1 and up for words, 0 for what lies between pieces. Suffixes sorted
by their first words give ``before``, the symbol that precedes each of them; prefixes sorted by their last words, read
backwards, give ``after``, the symbol that follows. A phrase is an interval in each of the two orders, both of the size
of its count. Its extensions to one side are the symbols in one interval: counting them gives the counts of the longer
phrases, and running sums give their intervals in both orders. Sorting stops at ``depth`` words, which is all that
phrases of depth + 1 words need.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Phrases:
    """Phrases of one length: their words' symbols, one row each, and their intervals in both orders."""

    words: np.ndarray
    suffix: np.ndarray  # first place in the order of suffixes
    prefix: np.ndarray  # first place in the order of prefixes
    count: np.ndarray

    def __len__(self) -> int:
        return len(self.count)

    def take(self, which: np.ndarray) -> Phrases:
        return Phrases(self.words[which], self.suffix[which], self.prefix[which], self.count[which])


def _ordered(symbols: np.ndarray, neighbour: np.ndarray, depth: int) -> np.ndarray:
    """Places ordered by the symbol there and the depth - 1 next ones; ``neighbour`` is the next place, -1 for none."""
    order = np.argsort(symbols, kind="stable")
    for _ in range(depth - 1):
        rank = np.empty(len(symbols) + 1, np.int64)
        rank[order], rank[-1] = np.arange(1, len(symbols) + 1), 0
        order = np.argsort(symbols.astype(np.int64) << 32 | rank[neighbour], kind="stable")
    return order


class PhraseIndex:
    """``before`` and ``after`` of a shard, and how often each symbol from 1 on occurs."""

    def __init__(self, before: np.ndarray, after: np.ndarray, counts: np.ndarray):
        self.before, self.after = before, after
        self.counts = counts.astype(np.int64)
        self.starts = np.cumsum(self.counts) - self.counts

    @classmethod
    def of(cls, symbols: np.ndarray, joined: np.ndarray, size: int, depth: int) -> PhraseIndex:
        """``joined``: does the next place continue the piece of each place but the last."""
        places = np.arange(len(symbols))
        on, back = np.full(len(symbols), -1), np.full(len(symbols), -1)
        on[:-1][joined], back[1:][joined] = places[1:][joined], places[:-1][joined]
        padded = np.append(symbols, 0).astype(np.int32)
        return cls(padded[back[_ordered(symbols, on, depth)]], padded[on[_ordered(symbols, back, depth)]],
                   np.bincount(symbols, minlength=size + 1)[1:])

    def words(self) -> Phrases:
        symbol = np.arange(1, len(self.counts) + 1)
        return Phrases(symbol[:, None], self.starts, self.starts, self.counts)

    def extended(self, phrases: Phrases, left: bool, known: np.ndarray, further: int = 2) -> Phrases:
        """All phrases of one word more, added on one side and among the ``known`` symbols (one flag for each).

        With ``further`` extensions to come, sides in turn, their place in the order searched here is needed from two on."""
        side, here, there = ((self.before, phrases.suffix, phrases.prefix) if left
                             else (self.after, phrases.prefix, phrases.suffix))
        size = phrases.count
        total, base = int(size.sum()), np.cumsum(size) - size
        if not total:
            return Phrases(np.zeros((0, phrases.words.shape[1] + 1), np.int64), *(np.zeros(0, np.int64),) * 3)
        places = np.arange(total) + np.repeat(here - base, size)
        key = np.repeat(np.arange(len(size)), size) << 32 | side[places]
        key.sort()
        head = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        count = np.diff(np.append(head, total))
        owner, symbol = key[head] >> 32, key[head] & 0xFFFFFFFF
        # Smaller symbols of the same phrase come before in the other order.
        smaller = head - base[owner]
        keep = np.concatenate([[False], known])[symbol]
        owner, symbol, count, smaller = owner[keep], symbol[keep], count[keep], smaller[keep]
        moved = self.starts[symbol - 1] + (self._rank(side, symbol, here[owner]) if further > 1 else 0)
        old, new = phrases.words[owner], symbol[:, None]
        return Phrases(np.hstack([new, old] if left else [old, new]), *(
            (moved, there[owner] + smaller) if left else (there[owner] + smaller, moved)), count)

    def _rank(self, side: np.ndarray, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Occurrences of each symbol that come before those it has at and after its place in ``side``.

        The first of them are at the end of a piece: nothing follows there, so ``side`` does not hold them."""
        order = np.argsort(side, kind="stable")
        listed = side[order].astype(np.int64) << 32 | order
        return self.counts[symbol - 1] - (np.searchsorted(listed, (symbol + 1) << 32)
                                          - np.searchsorted(listed, symbol << 32 | place))
