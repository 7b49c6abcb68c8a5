"""Minimal perfect hash over 64-bit key hashes, by levels of bit arrays."""

from __future__ import annotations

import numpy as np

from .words import mix

#: Bits of a level for each key that is left.
GAMMA = 1.6
#: Keys that still collide after so many levels (none in practice) are listed.
LEVELS = 40

_U = np.uint64


def fingerprint(h: np.ndarray) -> np.ndarray:
    return (mix(h ^ _U(0xA5A5A5A55A5A5A5A)) >> _U(32)).astype(np.uint32)


def _slots(h: np.ndarray, level: int, bits: int) -> np.ndarray:
    return (mix(h + _U((level + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) % _U(bits)).astype(np.int64)


class PerfectHash:
    """Distinct keys to 0..n-1. A key is placed at the first level where no other remaining key shares its bit."""

    def __init__(self, levels: list[np.ndarray], rest: np.ndarray):
        self.levels, self.rest = levels, rest  # levels: bool arrays; rest: sorted hashes
        flat = np.concatenate([*levels, np.zeros(0, bool)])
        self.rank = np.cumsum(flat) - flat
        self.base = np.concatenate([[0], np.cumsum([len(x) for x in levels])]).astype(np.int64)
        self.placed = int(flat.sum())

    @classmethod
    def build(cls, h: np.ndarray) -> PerfectHash:
        levels, left = [], h
        while len(left) and len(levels) < LEVELS:
            bits = max(64, int(GAMMA * len(left)))
            at = _slots(left, len(levels), bits)
            alone = np.bincount(at, minlength=bits) == 1
            levels.append(alone)
            left = left[~alone[at]]
        return cls(levels, np.sort(left))

    def __call__(self, h: np.ndarray) -> np.ndarray:
        """Slot of each key; of a key that was never put in, any slot or -1. Constant time: levels left fall by a third
        or more at each step, whatever the number of keys."""
        out = np.full(len(h), -1, np.int64)
        left = np.arange(len(h))
        for level, bits in enumerate(self.levels):
            at = _slots(h[left], level, len(bits))
            hit = bits[at]
            out[left[hit]] = self.rank[self.base[level] + at[hit]]
            left = left[~hit]
            if not len(left):
                return out
        if len(self.rest):
            at = np.minimum(np.searchsorted(self.rest, h[left]), len(self.rest) - 1)
            found = self.rest[at] == h[left]
            out[left[found]] = self.placed + at[found]
        return out

    def to_bytes(self) -> bytes:
        head = np.array([len(self.levels), len(self.rest), *(len(x) for x in self.levels)], "<u8").tobytes()
        return head + b"".join(np.packbits(x).tobytes() for x in self.levels) + self.rest.astype("<u8").tobytes()

    @classmethod
    def from_bytes(cls, body: bytes, at: int = 0) -> tuple[PerfectHash, int]:
        """The hash, and where its bytes end."""
        n, rest = (int(x) for x in np.frombuffer(body, "<u8", 2, at))
        sizes = np.frombuffer(body, "<u8", n, at + 16).astype(np.int64).tolist()
        at += 16 + 8 * n
        levels = []
        for size in sizes:
            levels.append(np.unpackbits(np.frombuffer(body, np.uint8, -(-size // 8), at), count=size).astype(bool))
            at += -(-size // 8)
        return cls(levels, np.frombuffer(body, "<u8", rest, at).astype(_U)), at + 8 * rest
