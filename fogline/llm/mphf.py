"""Minimal perfect hash of 128-bit keys (two words): a cascade of bit arrays, built and probed with numpy.

Each level hashes the remaining keys into twice as many bits as there are keys and keeps those
that are alone on their bit; the rest go to the next level. A key's index is the rank of its bit. Both words of a key are
mixed anew on each level, so distinct keys part sooner or later, whatever they share.
"""

from __future__ import annotations

import numpy as np

from fogline.llm.words import mix

_STEP = np.uint64(0x9E3779B97F4A7C15)
SPREAD = 2
#: A level leaves about two fifths of the keys; distinct keys are done long before.
MOST_LEVELS = 200


def _bit(hi: np.ndarray, lo: np.ndarray, level: int, size: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (mix(mix(hi + np.uint64(level + 1) * _STEP) + lo) % np.uint64(size)).astype(np.int64)


def build(hi: np.ndarray, lo: np.ndarray) -> list[np.ndarray]:
    """Bit arrays for distinct keys (hi, lo: uint64). A key that occurs twice raises ValueError."""
    levels = []
    while len(hi):
        if len(levels) == MOST_LEVELS:
            raise ValueError(f"{len(hi)} keys are not distinct")
        size = SPREAD * len(hi) + 1
        at = _bit(hi, lo, len(levels), size)
        alone = np.bincount(at, minlength=size) == 1
        levels.append(alone)
        rest = ~alone[at]
        hi, lo = hi[rest], lo[rest]
    return levels


def dump(levels: list[np.ndarray]) -> bytes:
    head = np.array([len(levels), *(len(b) for b in levels)], np.int64).tobytes()
    return head + b"".join(np.packbits(b).tobytes() for b in levels)


def load(data: bytes) -> list[np.ndarray]:
    count = int(np.frombuffer(data, np.int64, 1)[0])
    sizes = np.frombuffer(data, np.int64, count, 8)
    at, levels = 8 * (count + 1), []
    for size in sizes.tolist():
        part = np.frombuffer(data, np.uint8, (size + 7) // 8, at)
        levels.append(np.unpackbits(part, count=size).astype(bool))
        at += len(part)
    return levels


class Index:
    """Ready to answer: ``Index(levels).of(hi, lo)`` is the index of each key, -1 where none can be."""

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        self.rank = []
        before = 0
        for bits in levels:
            self.rank.append(np.cumsum(bits, dtype=np.int64) + (before - 1))
            before += int(bits.sum())
        self.size = before

    def of(self, hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
        out = np.full(len(hi), -1, np.int64)
        left = np.arange(len(hi))
        for level, bits in enumerate(self.levels):
            if not len(left):
                break
            at = _bit(hi[left], lo[left], level, len(bits))
            here = bits[at]
            out[left[here]] = self.rank[level][at[here]]
            left = left[~here]
        return out
