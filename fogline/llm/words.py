"""Words and word shingles of Arrow text columns as numpy arrays, without a Python object per word.

A word is a run of bytes other than space and ``\\x09-\\x0d``. All separators are ASCII, so the
bytes of UTF-8 text give the same words as its code points. NULL texts count as empty.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SEPARATORS = b" \t\n\x0b\x0c\r"
#: Text is hashed in pieces of about this many bytes, so one very long text needs no more memory.
PIECE = 1 << 20

_GAMMA = np.uint64(0x9E3779B97F4A7C15)


def mix(h: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _letters(lower: bool) -> np.ndarray:
    """A 64-bit value for each byte; A-Z get those of a-z when ``lower``."""
    with np.errstate(over="ignore"):
        values = mix((np.arange(256, dtype=np.uint64) + np.uint64(1)) * _GAMMA)
    if lower:
        values[65:91] = values[97:123]
    return values


LETTERS, LETTERS_LOWER = _letters(False), _letters(True)
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(SEPARATORS)] = True
_BASE = np.uint64(0x9FB21C651E98DF25)
with np.errstate(over="ignore"):
    _POWERS = np.cumprod(np.full(256, _BASE, np.uint64))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and the offset of each (one more than there are texts)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
    body = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return body[at[0] : at[-1]], at - at[0]


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and the number of the first word of each text."""
    inside = ~_IS_SPACE[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    texts = offsets[:-1][offsets[1:] > offsets[:-1]]
    first[texts] = inside[texts]
    ends = offsets[1:][offsets[1:] > offsets[:-1]] - 1
    last[ends] = inside[ends]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool) -> np.ndarray:
    """64-bit hash of each word."""
    letters = LETTERS_LOWER if lower else LETTERS
    out = np.empty(len(starts), np.uint64)
    if not len(starts):
        return out
    cuts = [0]
    while cuts[-1] < len(starts):
        cuts.append(max(cuts[-1] + 1, int(np.searchsorted(ends, starts[cuts[-1]] + PIECE))))
    with np.errstate(over="ignore"):
        for a, b in zip(cuts[:-1], cuts[1:]):
            s, e = starts[a:b], ends[a:b]
            size = e - s
            at = np.cumsum(size) - size
            place = np.arange(int(size.sum())) - np.repeat(at, size)
            long = int(size.max()) > len(_POWERS)
            power = np.cumprod(np.full(int(size.max()), _BASE, np.uint64)) if long else _POWERS
            values = letters[data[place + np.repeat(s, size)]] * power[place]
            out[a:b] = mix(np.add.reduceat(values, at) + size.astype(np.uint64) * _GAMMA)
    return out


def shingles(words: np.ndarray, first: np.ndarray, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every run of ``width`` words inside one text, and the text it is from.

    A text of fewer words has its whole sequence as one run; one without words has none.
    """
    count = np.diff(first)
    runs = np.where(count >= width, count - width + 1, np.minimum(count, 1))
    text = np.repeat(np.arange(len(count)), runs)
    start = np.arange(int(runs.sum())) - np.repeat(np.cumsum(runs) - runs, runs) + first[:-1][text]
    have = np.minimum(count[text], width)
    with np.errstate(over="ignore"):
        h = have.astype(np.uint64) * _GAMMA
        for k in range(width):
            inside = have > k
            at = np.minimum(start + k, max(len(words) - 1, 0))
            h = h + np.where(inside, words[at] if len(words) else 0, 0).astype(np.uint64) * _POWERS[k]
        return mix(h), text
