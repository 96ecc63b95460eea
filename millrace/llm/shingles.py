"""Sets of word shingles as sorted arrays of 64-bit hashes, made from whole batches of texts at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Words in a shingle.
WIDTH = 5
#: Bytes whose words are hashed at once; a segment ends between words.
SEGMENT = 1 << 20

_DRAW = np.random.Generator(np.random.PCG64(20240601))
_BYTES = _DRAW.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTES[65:91] = _BYTES[97:123]  # A-Z count as a-z
_FACTORS = _DRAW.integers(1, 1 << 63, WIDTH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHORT = _DRAW.integers(1, 1 << 63, WIDTH, dtype=np.uint64)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_BASE = 0x9E3779B97F4A7C15


def mixed(values: np.ndarray) -> np.ndarray:
    """Every bit of the input reaches every bit of the output."""
    values = (values ^ (values >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return values ^ (values >> np.uint64(33))


class _Powers:
    """Powers of an odd number and of its inverse, modulo 2^64, as far as needed."""

    def __init__(self):
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, SEGMENT)
            for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
                powers = np.full(size, base, dtype=np.uint64)
                powers[0] = 1
                setattr(self, name, np.multiply.accumulate(powers))
        return self.up[:n], self.down


_POWERS = _Powers()


def _segment_words(data: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of each word in ``data``; a word also ends at each of ``edges``."""
    solid = ~_SPACE[data]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    first[edges] = solid[edges]
    last = solid.copy()
    last[:-1] &= first[1:] | ~solid[1:]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last)
    up, down = _POWERS.upto(len(data))
    sums = np.cumsum(_BYTES[data] * up, dtype=np.uint64)
    before = np.where(starts > 0, sums[starts - 1], np.uint64(0))
    return starts, mixed((sums[ends] - before) * down[starts])


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of texts that lie one after the other, and where each text's words begin."""
    starts, hashes, at, total = [], [], 0, int(offsets[-1])
    inner = offsets[(offsets > 0) & (offsets < total)]
    while at < total:
        end = min(total, at + SEGMENT)
        while end < total and not _SPACE[data[end]]:
            step = np.flatnonzero(_SPACE[data[end : end + SEGMENT]])
            end = min(total, end + (int(step[0]) if len(step) else SEGMENT))
        edges = inner[np.searchsorted(inner, at) : np.searchsorted(inner, end)] - at
        where, values = _segment_words(data[at:end], edges)
        starts.append(where + at)
        hashes.append(values)
        at = end
    if not starts:
        return np.zeros(0, dtype=np.uint64), np.zeros(len(offsets), dtype=np.int64)
    return np.concatenate(hashes), np.searchsorted(np.concatenate(starts), offsets)


def shingle_set(words: np.ndarray) -> np.ndarray:
    """Distinct shingles of a text's words, sorted; all words as one where they are fewer."""
    n = len(words)
    if n == 0:
        return words
    if n < WIDTH:
        return mixed((words * _FACTORS[:n]).sum(dtype=np.uint64, keepdims=True) ^ _SHORT[n])
    total = words[: n - WIDTH + 1] * _FACTORS[0]
    for i in range(1, WIDTH):
        total = total + words[i : n - WIDTH + 1 + i] * _FACTORS[i]
    return np.unique(mixed(total))


def text_sets(texts: pa.Array) -> Iterator[np.ndarray]:
    """The shingle set of each text of a column without nulls."""
    wide = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, offsets, data = texts.buffers()
    places = np.frombuffer(offsets, dtype=wide)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    hashes, begins = word_hashes(raw[places[0] : places[-1]], places - places[0])
    for begin, end in zip(begins, begins[1:]):
        yield shingle_set(hashes[begin:end])
