"""Words of many texts at once, as numpy arrays over the raw bytes of an Arrow column."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_BYTE_VALUE = np.random.default_rng(20240607).integers(0, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit (splitmix finaliser)."""
    with np.errstate(over="ignore"):
        x = x + np.uint64((seed * 0xD1342543DE82EF95 + 0x2545F4914F6CDD1D) & 0xFFFFFFFFFFFFFFFF)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def raw_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts and where each text begins (one more at the end). Null is empty."""
    if texts.null_count:
        texts = texts.fill_null("")
    texts = texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    if data is None or not len(texts):
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


class Words:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a slice of texts.

    ``letters``: bytes of all words without the space between; ``starts``: where each word begins there (one more at the
    end); ``bounds``: index of each text's first word (one more at the end).
    """

    def __init__(self, texts: pa.Array, lower: bool = True):
        raw, offsets = raw_bytes(texts)
        self.raw, self.offsets = raw, offsets
        if lower:
            raw = _LOWER[raw]
        solid = ~_SPACE[raw]
        first = solid.copy()
        first[1:] &= ~solid[:-1]
        inner = offsets[1:-1]
        inner = inner[inner < len(raw)]
        first[inner] = solid[inner]
        where = np.flatnonzero(first)
        self.letters = raw[solid]
        self.starts = np.append(np.flatnonzero(first[solid]), len(self.letters)).astype(np.int64)
        self.bounds = np.searchsorted(where, offsets)
        self.where = where

    def __len__(self) -> int:
        return len(self.starts) - 1

    def hashes(self) -> np.ndarray:
        """A 64-bit hash per word: a polynomial over random byte values, then mixed."""
        if not len(self):
            return np.zeros(0, np.uint64)
        lengths = np.diff(self.starts)
        place = np.arange(len(self.letters), dtype=np.int64) - np.repeat(self.starts[:-1], lengths)
        with np.errstate(over="ignore"):
            powers = np.full(int(lengths.max()) + 1, _STEP, np.uint64)
            powers[0] = 1
            powers = np.multiply.accumulate(powers)
            h = np.add.reduceat(_BYTE_VALUE[self.letters] * powers[place], self.starts[:-1])
            return mix(h + lengths.astype(np.uint64), 1)

    def array(self) -> pa.Array:
        """All words in order, as Arrow binary."""
        return pa.Array.from_buffers(pa.binary(), len(self), [None, pa.py_buffer(self.starts.astype(np.int32)), pa.py_buffer(self.letters)])

    def texts(self) -> list[slice]:
        return [slice(a, b) for a, b in zip(self.bounds[:-1], self.bounds[1:])]


def ngrams(h: np.ndarray, n: int, seed: int = 0) -> np.ndarray:
    """Hash of every run of ``n`` consecutive values; fewer values give none."""
    if len(h) < n:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        out = np.zeros(len(h) - n + 1, np.uint64)
        for k in range(n):
            out = out * np.uint64(0x100000001B3) + (h[k : len(h) - n + 1 + k] ^ (h[k : len(h) - n + 1 + k] >> np.uint64(17 + k)))
            out = out ^ (out >> np.uint64(29))
    return mix(out, seed + n)
