"""Token ids of many texts with the public vocabulary of lower-cased words with word ends (tokenizers library).

No token of that vocabulary crosses white space, and none holds a letter and one of ``. , ; : ! ?`` together, so texts are cut
there and each distinct segment is encoded once. Segments of plain letters go to the library without its normaliser and
pre-tokeniser, which would leave them as they are; all others go through the whole tokenizer. The ids are those of
``Tokenizer.encode(text, add_special_tokens=False)`` on the whole text (tests/llm/test_tokens.py).
"""

from __future__ import annotations

import re
from array import array

import numpy as np
import pyarrow as pa

from hackstand.llm.common import kept
from hackstand.llm.tokens import KEPT_SEGMENTS, vocabulary
from hackstand.llm.words import raw_bytes

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_STOP = np.zeros(256, bool)
_STOP[list(b".,;:!?")] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Letters of ASCII and Latin-1: lower-casing one by one is all that the vocabulary's normaliser does to them.
_PLAIN = re.compile(rb"(?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+").fullmatch


def distinct(raw: np.ndarray, starts: np.ndarray) -> tuple[list[bytes], np.ndarray]:
    """The distinct byte strings among those that begin at ``starts`` and tile ``raw``, and the number of each string in order among them."""
    ends = np.append(starts, len(raw)).astype(np.int32)
    coded = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(raw))]).dictionary_encode()
    return coded.dictionary.to_pylist(), coded.indices.to_numpy()


def gather(values: list[bytes], codes: np.ndarray, kind=np.uint32) -> tuple[np.ndarray, np.ndarray]:
    """``values[code]`` of all codes end to end, and where each begins (one more at the end)."""
    flat = np.frombuffer(b"".join(values), kind)
    sizes = np.fromiter(map(len, values), np.int64, len(values)) // np.dtype(kind).itemsize
    firsts = np.cumsum(sizes) - sizes
    lengths = sizes[codes]
    bounds = np.append(0, np.cumsum(lengths))
    return flat[np.repeat(firsts[codes] - bounds[:-1], lengths) + np.arange(bounds[-1])], bounds


class WordEncoder:
    """One per worker and vocabulary file; see ``word_encoder``."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.whole, self.bare = Tokenizer.from_file(path), Tokenizer.from_file(path)
        self.bare.normalizer = None
        self.bare.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.kept: dict[bytes, bytes] = {}

    def _learn(self, segments: list[bytes]) -> None:
        kept = self.kept
        plain = [s for s in segments if _PLAIN(s)]
        for s, e in zip(plain, self.bare.encode_batch_fast([s.decode().lower() for s in plain], add_special_tokens=False)):
            kept[s] = array("I", e.ids).tobytes()
        rest = [s for s in segments if s not in kept]
        for s, e in zip(rest, self.whole.encode_batch_fast([s.decode() for s in rest], add_special_tokens=False)):
            kept[s] = array("I", e.ids).tobytes()

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids in order (uint32) and where each text's ids begin (one more at the end)."""
        raw, offsets = raw_bytes(texts)
        solid = ~_SPACE[raw]
        if not solid.any():
            return np.zeros(0, np.uint32), np.zeros(len(texts) + 1, np.int64)
        first = solid.copy()
        first[1:] &= ~solid[:-1] | (_LETTER[raw[:-1]] & _STOP[raw[1:]])
        inner = offsets[1:-1]
        inner = inner[inner < len(raw)]
        first[inner] = solid[inner]
        places = np.flatnonzero(first)
        raw, starts = raw[solid], np.flatnonzero(first[solid])
        if b"<|" not in raw.tobytes():  # where a special token may stand, case matters
            if (raw >= 0xC4).any():  # letters with combining signs may compose otherwise in lower case: those segments keep their case
                low = np.repeat(np.maximum.reduceat(raw, starts) < 0xC4, np.diff(np.append(starts, len(raw))))
                raw = np.where(low, _LOWER[raw], raw)
            else:
                raw = _LOWER[raw]
        segments, codes = distinct(raw, starts)
        kept = self.kept
        new = [s for s in segments if s not in kept]
        if len(kept) + len(new) > KEPT_SEGMENTS and len(new) < len(segments):
            kept.clear()
            new = segments
        self._learn(new)
        ids, bounds = gather([kept[s] for s in segments], codes)
        return ids, bounds[np.searchsorted(places, offsets)]


_ENCODERS: dict[str, WordEncoder] = kept()


def word_encoder(path: str | None = None) -> WordEncoder:
    path = path or vocabulary("word_bpe_49k.json")
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]
