"""Token ids of many texts with a public byte-level vocabulary of the tokenizers library.

The vocabulary's own pre-tokeniser never lets a token cross a space that is followed by something else than white space, so
a text is cut there, between a letter and an ASCII mark and after a lone line end, and each distinct segment is encoded once by the
library; ids are then gathered as arrays. The ids are those of ``Tokenizer.encode(text, add_special_tokens=False)`` on the whole text (tests/llm/test_tokens.py).
"""

from __future__ import annotations

from array import array

import numpy as np
import pyarrow as pa

from hackstand.llm.common import kept
from hackstand.llm.words import raw_bytes

#: Segments whose ids a worker keeps; beyond, it forgets and starts anew. Bounds memory only.
KEPT_SEGMENTS = 600_000

#: Fixed by the vocabulary's format: how text is cut into pieces, and the sign that stands for each byte.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_PLAIN = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTE_SIGNS = {b: b for b in _PLAIN} | {b: 256 + n for n, b in enumerate(sorted(set(range(256)) - set(_PLAIN)))}

_SURE = np.ones(256, bool)  # bytes that cannot begin white space in any reading
_SURE[[*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0xC2, 0xE1, 0xE2, 0xE3]] = False
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_MARK = np.zeros(256, bool)
_MARK[[b for b in range(0x21, 0x7F) if not chr(b).isalnum()]] = True
_SEEN = np.zeros(256, bool)  # bytes of ASCII that are not white space
_SEEN[0x21:0x7F] = True


def _cuts(raw: np.ndarray, whole_specials: bool) -> np.ndarray:
    """Where a segment begins: places that the pre-tokeniser cuts whatever stands around them.

    Its only look-ahead is at white space, so beside the space before a sign these are a letter's end before an ASCII mark, and what
    follows a line end that stands alone. ``whole_specials``: a special string stands in the bytes, which marks must not cut.
    """
    cut = np.zeros(len(raw), bool)
    sure = _SURE[raw]
    cut[:-1] = (raw[:-1] == 0x20) & sure[1:]
    if not whole_specials:
        letter = _LETTER[raw]
        letter[1:] |= (raw[:-1] == 0xC3) & (raw[1:] != 0x97) & (raw[1:] != 0xB7)  # U+00C0 to U+00FF without the two signs
        cut[1:] |= letter[:-1] & _MARK[raw[1:]]
        line = raw == 0x0A
        cut[2:] |= _SEEN[raw[:-2]] & line[1:-1] & sure[2:]
    return cut


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """One per worker and vocabulary file; see ``encoder``."""

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.model, self.pieces_of = self.whole.model, regex.compile(PIECES).findall
        self.specials = [t.content.encode() for t in self.whole.get_added_tokens_decoder().values()]
        self.kept: dict[bytes, bytes] = {}
        self.tails: dict[str, list[int]] = {}

    def _learn(self, segments: list[bytes]) -> None:
        plain = []
        joined = b"\n".join(segments)
        specials = [x for x in self.specials if x in joined]
        tokenize, tails, kept = self.model.tokenize, self.tails, self.kept
        space = chr(BYTE_SIGNS[0x20])
        for s in segments:
            if s.isalpha():  # ASCII letters alone are one piece
                kept[s] = array("I", [t.id for t in tokenize(s.decode())]).tobytes()
            elif s[:1] == b" " and s[1:].isalpha():
                kept[s] = array("I", [t.id for t in tokenize(space + s[1:].decode())]).tobytes()
            elif s[:1] != b" " or len(s) < 2 or not _SURE[s[1]] or s.find(b" ", 1) >= 0 or any(x in s for x in specials):
                kept[s] = array("I", self.whole.encode(s.decode(), add_special_tokens=False).ids).tobytes()
            else:
                plain.append(s)
        found = self.pieces_of(b"".join(plain).decode())
        ids: list[int] = []
        n = -1
        for piece in found:
            if piece[0] == " ":  # only a segment's first piece begins with a space
                if n >= 0:
                    kept[plain[n]] = array("I", ids).tobytes()
                n += 1
                ids = [t.id for t in tokenize(piece.encode().decode("latin-1").translate(BYTE_SIGNS))]
            else:
                got = tails.get(piece)
                if got is None:
                    got = tails[piece] = [t.id for t in tokenize(piece.encode().decode("latin-1").translate(BYTE_SIGNS))]
                ids = ids + got
        if n >= 0:
            kept[plain[n]] = array("I", ids).tobytes()

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids in order (uint32) and where each text's ids begin (one more at the end)."""
        raw, offsets = raw_bytes(texts)
        if not len(raw):
            return np.zeros(0, np.uint32), np.zeros(len(texts) + 1, np.int64)
        body = raw.tobytes()
        cut = _cuts(raw, any(x in body for x in self.specials))
        inner = offsets[:-1][np.diff(offsets) > 0]
        cut[inner] = True
        starts = np.flatnonzero(cut)
        ends = np.append(starts, len(raw)).astype(np.int32)
        coded = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(body)]).dictionary_encode()
        places = np.frombuffer(coded.dictionary.buffers()[1], np.int32)[: len(coded.dictionary) + 1].tolist()
        letters = coded.dictionary.buffers()[2].to_pybytes()
        segments = [letters[a:b] for a, b in zip(places, places[1:])]
        kept = self.kept
        known = list(map(kept.get, segments))
        new = [s for s, k in zip(segments, known) if k is None]
        if new:
            if len(kept) + len(new) > KEPT_SEGMENTS and len(new) < len(segments):
                kept.clear()
                self.tails.clear()
                new = segments
            self._learn(new)
            known = list(map(kept.get, segments))
        flat = np.frombuffer(b"".join(known), np.uint32)
        sizes = np.fromiter(map(len, known), np.int64, len(known)) // 4
        firsts = np.cumsum(sizes) - sizes
        at = coded.indices.to_numpy()
        lengths = sizes[at]
        begin = np.cumsum(lengths) - lengths
        total = int(lengths.sum())
        ids = flat[np.repeat(firsts[at] - begin, lengths) + np.arange(total)]
        bounds = np.append(begin, total)[np.searchsorted(starts, offsets)]
        return ids, bounds


_ENCODERS: dict[str, Encoder] = kept()


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]
