"""Quality rules from tokeniser fertility, with rejection bands per language or script.

Per document, public vocabularies give: characters per token (byte-level vocabulary), the share of bytes that fall back to
single-byte tokens (vocabulary with byte fallback, asked once per character), and the entropy of its tokens. Documents with the same language (or, where none is
given, the same main script) and about the same number of tokens form a cell; a cell's quartiles, over all documents, give the
band of each measure: ``FENCE`` quartile distances beyond the quartiles, and ``SLACK`` at least. A cell of fewer than
``LEAST_CELL`` documents takes the quartiles of its language or script. A document outside a band is rejected, as is one that
fails the base rules.

* Null or empty text: all counts 0, measures 0, base_failed true, kept false.
* Repeated rows and ids: each row is judged for itself. A null id stays null.
* A null or empty language: the script of most letters stands in, ``none`` without letters.
* Other columns are not carried. An empty table gives an empty table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hackstand.llm.common import if_small, store, text_slices
from hackstand.llm.tokens import encoder, vocabulary
from hackstand.llm.words import Words, ngrams

FENCE = 1.5
#: Documents that a cell needs for quartiles of its own.
LEAST_CELL = 20
LEAST_WORDS, MOST_REPEATED = 50, 50
#: Least distance of a band from the quartiles, for cells whose documents are nearly alike.
SLACK = {"chars_per_token": 0.25, "fallback_share": 0.02, "token_entropy": 0.25}

_SYMBOL = np.zeros(256, np.int64)
_SYMBOL[list(b"[#*$%&|<>]"[1:-1])] = 1
#: First code point of the blocks that tell scripts apart; fixed by Unicode.
SCRIPTS = ((0x0041, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0590, "hebrew"), (0x0600, "arabic"), (0x0900, "indic"), (0x0E00, "thai"),
           (0x1100, "hangul"), (0x1200, "other"), (0x1E00, "latin"), (0x2000, "other"), (0x3040, "kana"), (0x3400, "han"), (0xA000, "other"), (0xAC00, "hangul"), (0xD800, "other"))
_SCRIPT_STARTS = np.array([s for s, _ in SCRIPTS])

SCHEMA = ("doc_id long, lang string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_chars long, n_tokens long, "
          "chars_per_token double, fallback_share double, token_entropy double, script string")


def repeated_words(h: np.ndarray, n: int = 3) -> int:
    """Words inside windows of ``n`` words that stand in the text twice or more."""
    grams = ngrams(h, n)
    if not len(grams):
        return 0
    _, back, counts = np.unique(grams, return_inverse=True, return_counts=True)
    often = np.zeros(len(h), bool)
    more = np.flatnonzero(counts[back] > 1)
    for k in range(n):
        often[more + k] = True
    return int(often.sum())


def repeated_lines(text: bytes) -> int:
    seen: set[bytes] = set()
    count = 0
    for line in text.split(b"\n"):
        if line.split():
            count += line in seen
            seen.add(line)
    return count


class Fallback:
    """Bytes that a vocabulary with byte fallback spends on each character that it has no piece for; each character is asked once."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.spent = np.full(0x110000, -1, np.int8)
        self.scripts = (np.searchsorted(_SCRIPT_STARTS, np.arange(0x110000), "right") - 1).astype(np.int8)
        self.scripts[[c for c in range(0x80) if not chr(c).isalpha()]] = -1

    def bytes_spent(self, points: np.ndarray) -> np.ndarray:
        for c in np.unique(points[self.spent[points] < 0]):
            self.spent[c] = sum(self.model.is_byte(i) for i in self.model.encode(chr(c)))
        return self.spent[points]


_FALLBACK: dict[str, Fallback] = {}


def entropy(ids: np.ndarray) -> float:
    """Bits per token."""
    if not len(ids):
        return 0.0
    _, n = np.unique(ids, return_counts=True)
    return float(np.log2(len(ids)) - (n * np.log2(n)).sum() / len(ids))


def _measure(byte_vocab: str, fallback_vocab: str):
    names = [x.strip().split(" ")[0] for x in SCHEMA.split(",")]

    def run(batches):
        if fallback_vocab not in _FALLBACK:
            _FALLBACK[fallback_vocab] = Fallback(fallback_vocab)
        fallback = _FALLBACK[fallback_vocab]
        for batch in batches:
            for piece in text_slices(batch):
                texts = piece.column("text")
                ids, bounds = encoder(byte_vocab).encode(texts)
                words = Words(texts, lower=False)
                h = words.hashes()
                raw = words.raw.tobytes()
                points = np.frombuffer(raw.decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
                spent = np.append(0, np.cumsum(fallback.bytes_spent(points), dtype=np.int64))
                kinds = fallback.scripts[points]
                letter = np.append(0, np.cumsum((words.letters & 0xC0) != 0x80))[words.starts]
                char = np.append(0, np.cumsum((words.raw & 0xC0) != 0x80))[words.offsets]
                symbol = np.append(0, np.cumsum(_SYMBOL[words.raw]))[words.offsets]
                rows = []
                for k, own in enumerate(words.texts()):
                    text = raw[words.offsets[k] : words.offsets[k + 1]]
                    mine = ids[bounds[k] : bounds[k + 1]]
                    n, chars = len(mine), int(char[k + 1] - char[k])
                    own_kinds = kinds[char[k] : char[k + 1]]
                    count = np.bincount(own_kinds[own_kinds >= 0], minlength=len(SCRIPTS))
                    rows.append((own.stop - own.start, int(letter[own.stop] - letter[own.start]), int(symbol[k + 1] - symbol[k]), repeated_lines(text), repeated_words(h[own]),
                                 chars, n, chars / n if n else 0.0, int(spent[char[k + 1]] - spent[char[k]]) / max(1, len(text)), entropy(mine), SCRIPTS[int(count.argmax())][1] if count.any() else "none"))
                columns = [pa.array(c) for c in zip(*rows)]
                yield pa.RecordBatch.from_arrays([piece.column("doc_id"), piece.column("lang"), *[c.cast(pa.int64()) for c in columns[:7]], *[c.cast(pa.float64()) for c in columns[7:10]], columns[10]], names)

    return run


def measures(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str | None = "lang", byte_vocab: str | None = None, fallback_vocab: str | None = None) -> DataFrame:
    """The measures of every row."""
    lang = F.col(f"`{lang_col}`").cast("string") if lang_col else F.lit(None).cast("string")
    docs = df.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"), lang.alias("lang"))
    return docs.mapInArrow(_measure(byte_vocab or vocabulary(), fallback_vocab or vocabulary("piece_bpe_32k.model")), SCHEMA)


def judge(measured: DataFrame, fence: float = FENCE) -> DataFrame:
    """``measured`` with cell, base_failed, kept and the first reason for a rejection."""
    level = F.floor(F.log2(F.greatest(F.col("n_tokens"), F.lit(1)).cast("double"))).cast("int")
    name = F.when(F.coalesce("lang", F.lit("")) == "", F.concat(F.lit("script:"), "script")).otherwise(F.col("lang"))
    rows = measured.withColumn("cell", F.concat_ws("|", name, level))
    counted = rows.where("n_tokens > 0").withColumn("name", name)
    quartiles = lambda p: [F.percentile_approx(m, [0.25, 0.75], 2000).alias(f"{p}_{m}") for m in SLACK]
    # a row per language and power of two of the length: the sketches combine before the shuffle
    cells = counted.groupBy("name", "cell").agg(F.count("*").alias("n"), *quartiles("own"))
    wider = store(counted.groupBy("name").agg(*quartiles("all")), "languages")
    bands = cells.join(if_small(wider), "name").select("cell", *[F.when(F.col("n") < LEAST_CELL, F.col(f"all_{m}")).otherwise(F.col(f"own_{m}")).alias(f"q_{m}") for m in SLACK])
    joined = rows.join(if_small(store(bands, "bands")), "cell", "left")
    reasons = [F.when((F.col("n_words") < LEAST_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MOST_REPEATED), "base")]
    for m, slack in SLACK.items():
        low, high = F.col(f"q_{m}")[0], F.col(f"q_{m}")[1]
        wide = F.greatest((high - low) * fence, F.lit(slack))
        reasons.append(F.when((F.col(m) < low - wide) | (F.col(m) > high + wide), m))
    return joined.withColumn("reason", F.coalesce(*reasons)).withColumn("base_failed", F.coalesce(F.col("reason") == "base", F.lit(False))).withColumn(
        "kept", F.col("reason").isNull()).drop(*[f"q_{m}" for m in SLACK])


def apply_rules(df: DataFrame, **columns) -> DataFrame:
    return judge(store(measures(df, **columns), "fertility"))


def digest(df: DataFrame) -> DataFrame:
    return apply_rules(df).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
                                  "chars_per_token", "fallback_share", "token_entropy", "reason")
