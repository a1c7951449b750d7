"""Ids against the library on whole texts, with white space of every kind."""

import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from hackstand.llm.tokens import Encoder, encoder, vocabulary

LIBRARY = Tokenizer.from_file(vocabulary())


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from(" \n\t\r\x0b\x1c\x85\xa0　 aB'st<|endoftext|>é1½!Ġ"), st.characters(codec="utf-8"))), max_size=6))
def test_ids_equal_the_librarys(texts):
    texts = [*texts, None, "a <|endoftext|> b", "it's  fine "]
    ids, bounds = encoder(vocabulary()).encode(pa.array(texts, pa.string()))
    for k, text in enumerate(texts):
        assert ids[bounds[k] : bounds[k + 1]].tolist() == LIBRARY.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=500, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from(" \n\n\taBst'.,!$éÉ×÷ßЖ1½　\x85́"), st.characters(codec="utf-8")), max_size=40), max_size=6))
def test_ids_equal_the_librarys_at_marks_and_line_ends(texts):
    ids, bounds = encoder(vocabulary()).encode(pa.array(texts, pa.string()))
    for k, text in enumerate(texts):
        assert ids[bounds[k] : bounds[k + 1]].tolist() == LIBRARY.encode(text, add_special_tokens=False).ids


def test_a_word_is_learned_once_whatever_mark_follows():
    fresh = Encoder(vocabulary())
    fresh.encode(pa.array(["one word, a word.\nOne word; the déjà, the déjà!"]))
    assert sorted(fresh.kept) == sorted(x.encode() for x in ("one", " word", ",", " a", ".\n", "One", ";", " the", " déjà", "!"))
