"""BPE against the tokenizers library, text by text."""

import random

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from lexiloom.llm import bpe, byte_tokens

WORDS, BYTES = (public_tokenizers.path(n) for n in ("word_bpe_49k.json", "byte_bpe_50k.json"))
word_library, byte_library = Tokenizer.from_file(WORDS), Tokenizer.from_file(BYTES)


def same(text):
    want = word_library.encode(text, add_special_tokens=False).ids
    got = next(bpe.Coder(bpe.merges_of(WORDS)).code([text]))
    assert (got.n_tokens, got.ids_text) == (len(want), " ".join(map(str, want)))
    assert got.decoded == word_library.decode(want, skip_special_tokens=False)
    assert byte_tokens.ids_of(BYTES, text).tolist() == byte_library.encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.characters(exclude_categories=["Cs", "Cn"]), max_size=60))
def test_any_text(text):
    same(text)


@pytest.mark.parametrize("text", ["", " ", "aaaaaaaaaaaaaaaaaaaaa", "ab" * 2000, "don't I'LL 's'students", "ΑΣ Σ", "a\x1cb\x85c",
                                  "<|endoftext|>x<|startoftext|> <|endoftext|>", " \n" * 5000, "x" * 100_000])
def test_chosen_texts(text):
    same(text)


def test_merges_do_not_depend_on_company(rows):
    """Encoding all texts of a batch at once, in any order and with a forgetful coder, changes nothing."""
    texts = [r[1] for r in rows]
    random.Random(3).shuffle(texts)
    coder = bpe.Coder(bpe.merges_of(WORDS))
    together = list(coder.code(texts))
    coder.forget()
    for text, coded in zip(texts, together):
        assert next(coder.code([text])) == coded


def test_documents(documents, rows, nothing):
    found = sorted(map(str, bpe.encode(documents, WORDS).select("doc_id", "ids").collect()))
    want = [(r[0], word_library.encode(r[1] or "", add_special_tokens=False).ids) for r in rows]
    assert found == sorted(f"Row(doc_id={i}, ids={ids})" for i, ids in want)
    assert bpe.encode(nothing, WORDS).count() == 0
