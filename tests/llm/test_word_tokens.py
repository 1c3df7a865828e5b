"""The words that the packing tokeniser remembers."""

from __future__ import annotations

import numpy as np
import public_tokenizers
import pytest

from gapwise.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture
def tokens(monkeypatch):
    monkeypatch.setattr(packing, "CACHED_WORDS", 8)
    return packing.WordTokens(PATH)


def test_a_word_in_use_is_encoded_once(tokens, monkeypatch):
    encoded = []
    learn = tokens._learn_stems
    monkeypatch.setattr(tokens, "_learn_stems", lambda stems: (encoded.extend(stems), learn(stems)))
    for k in range(20):
        tokens.of(["common " + " ".join("abcdefghij"[k % 10] * (n + 1) + "xyz"[k % 3] * 3 for n in range(4))])
    assert encoded.count("common") == 1
    assert len(tokens._ids) + len(tokens._older_ids) < 3 * packing.CACHED_WORDS


def test_ids_are_those_of_whole_texts(tokens):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(PATH)
    texts = ["", " ", "The THE the, Straße STRASSE İstanbul J̌ ǰ", "a\n\nb  c. don't DON'T 12,5 x..! ÀÉ àé É", "K K k\tTab"] * 3
    found = [np.frombuffer(ids, "<u4").tolist() for ids in tokens.of(texts)]
    assert found == [whole.encode(t, add_special_tokens=False).ids for t in texts]


def test_groups_are_bounded_by_letters_and_number():
    texts = ["x" * packing.LETTERS_AT_ONCE] * 2 + ["y"] * (packing.TEXTS_AT_ONCE + 1)
    groups = list(packing._groups(texts))
    assert groups[:2] == [(0, 1), (1, 2)] and groups[-1][1] == len(texts)
    assert all(j - i <= packing.TEXTS_AT_ONCE and (j - i == 1 or sum(map(len, texts[i:j])) <= packing.LETTERS_AT_ONCE) for i, j in groups)
    assert not list(packing._groups([]))
