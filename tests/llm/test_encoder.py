"""The encoder's pieces against the tokenizer on whole texts."""

from __future__ import annotations

import random

import numpy as np
import pytest

from tallymark.llm import tokens
from tallymark.llm.tokens import BYTE_BPE, WORD_BPE, Encoder, path

ODD = [
    "", " ", "  a b", "a\n b", "a ", "tab\tx y\n", "　x 　y", "Ab. CD, e.f. X..,", "ab. ab, AB. 7. 'S. it's I'LL",
    "<|endoftext|> x", "x <|endoftext|>y", "\0a \0 b", "a \1b", "\2" + "3 x", "é ́x Á.", "İ ſ K.", "x" * 3000 + " y.",
]


@pytest.mark.parametrize("name", [BYTE_BPE, WORD_BPE])
def test_ids_are_the_tokenizers_own_whatever_is_kept(name, monkeypatch):
    draw = random.Random(5)
    words = ["".join(draw.choices("abcdeéßÄÑ.,'\n17😀", k=draw.randint(1, 7))) for _ in range(3000)]
    texts = [" ".join(draw.choices(words, k=40)) for _ in range(300)] + ODD
    monkeypatch.setattr(tokens, "KEPT_BYTES", 20_000)  # makes room many times
    encoder = Encoder(path(name))
    assert len(encoder.encode([])[0]) == 0
    for start in range(0, len(texts), 50):
        block = texts[start : start + 50]
        ids, offsets = encoder.encode(block)
        for text, a, b in zip(block, offsets[:-1], offsets[1:], strict=True):
            assert ids[a:b].tolist() == encoder._full(text), text
    assert len(encoder.keys) == len(encoder.times) == len(encoder.first) - 1
    assert not any(key.startswith("\2") or len(key.encode()) > tokens.SHORT for key in encoder.keys.to_pylist())


def test_a_tokenizer_without_the_shortcuts_gives_the_same_ids():
    encoder = Encoder(path(BYTE_BPE))
    encoder.separator, encoder.marked, encoder.same_case = [], "[^\\s\\S]", False
    ids, offsets = encoder.encode(ODD)
    assert np.array_equal(ids, np.concatenate([np.array(encoder._full(t), np.int64) for t in ODD]))
    assert len(offsets) == len(ODD) + 1


@pytest.mark.parametrize("name,between", [(BYTE_BPE, False), (WORD_BPE, True)])
def test_new_pieces_are_joined_without_a_mark_where_ids_show_the_space(name, between, monkeypatch):
    """A mark after each piece doubled what the byte-level tokenizer had to read."""
    encoder, given = Encoder(path(name)), []
    each = encoder._each
    monkeypatch.setattr(encoder, "_each", lambda texts: given.extend(texts) or each(texts))
    texts = ["here one two three words, 17 of them. É\tb \"c\" d's .e", "f words g"] + ODD
    ids, offsets = encoder.encode(texts)
    for text, a, b in zip(texts, offsets[:-1], offsets[1:], strict=True):
        assert ids[a:b].tolist() == encoder._full(text), text
    joined = [t for t in given if " one two three " in t.replace(f" {tokens.NUL} ", " ")]
    assert joined and all((tokens.NUL in t) == between for t in joined)


def test_pieces_whose_ids_do_not_show_the_space_are_encoded_one_by_one():
    encoder = Encoder(path(BYTE_BPE))
    encoder.spaced = np.zeros_like(encoder.spaced)
    ids, _ = encoder.encode(ODD)
    assert np.array_equal(ids, np.concatenate([np.array(encoder._full(t), np.int64) for t in ODD]))
    encoder = Encoder(path(BYTE_BPE))
    encoder.spaced, encoder.separator = None, []
    assert np.array_equal(encoder.encode(ODD)[0], ids)


def test_only_texts_that_may_hold_space_before_a_space_are_searched(monkeypatch):
    """Every text was searched space by space."""
    searched = []

    class Search:
        def search(self, text, found=tokens.BEFORE_SPACE):
            searched.append(text)
            return found.search(text)

    monkeypatch.setattr(tokens, "BEFORE_SPACE", Search())
    spaces = [f"a{chr(c)} b" for c in range(0x110000) if chr(c).isspace()] + ["x\x01", "\x02"]
    plain = ["two words\n and É é.", "", "ends ", " begins", "one\nline"]
    encoder = Encoder(path(BYTE_BPE))
    texts = [t for pair in zip(spaces, plain * len(spaces), strict=False) for t in pair] + ODD
    ids, offsets = encoder.encode(texts)
    for text, a, b in zip(texts, offsets[:-1], offsets[1:], strict=True):
        assert ids[a:b].tolist() == encoder._full(text), text
    assert set(spaces) <= set(searched) and not set(searched) & set(plain[1:])
