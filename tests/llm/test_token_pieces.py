"""The encoder's cuts: no token crosses one, and spellings that the vocabulary doesn't tell apart are encoded once."""

from __future__ import annotations

import random

import numpy as np
import pytest

from tests.llm import brute
from tidegraph.llm import tokens

VOCABULARIES = ["byte_bpe_50k.json", "word_bpe_49k.json"]
#: Beside each other: classes of bytes, white space outside ASCII, marks that compose (also only under small letters), letters that grow in lower case.
PARTS = ["a", "the", "K", "T̈", "H̱", "É", "é", "́", "ß", "İ", "İ", "Ł", "ŝ", "×", "÷", "Ж", "но", "中文", "\U0001f600"]
PARTS += [" ", " ", "  ", "\n", "\n\n", " \n", "\t", "\r\n", "\x00", "\x1c", "\x85", "\xa0", " ", "᠎", " ", "​", " ", " ", " ", "　", "﻿"]
PARTS += ["1", "23", "١", "²", ".", ",", "?!,", "@", "-", "_", ";", "≮", "'", "'s", "'LL", "'re", "<|", "|>", "<|endoftext|>", "<|ENDOFTEXT|>", "<|startoftext|>"]


@pytest.mark.parametrize("vocabulary", VOCABULARIES)
def test_no_token_crosses_a_cut(monkeypatch, vocabulary):
    rng = random.Random(11)
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 14))) for _ in range(6000)]
    expected = [brute.ids(vocabulary, t) for t in texts]
    for window, chunk, memo, words in [(1 << 18, 1 << 20, 400_000, 500), (5, 12, 40, 2)]:  # and cut everywhere, with a memo that turns over
        for name, value in {"WINDOW": window, "CHUNK": chunk, "MEMO": memo, "WORDS": words}.items():
            monkeypatch.setattr(tokens, name, value)
        encoder = tokens.Encoder(tokens.path(vocabulary))
        for i in range(0, len(texts), 60):
            got = encoder.encode(texts[i : i + 60])
            assert [np.frombuffer(x, encoder.dtype).tolist() for x in got] == expected[i : i + 60]


@pytest.mark.parametrize("vocabulary", VOCABULARIES)
def test_words_are_learned_once(vocabulary):
    """With commas, brackets, digits or line feeds beside it, a word is no new piece."""
    encoder = tokens.Encoder(tokens.path(vocabulary))
    text = " ".join(f"(zyx{w}), zyx{w}; zyx{w}. +zyx{w}@1\nzyx{w}: zyx{w}7" for w in ("abc", "déf", "ghi"))
    assert np.frombuffer(encoder.encode([text])[0], encoder.dtype).tolist() == brute.ids(vocabulary, text)
    words = [k for k in (*encoder.memo.younger, *encoder.memo.older) if b"zyx" in k]
    assert len(words) == 6  # after a space and not
