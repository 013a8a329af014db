"""Ids by kept words against the library on whole texts."""

import random

import pytest

pytest.importorskip("ledgerloom.llm")
from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

from ledgerloom.llm import queries, tokens  # noqa: E402

PIECES = ["don't", "it's", " we'LL", "  ", "\n\n ", "\t", "x²", "½", "٣", "naïve", "ß", "日本語", " 12 345", "_a_b", "<|endoftext|>", " !!?", "é", " ", " ", "\x1c", "😀", "Ⅷ", "'", "’s", "ªº", "\r\n", " ", "a"]


@pytest.fixture(scope="module")
def encoder():
    return tokens.Encoder(queries.TOKENIZER, most=50)


def same(encoder, texts):
    assert list(encoder(texts, at_once=7)) == encoder.library([t or "" for t in texts])


def test_mixed_pieces(encoder):
    rng = random.Random(0)
    same(encoder, ["".join(rng.choices(PIECES, k=rng.randrange(12))) for _ in range(600)] + [None, "", "", "word " * 50_000])


def test_every_character(encoder):
    same(encoder, [f"a{chr(c)}b {chr(c)} 1{chr(c)}" for c in range(0x3000) if not 0xD800 <= c < 0xE000])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.characters(exclude_categories=["Cs"])), max_size=5))
def test_any_text(encoder, texts):
    same(encoder, texts)
