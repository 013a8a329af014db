"""Fuzzy notices against edit distances of all runs of words."""

import random

import pytest

pytest.importorskip("ledgerloom.llm")
from ledgerloom.llm import licenses  # noqa: E402


def distances(notice, text):
    """Edit distance of the notice to each prefix of text."""
    row = list(range(len(text) + 1))
    last = row
    for i, a in enumerate(notice, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(last[j] + 1, new[-1] + 1, last[j - 1] + (a != b)))
        last = new
    return last


def places(flat, notice, k):
    """(start, end, edits) of all runs of words within k edits of the notice."""
    spaces = [i for i, c in enumerate(flat) if c == " "]
    out = []
    for s in spaces[:-1]:
        part = flat[s + 1 : s + 1 + len(notice) + k + 1]
        d = distances(notice, part)
        out += [(s + 1, s + 1 + n, d[n]) for n in range(1, len(part)) if part[n] == " " and d[n] <= k]
    return out


def edited(rng, text, n):
    for _ in range(n):
        i = rng.randrange(len(text))
        text = rng.choice([text[:i] + text[i + 1 :], text[:i] + rng.choice("abc ") + text[i:], text[:i] + rng.choice("xyz") + text[i + 1 :]])
    return text


def test_all_places_within_the_bound():
    rng = random.Random(8)
    notices = dict(list(licenses.NOTICES.items())[:7]) | {"all rights reserved": "proprietary", "mozilla public license": "mpl"}
    hits = 0
    for _ in range(60):
        parts = [edited(rng, n, rng.randrange(0, licenses.allowed(n) + 2)) for n in rng.sample(list(notices), 3)]
        words = [w for p in parts for w in (rng.choice(["ball", "x", "the license", ""]), p)]
        got = licenses.scan(" ".join(words), notices)
        flat = " " + " ".join(licenses.WORD.findall(" ".join(words))) + " "
        for notice, label in notices.items():
            want = places(flat, notice, licenses.allowed(notice))
            for start, end, edits in want:  # each place is reported, or gives way to an overlapping one of no more edits
                assert any(s[0] == label and s[2] < end and s[3] > start and s[4] <= edits for s in got["spans"]), (notice, flat)
            hits += bool(want)
        for label, word, start, end, edits in got["spans"]:
            assert flat[start - 1] == flat[end] == " " and flat[:start].count(" ") - 1 == word
            assert any((start, end, edits) in places(flat, n, licenses.allowed(n)) for n, b in notices.items() if b == label)
    assert hits > 100


def test_words_are_whole():
    assert licenses.scan("ball rights reserved")["spans"] == [] or licenses.scan("ball rights reserved")["score"] < 1
    assert licenses.scan("overall rights reservedly")["labels"] == []
