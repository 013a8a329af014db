"""Fuzzy search of short license notices: exact seeds, then bounded-error matching."""

from __future__ import annotations

import functools
import re

import ahocorasick
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
#: The contract's phrases.
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
#: Sentences of public license texts, as words.
NOTICES = {
    "gnu general public license": "gpl",
    "this program is free software you can redistribute it and or modify it under the terms of": "gpl",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "apache license": "apache",
    "licensed under the apache license": "apache",
    "unless required by applicable law or agreed to in writing software distributed under the license": "apache",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "released under the mit license": "mit",
    "redistribution and use in source and binary forms with or without modification are permitted": "bsd",
    "creative commons attribution": "cc-by",
    "mozilla public license": "mpl",
    "spdx license identifier": "spdx",
    "all rights reserved": "proprietary",
}


def allowed(notice: str) -> int:
    """Character edits allowed: one in twelve, at least one, at most six."""
    return max(1, min(6, len(notice) // 12))


@functools.lru_cache(maxsize=2)
def _engine(notices: tuple):
    seeds, patterns = {}, []
    for i, (text, label) in enumerate(notices):
        k = allowed(text)
        cut = [round(j * len(text) / (k + 1)) for j in range(k + 2)]
        for a, z in zip(cut, cut[1:]):
            seeds.setdefault(text[a:z], []).append((i, a))
        patterns.append((regex.compile(rf"(?b)(?<= )(?:{regex.escape(text, literal_spaces=True)}){{e<={k}}}(?= )"), text, label, k))
    auto = ahocorasick.Automaton()
    for s, places in seeds.items():
        auto.add_word(s, (len(s), places))
    auto.make_automaton()
    return auto, patterns


def scan(text: str | None, notices: dict[str, str] = NOTICES) -> dict:
    """Words, base places, and verified spans (label, first word, start and end in the words joined by spaces, edits) of one whole text.

    A span begins and ends with a word. Of places of one notice that overlap, the one of fewest edits counts, the first of equals; spans of
    different notices may overlap.
    """
    words = WORD.findall((text or "").encode().lower().decode())
    flat = " " + " ".join(words) + " "
    places = []
    for phrase, label in BASE.items():
        at = flat.find(f" {phrase} ")
        while at >= 0:
            places.append((at, label))
            at = flat.find(f" {phrase} ", at + 1)
    auto, patterns = _engine(tuple(notices.items()))
    seen: dict[int, list[tuple[int, int]]] = {}
    for end, (n, where) in auto.iter(flat):
        for i, a in where:
            _, notice, _, k = patterns[i]
            start = end - n + 1 - a  # of the notice, if nothing in front of the seed was edited
            seen.setdefault(i, []).append((max(0, start - k - 1), min(len(flat), start + len(notice) + k + 1)))
    spans = []
    for i, found in seen.items():
        p, notice, label, k = patterns[i]
        windows: list[list[int]] = []
        for lo, hi in sorted(found):
            if windows and lo <= windows[-1][1]:
                windows[-1][1] = max(hi, windows[-1][1])
            else:
                windows.append([lo, hi])
        for lo, hi in windows:
            left = [(lo, hi)]
            while left:  # the best place of a stretch first, then what lies before and behind it
                lo, hi = left.pop()
                if (m := p.search(flat, lo, hi)) is None:
                    continue
                left += [(lo, m.start()), (m.end(), hi)]
                spans.append((label, m.start(), m.end(), sum(m.fuzzy_counts), 1 - sum(m.fuzzy_counts) / len(notice)))
    marks = sorted({a for a, _ in places} | {s[1] for s in spans})
    number, before, at = {}, 0, 0
    for x in marks:  # word number at each place, in one walk
        before += flat.count(" ", at, x)
        number[x], at = before, x
    starts = sorted(number[a] for a, _ in places)
    return {
        "n_words": len(words), "n_base": len(places), "first_word": starts[0] if starts else None, "last_word": starts[-1] if starts else None,
        "base": sorted({b for _, b in places}), "labels": sorted({b for _, b in places} | {s[0] for s in spans}),
        "score": 1.0 if places else max((s[4] for s in spans), default=0.0),
        "spans": sorted((s[0], number[s[1]] - 1, s[1], s[2], s[3]) for s in spans),
    }


def license_scan(docs: DataFrame, notices: dict[str, str] = NOTICES) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans (label, word, start, end in the joined words, edits).

    Null or empty text: no words, no labels, score 0. Repeated rows each return. Empty table: no rows. Texts are scanned whole.
    Other columns of docs are not read, whatever their names.
    """

    def run(frames):
        for f in frames:
            got = [scan(t, notices) for t in f.text]
            yield pd.DataFrame(
                {
                    "doc_id": f.doc_id.astype("Int64"), "n_words": [g["n_words"] for g in got], "n_base": [g["n_base"] for g in got],
                    "first_word": pd.array([g["first_word"] for g in got], "Int64"), "last_word": pd.array([g["last_word"] for g in got], "Int64"),
                    "base_labels": [",".join(g["base"]) for g in got], "labels": [",".join(g["labels"]) for g in got], "score": [g["score"] for g in got],
                    "spans": [[dict(zip(("label", "word", "start", "end", "edits"), s)) for s in g["spans"]] for g in got],
                }
            )

    out = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, spans array<struct<label:string,word:long,start:long,end:long,edits:long>>"
    return docs.select(F.col("doc_id").cast("long"), "text").mapInPandas(run, out)
