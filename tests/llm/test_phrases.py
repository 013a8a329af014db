"""Collocations against counts in plain Python, whatever the blocks."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import phrases

SEP = r"[.,;:!?\x0A-\x0D]"


def _expected(rows, least, top, inside=50):
    count = defaultdict(Counter)
    for lang, text in rows:
        for piece in re.split(SEP, (text or "").encode().lower().decode()):
            w = re.findall(r"[^\x20\x09]+", piece)
            for k in (1, 2, 3):
                count[lang or "und"].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, f in count.items():
        n, found = sum(v for k, v in f.items() if len(k) == 1), []
        often = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        longer = Counter()
        for p, a in often.items():
            if len(p) == 3:
                for q in (p[:2], p[1:]):
                    longer[q] = max(longer[q], a)
        for p, a in often.items():
            if 100 * longer[p] >= inside * a:
                continue
            score, _, l, r = min((1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), l, r))
        out += [(lang, i, p.decode(), -a, l, r, n, -s) for i, (s, a, p, l, r) in enumerate(sorted(found)[:top], 1)]
    return sorted(out)


def _rows(seed, n):
    rnd = random.Random(seed)
    words = ["the", "The", "of", "é", "new", "york", "city", "a", "<x>", "日本", "b-c", "1", "É"]
    make = lambda: "".join(rnd.choice(words) + rnd.choice([" "] * 8 + ["  ", "\t", ". ", "\n", "\r", "\x0b", "?!"]) for _ in range(rnd.randint(0, 60)))
    rows = [(rnd.choice(["en", "fr", None, "und"]), make()) for _ in range(n)]
    return rows + [("en", None), (None, ""), ("xx", " \t "), ("xx", "..\n"), ("en", "new york city " * 3000), ("de", "lonely words here")] + [("fr", "same copy of a row")] * 15


@pytest.mark.parametrize("block_bytes,least,top", [(4 << 20, 10, 2000), (200, 10, 2000), (1, 4, 30), (3000, 1, 50)])
def test_collocations(spark, block_bytes, least, top):
    rows = _rows(block_bytes, 150)
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(7).select("*", F.lit(1).alias("block"), F.lit(None).cast("long").alias("doc_id"), F.lit(2).alias("word"))
    got = phrases.collocations(docs, least, top, block_bytes=block_bytes).collect()
    assert sorted(map(tuple, got)) == _expected(rows, least, top)


def test_no_phrases(spark):
    assert phrases.collocations(spark.createDataFrame([], "lang string, text string")).collect() == []
    assert phrases.collocations(spark.createDataFrame([("en", None), ("en", "once only")], "lang string, text string")).collect() == []


def test_exact_beyond_64_bits(spark):
    """Products of counts pass 64 bits long before 10**15."""
    big = 9 * 10**14
    df = spark.createDataFrame([(big, big + 7, big + 11)], "a long, l1 long, r1 long").select(phrases._scored([("l1", "r1")]).alias("c"))
    assert df.first().c.score == 1_000_000 * big * big // ((big + 7) * (big + 11))


def test_places_pack_and_extend():
    words, counts, codes = phrases.block_of([b"b a  a\n\nb", b"", b"a"])
    assert words.to_pylist() == ["a", "b"] and counts.tolist() == [3, 2] and codes.tolist() == [1, 0, 0, -1, 1, -1, 0]
    assert (phrases._unpacked(phrases._packed(codes), len(codes)) == codes).all()
    at = np.flatnonzero(codes >= 0)
    first, second, end = phrases.extend(at, codes[at], at, codes[at])
    assert list(zip(first, second, end)) == [(1, 0, 1), (0, 0, 2)]
