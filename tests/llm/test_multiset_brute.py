"""Multiset fingerprints and likenesses against plain Python: pieces, lanes, the next document, repeats and nulls."""

import hashlib
import math
import re

import numpy as np
import pytest

pytest.importorskip("ledgerloom.llm")
import xxhash  # noqa: E402

from ledgerloom.llm import multiset  # noqa: E402


def lanes(text):
    pieces = re.findall(r"[^.!?\n]{1,200}[.!?\n]*|[.!?\n]+", text)
    out = [0] * 128
    for p in pieces:
        bits = [xxhash.xxh64_intdigest(p.encode(), 42), xxhash.xxh64_intdigest(p.encode(), 42)]
        bits[1] = spark_hash_with_one(p)
        for i in range(128):
            out[i] += bits[i // 64] >> (i % 64) & 1
    return out, len(pieces)


def spark_hash_with_one(p):
    """xxhash64 of (text, 1): the text's hash is the seed of the number's."""
    seed = xxhash.xxh64_intdigest(p.encode(), 42)
    return xxhash.xxh64_intdigest((1).to_bytes(4, "little"), seed)


def form(text):
    """Two lanes a long: bit i of a hash in its lower half, bit i + 32 in its upper half."""
    sums, n = lanes(text)
    longs = [sums[64 * side + i] + (sums[64 * side + i + 32] << 32) for side in (0, 1) for i in range(32)]
    return "".join(f"{x:016x}" for x in [*longs, n])


def like(a, z):
    if form(a) == form(z):
        return 1.0
    (x, n), (y, m) = lanes(a), lanes(z)
    x, y = 2 * np.array(x, float) - n, 2 * np.array(y, float) - m
    size = math.sqrt((x @ x) * (y @ y))
    return 0.0 if size == 0 else max(0.0, min(1.0, float(x @ y) / size))


def brute(rows):
    sign = lambda t: (h := xxhash.xxh64_intdigest(t.encode(), 42)) - (h >> 63 << 64)
    rows = sorted(((d, t or "") for d, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, sign(r[1])), reverse=True)
    out = []
    for i, (d, t) in enumerate(rows):
        nxt = rows[(i + 1) % len(rows)][1]
        half = len(t) // 2
        edited = t[: len(t) - half] + nxt[:half]
        out.append((d, len(t), hashlib.sha256(edited.encode()).hexdigest(), form(t), form(edited), round(like(t, edited), 9), round(like(t, nxt), 9)))
    return sorted(out, key=repr)


def got(spark, rows):
    df = spark.createDataFrame([(d, t, "x", 1, 2) for d, t in rows], "doc_id long, text string, h string, c int, copies int")
    return sorted(((*r[:5], round(r[5], 9), round(r[6], 9)) for r in multiset.edited_fingerprints(df).collect()), key=repr)


ROWS = [(10**15, "One. Two! Three?\nFour"), (4, "é" * 500 + ".\n" + "x. " * 40), (3, None), (3, ""), (2, "a. b."), (2, "a. b."), (2, "a. b."), (2, "c"), (None, "null one. a. b."), (None, "null two"), (None, "null two"), (-5, "😀 end. " * 3), (0, "zero")]


def test_against_plain_python(spark):
    assert got(spark, ROWS) == brute(ROWS)
    for few in (ROWS[:1], ROWS[4:7], ROWS[8:9], [(1, None)]):
        assert got(spark, few) == brute(few)


def test_ranges_of_many_rows(spark):
    rows = [(i if i % 3 else None, f"text {i % 50}. part {i}.") for i in range(300)]
    assert got(spark, rows) == brute(rows)
