"""The byte-context trie against prediction by partial matching written out symbol by symbol."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

pytest.importorskip("ledgerloom.llm")
from ledgerloom.llm import trie  # noqa: E402

ORDER = 4


def contexts(texts, order=ORDER):
    """Counts by context of 0 to `order` bytes."""
    seen = defaultdict(Counter)
    for t in texts:
        b = b"\xff" * order + t + b"\xff"
        for i in range(order, len(b)):
            for o in range(order + 1):
                seen[b[i - o : i]][b[i]] += 1
    return seen


def probability(seen, context, symbol, order=ORDER):
    """Walk down from the longest context; escape method C; what a longer context held is out of the running."""
    out, p = set(), 1.0
    for o in range(order, -1, -1):
        n = {s: c for s, c in seen.get(context[len(context) - o :], {}).items() if s not in out}
        total = sum(n.values()) + len(n)
        if symbol in n:
            return p * n[symbol] / total
        if n:
            p *= len(n) / total
            out |= set(n)
    return p / (256 - len(out))


def words(rng, letters, n):
    return ["".join(rng.choices(letters, k=rng.randrange(1, 30))).encode() for _ in range(n)]


def build(groups):
    codes = np.concatenate([trie.grams(t, ORDER) for g in groups for t in g] or [np.empty(0, np.int64)])
    which = np.array([i for i, g in enumerate(groups) for t in g for _ in range(len(t) + 1)], np.int64)
    return trie.Trie.build(trie.levels(codes, which, np.ones(len(codes), np.int64), len(groups), ORDER), ORDER)


def test_every_symbol_against_brute_force(tmp_path):
    rng = random.Random(1)
    groups = [words(rng, "aab c", 40), words(rng, "abé ", 30), words(rng, "xyz", 5)]
    (t,) = trie.load(build(groups).save(f"file://{tmp_path}/model"))
    tests = words(rng, "abcéx z", 40) + [b"", b"abc" * 200]
    for text in tests:
        got = t.logs(trie.grams(text, ORDER))
        b = b"\xff" * ORDER + text + b"\xff"
        for k, g in enumerate(groups):
            seen = contexts(g)
            want = [math.log10(probability(seen, b[i - ORDER : i], b[i])) for i in range(ORDER, len(b))]
            assert np.allclose(got[:, k], want, atol=1e-5)


def test_probabilities_sum_to_one():
    rng = random.Random(2)
    t = build([words(rng, "abcd ", 60), words(rng, "ab", 20)])
    for context in (b"abcd", b"a b ", b"zzzz", b"\xff\xffab", b"\xff" * 4):
        codes = np.array([int.from_bytes(context + bytes([s]), "big") for s in range(256)])
        assert np.allclose((10 ** t.logs(codes)).sum(0), 1, rtol=1e-5)


def test_nothing_learned():
    assert np.allclose(build([[], []]).logs(trie.grams(b"any", ORDER)), -math.log10(256))


def test_long_texts_by_parts():
    rng = random.Random(3)
    t = build([words(rng, "ab c", 50)])
    texts = [b"", b"ab c" * 50, b"a", b"zz" * 33]
    whole = np.array([t.logs(trie.grams(x, ORDER)).sum() for x in texts])
    for n in (1, 7, 64, 1000):
        assert np.allclose(t.totals(texts, n)[:, 0], whole)
        assert (np.concatenate([trie.grams(texts[1], ORDER, i, n) for i in range(0, 201, n)]) == trie.grams(texts[1], ORDER)).all()
