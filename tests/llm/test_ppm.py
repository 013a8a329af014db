"""Scores and languages of the queries' operators against prediction by partial matching written out, learned from the same rows."""

import math
import random
import zlib

import pytest

pytest.importorskip("ledgerloom.llm")
from ledgerloom.llm import ppm, trie  # noqa: E402

from . import test_trie as brute  # noqa: E402


def log10(seen, text, order):
    b = b"\xff" * order + text + b"\xff"
    return sum(math.log10(brute.probability(seen, b[i - order : i], b[i], order)) for i in range(order, len(b)))


def rows(n=60):
    rng = random.Random(5)
    make = {"en": "the of and ", "fr": "le éau des ", "xx": "qzw Ab"}
    return [(i, "".join(rng.choices(make[k], k=rng.randrange(3, 60))), k) for i, k in enumerate(rng.choices(list(make), k=n))]


SCHEMA = "doc_id long, text string, lang string, score string, word string"


def test_scores(spark):
    data = rows() + [(90, None, "en"), (91, "", None), (None, "null id", "fr"), (92, "twice", "en"), (92, "twice", "en")]
    learned = [(t or "").lower().encode() for d, t, _ in data if d is None or zlib.crc32(str(d).encode()) % 7 != 2]
    seen = brute.contexts(learned, 5)
    got = ppm.score(spark.createDataFrame([(*r, "s", "w") for r in data], SCHEMA)).collect()
    assert len(got) == len(data)
    want = sorted(((d if d is not None else -1, round(log10(seen, (t or "").lower().encode(), 5), 3)) for d, t, _ in data))
    assert all(a[0] == z[0] and abs(a[1] - z[1]) < 0.01 for a, z in zip(sorted((r.doc_id if r.doc_id is not None else -1, round(r.score, 3)) for r in got), want))


def test_languages(spark):
    data = rows() + [(91, "the and", None), (92, "", "en"), (93, "1 2 3", "en"), (None, "le des", "fr"), (94, "é", "fr")]
    seen = {k: brute.contexts([t.lower().encode() for d, t, g in data if g == k and t is not None and (d is None or zlib.crc32(str(d).encode()) % 4 != 2)], 4) for k in ("en", "fr", "xx")}
    df = spark.createDataFrame([(*r, "s", "w") for r in data], SCHEMA)
    got = {(r.doc_id, r.lang): r for r in ppm.identify(df, ppm.fit_languages(df), ["doc_id", "lang"]).collect()}
    for d, t, g in data:
        r = got[d, g]
        if not any(map(str.isalpha, t)):
            assert (r.lang_pred, r.score) == ("und", 0.0)
            continue
        logs = {k: log10(s, t.lower().encode(), 4) for k, s in seen.items()}
        best = max(logs, key=lambda k: (logs[k], k))
        assert r.lang_pred == best and math.isclose(r.score, 1 / sum(10 ** (x - logs[best]) for x in logs.values()), rel_tol=1e-3)


def test_sample_is_bounded_and_spread(spark):
    df = spark.createDataFrame([(i % 3 or None, f"{'en word ' if i % 2 else 'mot fr '}{i} " * 400, "en" if i % 2 else "fr", "s", "w") for i in range(200)], SCHEMA)
    model = ppm.fit_languages(df, sample_bytes=40_000, passage=512)
    (t,) = trie.load(model.folders[0])
    assert model.names == ("fr", "en") and len(t.gram_keys) < 40_000
    got = ppm.identify(df, model, ["lang"]).collect()
    assert all(r.lang == r.lang_pred for r in got)


@pytest.mark.parametrize("together", [8, 3])
def test_every_language_counts(spark, together):
    """Forty languages, each with letters of its own, are all predicted, whatever the number of tries."""
    make = lambda k: "".join(chr(0x4E00 + 30 * k + (7 * j) % 30) + " " * (j % 5 == 0) for j in range(200))
    df = spark.createDataFrame([(None, make(k), f"l{k:02d}", "s", "w") for k in range(40) for _ in range(2)], SCHEMA)
    model = ppm.fit_languages(df, together=together)
    assert len(model.names) == 40 and len(model.folders) == -(-40 // together)
    assert all(r.lang == r.lang_pred for r in ppm.identify(df, model, ["lang"]).collect())


def test_all_grams_count(spark):
    """However few grams a worker's trie holds, the scores are the same: the others are looked up in the table."""
    data = rows(90) + [(200, None, "en"), (201, "", "en"), (202, "the " * 4000 + "né" * 300, "en"), (None, "null id", "fr")]
    df = spark.createDataFrame([(*r, "s", "w") for r in data], SCHEMA)
    key = lambda r: (-1 if r.doc_id is None else r.doc_id, r.n_tokens)
    want = {key(r): r for r in ppm.score(df, cached=1 << 40).collect()}
    for cached in (0, 60, 500):
        got = ppm.score(df, cached=cached).collect()
        assert len(got) == len(data) and all(math.isclose(r.score, want[key(r)].score, rel_tol=1e-5) and r.base_score == pytest.approx(want[key(r)].base_score) for r in got)
    assert ppm._least([(1, 50), (2, 30), (64, 5)], 40) == 2 and ppm._least([(1, 50)], 40) == 1 << 62 and ppm._least([], 40) == 1


def test_buckets_agree(spark):
    """Spark and numpy deal a gram to the same bucket, and a gram's suffixes of three context bytes or more go with it."""
    codes = trie.grams("what the né <quick> fox does".encode(), 5)
    df = spark.createDataFrame([(int(c),) for c in codes], "code long").select("code", ppm._bucket(df_code(), 13).alias("b"))
    assert all(r.b == ppm._bucket(codes[codes == r.code], 13)[0] for r in df.collect())
    assert (ppm._bucket(codes, 13) == ppm._bucket(codes & trie.mask(4), 13)).all()


def df_code():
    from pyspark.sql import functions as F

    return F.col("code")
