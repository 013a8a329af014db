"""Each operator against brute force, round trips or held-out accuracy, and on nulls, empties, ties, repeats and clashing columns."""

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import pandas as pd
import pytest

pytest.importorskip("ledgerloom.llm")
from ledgerloom.llm import collisions, licenses, mixing, multiset, packing, ppm, queries, records, sharding, simhash  # noqa: E402

SF = "/root/testdata/sf0.001"
ODD = [(1, None, None, None), (2, "", "en", "a"), (3, "a b", "en", None), (3, "a b", "en", None), (None, "!!! 123", None, "a"), (5, "lorem ipsum dolor " * 20_000, "en", "b"), (6, "MIT License, GNU General Public License", "en", "b")]
SCHEMA = "doc_id long, text string, lang string, source string, score double, label string, size string, shard string"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").cache()


@pytest.fixture(scope="module")
def pdf(docs):
    return docs.toPandas()


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(*r, 0.5, "x", "x", "x") for r in ODD], SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def ids(texts, end):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(queries.TOKENIZER)
    return [t.encode(x or "", add_special_tokens=False).ids + [end] for x in texts]


def crc(x):
    return zlib.crc32(np.array(x, "<u4").tobytes())


def parts(group, a=1):
    up = {k: k for k in group}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for k, others in group.items():
        for o in others:
            p, q = sorted((root(k), root(o)))
            up[q] = p
    return {k: root(k) for k in group}


def test_packing_covers_every_id_once(spark, docs, pdf, odd, none):
    got = packing.pack(docs, queries.TOKENIZER).toPandas()
    want = dict(zip(pdf.doc_id, ids(pdf.text, 1)))
    for doc, g in got.groupby("doc_id"):
        g, at = g.sort_values("start"), 0
        for r in g.itertuples():
            assert r.start == at and r.ids_crc32 == crc(want[doc][at : at + r.length]) and r.doc_tokens == len(want[doc])
            at += r.length
        assert at == len(want[doc])
    for _, g in got.sort_values("offset").groupby("sequence_id"):
        assert list(g.offset) == [0, *g.length.cumsum()[:-1]] and g.length.sum() <= 2048
    assert got.length.sum() / (2048 * got.sequence_id.nunique()) > 0.93
    o = packing.pack(odd, queries.TOKENIZER).toPandas()
    assert o[o.start == 0].doc_tokens.sum() == sum(map(len, ids([r[1] for r in ODD], 1))) and packing.pack(none, queries.TOKENIZER).count() == 0


def test_harmonic_classes():
    where, offset = packing.fill(np.array([1024] * 4 + [600] * 3 + [20]), 2048)
    assert collections.Counter(where[:4]) == {where[0]: 2, where[2]: 2} and len(set(where[4:7])) == 1 and sum(packing.cuts(5000, 2048)) == 5000


def test_simhash_components(docs, pdf, odd, none):
    import xxhash

    def slow(text):
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        h = [xxhash.xxh64_intdigest(" ".join(w[i : i + 3]).encode(), 42) for i in range(max(1, len(w) - 2))] if w else []
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))

    got = simhash.simhash_components(docs).toPandas().set_index("doc_id")
    fp = {d: slow(t) for d, t in zip(pdf.doc_id, pdf.text)}
    want = parts({d: [e for e in fp if (fp[d] ^ fp[e]).bit_count() <= 3] for d in fp})
    assert got.fingerprint.to_dict() == {d: f"{x:016x}" for d, x in fp.items()} and got.component_id.to_dict() == want
    o = simhash.simhash_components(odd).toPandas()
    assert len(o) == len(ODD) and set(o[o.fingerprint == "0" * 16].component_id) == {1} and simhash.simhash_components(none).count() == 0


def test_meet_in_the_middle_finds_every_pair_within_three():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
    for n in (1, 2, 3):
        b = a.copy()
        for i in range(len(b)):
            for bit in rng.choice(64, n, replace=False):
                b[i] ^= np.uint64(1 << int(bit))
        assert all(set(x) & set(y) for x, y in zip(simhash.variants(a).tolist(), simhash.variants(b).tolist()))


def test_license_base_and_fuzzy(docs, pdf, odd, none):
    got = licenses.license_scan(docs).toPandas().set_index("doc_id")
    for d, t in zip(pdf.doc_id, pdf.text):
        w = licenses.WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t))
        at = sorted(i for p in licenses.BASE for i in range(len(w)) if w[i : i + len(p.split())] == p.split())
        assert got.n_words[d] == len(w) and got.n_base[d] == len(at) and (not at or (got.first_word[d], got.last_word[d]) == (at[0], at[-1]))
    s = licenses.scan("x Permision is hereby grantd, free of charge, to any person obtaining a copy y")
    assert s["labels"] == ["mit"] and 0.9 < s["score"] < 1 and s["spans"][0][1] == 1 and s["n_base"] == 0
    o = licenses.license_scan(odd).toPandas()
    assert o[o.doc_id == 6].base_labels.item() == "gpl,mit" and licenses.license_scan(none).count() == 0


def test_embeddings(spark):
    rng = np.random.default_rng(3)
    base = rng.standard_normal((40, 64))
    rows = [(i, (base[i % 40] + rng.standard_normal(64) * (0.09 if i % 2 else 0.0)).astype(np.float32).tolist(), i % 2 + i % 3) for i in range(400)]
    rows += [(1000, None, 1), (1001, [0.0] * 64, 1), (1002, [None] * 64, 1), (1003, [float("nan")] * 64, 1), (1004, rows[1][1], None), (1005, rows[1][1], rows[1][2]), (1005, rows[1][1], rows[1][2]), (None, rows[1][1], rows[1][2])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = collisions.near_duplicates(df).toPandas()
    good = [r for r in rows if r[1] and r[2] is not None and None not in r[1] and np.isfinite(r[1]).all() and any(r[1])]
    x = np.array([r[1] for r in good], np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    lab = np.array([r[2] for r in good])
    near = (x @ x.T >= 0.98) & (lab[:, None] == lab[None, :])
    want = near.sum(1) - 1
    assert got.n_links.sum() >= 0.98 * want.sum() and got.n_links.sum() <= want.sum() and len(got) == len(rows)
    comp = parts({i: list(np.flatnonzero(near[i])) for i in range(len(good))})
    name = {c: min(good[i][0] for i in comp if comp[i] == c and good[i][0] is not None) for c in set(comp.values())}
    mine = dict(zip(got.vec_id, got.component_id))
    assert np.mean([mine[good[i][0]] == name[comp[i]] for i in comp if good[i][0] is not None]) > 0.98
    assert set(got[got.vec_id.isin([1000, 1001, 1002, 1003, 1004])].n_links) == {0} and collisions.near_duplicates(df.limit(0)).count() == 0


def test_lm_score(docs, pdf, odd, none):
    want = collections.Counter()
    toks = {d: re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) + [None] for d, t in zip(pdf.doc_id, pdf.text)}
    held = {d: zlib.crc32(str(d).encode()) % 7 == 2 for d in toks}
    for d, w in toks.items():
        if not held[d]:
            want.update(w)
    n, v = sum(want.values()), len(want)
    for common in (200_000, 10):
        got = ppm.score(docs, common_words=common).toPandas().set_index("doc_id")
        for d, w in toks.items():
            assert got.held_out[d] == held[d] and got.n_tokens[d] == len(w) and got.n_known[d] == sum(want[x] > 0 for x in w) and got.train_tokens[d] == n
            assert math.isclose(got.base_score[d], sum(math.log10((want[x] + 1) / (n + v + 1)) for x in w), rel_tol=1e-9)
    assert (got.score < 0).all() and len(ppm.score(odd).toPandas()) == len(ODD) and ppm.score(none).count() == 0


def test_language(docs, pdf, odd, none):
    got = ppm.identify(docs, ppm.fit_languages(docs), ["doc_id", "lang"]).toPandas()
    held = got[[zlib.crc32(str(d).encode()) % 4 == 2 for d in got.doc_id]]
    assert (held.lang == held.lang_pred).mean() > 0.95 and got.score.between(0, 1).all()
    o = ppm.identify(odd, ppm.fit_languages(odd), ["doc_id", "text", "score", "label"]).toPandas()
    assert (o[o.text.isna() | o.text.isin(["", "!!! 123"])].lang_pred == "und").all() and len(o) == len(ODD)
    assert ppm.identify(none, ppm.fit_languages(none), ["doc_id"]).count() == 0


def test_records_round_trip(spark, docs, pdf, odd, none):
    files = records.write_records(docs, queries.TOKENIZER, parts=3).collect()
    got = records.read_digests(spark, files).toPandas().sort_values("doc_id")
    p = pdf.sort_values("doc_id")
    want = ids(p.text, 0)
    assert list(got.ids_crc32) == [crc(x) for x in want] and list(got.start) == list(np.cumsum([0] + [len(x) for x in want])[:-1]) and len(files) == 3
    assert list(records.read_record(files[0].path, 0)[1]) == want[list(p.doc_id).index(records.read_record(files[0].path, 0)[0])]
    bad = bytearray(records.frame(b"payload"))
    bad[-6] ^= 1
    with pytest.raises(ValueError):
        records.unframe(bytes(bad))
    o = records.read_digests(spark, records.write_records(odd, queries.TOKENIZER).collect()).toPandas()
    assert len(o) == len(ODD) and records.read_digests(spark, records.write_records(none, queries.TOKENIZER).collect()).count() == 0


def test_multiset(spark, docs, pdf, odd, none):
    got = multiset.edited_fingerprints(docs).toPandas().set_index("doc_id")
    order = sorted(pdf.doc_id, reverse=True)
    text = dict(zip(pdf.doc_id, pdf.text))
    for i, d in enumerate(order):
        t, nxt = text[d], text[order[(i + 1) % len(order)]]
        half = len(t) // 2
        assert got.edited_sha256[d] == hashlib.sha256((t[: len(t) - half] + nxt[:half]).encode()).hexdigest() and got.n_chars[d] == len(t)
    assert got.near_edited.between(0, 1).all() and got.near_edited.mean() > got.near_next.mean() + 0.2
    one = multiset.with_vector(spark.createDataFrame([("A b. C d.", "C d. A b.", "A b.", "C d.")], "a string, b string, c string, d string"), "a", "x")
    one = one.withColumn("c", multiset.F.lit(" A b.")).withColumn("d", multiset.F.lit(" C d."))
    for c in ("c", "d"):
        one = multiset.with_vector(one, c, f"v{c}")
    one = multiset.with_vector(one.withColumn("e", multiset.F.lit(" C d. A b.")), "e", "ve")
    r = one.select(multiset.combine(multiset.F.col("vc"), multiset.F.col("vd")).alias("s"), "ve", "vc", multiset.combine(multiset.F.col("ve"), multiset.F.col("vd"), -1).alias("m")).first()
    assert r.s == r.ve and r.m == r.vc
    o = multiset.edited_fingerprints(odd).toPandas()
    assert len(o) == len(ODD) and o[o.doc_id == 3].fingerprint.nunique() == 1 and multiset.edited_fingerprints(none).count() == 0


def test_mixing(spark, docs, odd, none):
    m = mixing.mix(docs).toPandas()
    g = m.assign(taken=m["size"] * m.copies).groupby("source", dropna=False).agg(taken=("taken", "sum"), target=("target", "max"), size=("source_size", "max"))
    assert math.isclose(g.target.sum(), 1.5 * g["size"].sum(), rel_tol=1e-9) and (g.target <= 2 * g["size"] + 1e-6).all() and m.copies.max() <= 2
    assert abs(g.taken.sum() / g.target.sum() - 1) < 0.1 and mixing.mix(docs).select("doc_id", "copies").exceptAll(mixing.mix(docs).select("doc_id", "copies")).count() == 0
    assert mixing.mix(odd).count() == len(ODD) and mixing.mix(none).count() == 0


def test_sharding(spark, docs, odd, none):
    table = sharding.fill_table([f"s{i}" for i in range(10)], 997)
    n = collections.Counter(table)
    assert max(n.values()) - min(n.values()) <= 1
    less = sharding.fill_table([f"s{i}" for i in range(9)], 997)
    assert sum(a == b for a, b in zip(table, less)) > 0.75 * 997
    got = sharding.place(odd, ["a", "b"]).toPandas()
    assert len(got) == len(ODD) and got[got.doc_id == 3].shard.nunique() == 1 and sharding.place(none, ["a"]).count() == 0


def test_runs_stay_whole_over_batches():
    import pyarrow as pa

    from ledgerloom.llm.common import runs

    keys = [1, 1, 2, 3, 3, 3, 3, 4, 5, 5]
    for size in range(1, 11):
        got = [t.column("k").to_pylist() for t in runs([pa.record_batch({"k": keys[i : i + size]}) for i in range(0, 10, size)], "k")]
        assert sum(got, []) == keys and all(a[-1] != b[0] for a, b in zip(got, got[1:]))
