"""The SimHash step of the pipeline's near-dedup: pairs within three bits meet, and are compared on their whole sets."""

import itertools
import random

import pytest

pytest.importorskip("ledgerloom.llm")


def test_three_bits_leave_a_block_key():
    from ledgerloom.llm import simhash

    rng = random.Random(2)
    for _ in range(300):
        f = rng.getrandbits(64)
        signed = lambda x: x - (1 << 64) if x >> 63 else x
        z = f
        for bit in rng.sample(range(64), 3):
            z ^= 1 << bit
        a, b = (simhash.block_keys(signed(x)) for x in (f, z))
        assert len(set(a.tolist())) == 20 and (a == b).any()


def test_near_copies_meet_by_simhash_alone(spark):
    """Without MinHash bands the pairs within three bits are linked, those of them below the similarity are not."""
    from ledgerloom.llm import jaccard, simhash

    rng, rows = random.Random(8), []
    for i in range(80):
        w = [f"w{rng.randrange(9000)}" for _ in range(1000)]
        c = list(w)
        c[rng.randrange(1000)] = "other"
        rows += [(2 * i, " ".join(w)), (2 * i + 1, " ".join(c))]
    few = " ".join(["a"] * 200)  # the next has a second shingle in its set: alike in all bits, not in their sets
    rows += [(1000, few), (1001, few + " c")]
    fp = {d: simhash.fingerprint(t) for d, t in rows}
    near = {(a, z) for a, z in itertools.combinations(fp, 2) if ((fp[a] ^ fp[z]) & (2**64 - 1)).bit_count() <= 3}
    like = lambda a, z: jaccard.similarity(*(((jaccard.shingles(dict(rows)[x], 5) >> 32).astype("<u4")).tobytes() for x in (a, z)))
    got = {r.d: r.root for r in jaccard.jaccard_components(spark.createDataFrame(rows, "d long, text string"), "d", bands=0).collect()}
    assert len(near) > 60 and (1000, 1001) in near and like(1000, 1001) < 0.8
    assert all((got[a] == got[z]) == (like(a, z) >= 0.8) for a, z in near)
    assert len(set(got.values())) < 110
