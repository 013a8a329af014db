"""Multiset fingerprints of texts with very many equal pieces."""

import pytest

pytest.importorskip("ledgerloom.llm")
from ledgerloom.llm import multiset  # noqa: E402


def test_many_equal_pieces(spark):
    df = spark.createDataFrame([("Ab." * 10_000, "Ab." * 5_000, "Ab." * 26_384)], "a string, b string, c string")
    for c in "abc":
        df = multiset.with_vector(df, c, f"v{c}")
    r = multiset.with_likeness(df, "va", "vb", "like").first()
    assert abs(r.like - 1) < 1e-9 and r.va != r.vc
    v = df.select(multiset.combine(multiset.F.col("vc"), multiset.F.col("va"), -1).alias("d"), multiset.combine(multiset.F.col("va"), multiset.F.col("vb")).alias("s")).first()
    assert v.d[-1] == 16_384 and v.s[-1] == 15_000
