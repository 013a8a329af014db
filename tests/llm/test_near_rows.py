"""Near-dedup picks rows, not doc_ids: repeated and null doc_ids."""

import pytest

pytest.importorskip("ledgerloom.llm")
from .test_jaccard import dedup  # noqa: E402


def test_one_row_per_component(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(50)) for x in "abc")
    got = sorted((r.doc_id if r.doc_id is not None else -1, r.text) for r in dedup(spark, [(1, a), (2, a), (2, b), (None, c), (None, c), (None, a), (3, b)]))
    assert got == [(-1, c), (1, a), (2, b)]
