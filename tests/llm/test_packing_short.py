"""Packing of many very short pieces."""

import numpy as np
import pytest

pytest.importorskip("ledgerloom.llm")
from ledgerloom.llm import packing  # noqa: E402


def test_short_pieces_fill_their_bins():
    rng = np.random.default_rng(0)
    lengths = np.array([1] * 4000 + [int(x) for x in rng.integers(1, 40, 2000)])
    where, offset = packing.fill(lengths, 2048)
    ends = offset + lengths
    assert ends.max() <= 2048 and lengths.sum() / (2048 * (where.max() + 1)) > 0.93
    for b in np.unique(where):
        at = np.argsort(offset[where == b])
        assert list(offset[where == b][at]) == [0, *np.cumsum(lengths[where == b][at])[:-1]]
