"""Every fuzzy place of a window, not the best and what follows alone."""

import pytest

pytest.importorskip("ledgerloom.llm")
from ledgerloom.llm import licenses  # noqa: E402


def test_worse_place_before_a_better_one():
    s = licenses.scan("All rights reservd. All rights reserved. All rights resrved")
    assert [(x[0], x[1], x[4]) for x in s["spans"]] == [("proprietary", 0, 1), ("proprietary", 3, 0), ("proprietary", 6, 1)]


def test_misspelt_base_phrase():
    s = licenses.scan("under the Apache Licence")
    assert s["labels"] == ["apache"] and s["n_base"] == 0 and licenses.scan("submit licenses, etc by us")["labels"] == []
