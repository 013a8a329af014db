"""The permutation-filled table against its rule written out; placement of nulls, ties and clashing columns."""

import hashlib

import pytest

pytest.importorskip("ledgerloom.llm")
from ledgerloom.llm import sharding  # noqa: E402


def number(name, salt, mod):
    return int(hashlib.sha256(f"{salt}:{name}".encode()).hexdigest()[:15], 16) % mod


def filled(shards, size):
    """Each shard in turn takes the first free slot of its own order of preference."""
    order = [[(number(s, "offset", size) + j * (number(s, "skip", size - 1) + 1)) % size for j in range(size)] for s in shards]
    table = {}
    while len(table) < size:
        for i in range(len(shards)):
            if len(table) < size:
                table[next(slot for slot in order[i] if slot not in table)] = i
    return [table[k] for k in range(size)]


@pytest.mark.parametrize(("n", "size"), [(1, 7), (3, 97), (10, 101), (97, 97)])
def test_filling(n, size):
    shards = [f"s{i}" for i in range(n)]
    assert sharding.fill_table(shards, size) == filled(shards, size)


def test_bad_sizes():
    for shards, size in (([], 97), (["a"] * 98, 97), (["a"], 96)):
        with pytest.raises(ValueError):
            sharding.fill_table(shards, size)


def test_placement(spark):
    rows = [(1, "a", "x", 9), (1, "b", "x", 9), (None, "a", "x", 9), (None, "b", "x", 9), (None, None, "x", 9), (None, None, "x", 9), (7, None, "x", 9)]
    got = [(r.doc_id, r.text, r.slot, r.shard) for r in sharding.place(spark.createDataFrame(rows, "doc_id long, text string, shard string, slot int"), ["p", "q", "r"], 97).collect()]
    table = sharding.fill_table(["p", "q", "r"], 97)
    assert len(got) == len(rows)
    for doc, text, slot, shard in got:
        key = str(doc) if doc is not None else text or ""
        assert slot == int(hashlib.md5(key.encode()).hexdigest()[:12], 16) % 97 and shard == "pqr"[table[slot]]
