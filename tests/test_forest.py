"""The stored forest equals a full run after any number of additions."""

import random

import pytest

from ledgerloom.operators.components import connected_components
from ledgerloom.operators.forest import Forest


def _full(edges):
    up = {}

    def root(x):
        up.setdefault(x, x)
        while up[x] != x:
            x = up[x]
        return x

    for u, v in edges:
        a, z = root(u), root(v)
        up[max(a, z)] = min(a, z)
    return {x: root(x) for x in up}


@pytest.mark.parametrize("kind", ["string", "long"])
def test_equal_to_full_run(spark, tmp_path, kind):
    rnd = random.Random(7)
    name = (lambda i: f"n{i:03d}") if kind == "string" else (lambda i: i)
    edges = [(name(rnd.randrange(90)), name(rnd.randrange(90))) for _ in range(60)]
    forest, schema = Forest(spark, str(tmp_path / "f"), kind), f"u {kind}, v {kind}"
    states = []
    for i in range(0, 60, 20):
        forest.add(spark.createDataFrame(edges[i : i + 20], schema))
        states.append(_full(edges[: i + 20]))
        assert dict(map(tuple, forest.components().collect())) == states[-1]
    assert {r.node: r.root for r in connected_components(spark.createDataFrame([e for e in edges if e[0] != e[1]], schema)).collect()}.items() <= states[-1].items()
    assert dict(map(tuple, forest.components(0).collect())) == states[0]
    forest.compact()
    assert dict(map(tuple, forest.components().collect())) == states[-1]
    chain = [(name(i), name(i + 1)) for i in range(0, 88)]
    forest.add(spark.createDataFrame([*chain, (None, name(5))], schema))
    assert dict(map(tuple, forest.components().collect())) == _full(edges + chain)


def test_nothing_new(spark, tmp_path):
    forest = Forest(spark, str(tmp_path / "f"))
    assert forest.components().collect() == []
    forest.add(spark.createDataFrame([], "u string, v string"))
    assert forest.components().collect() == []
    forest.add(spark.createDataFrame([("b", "c"), ("x", "x")], "u string, v string"))
    forest.add(spark.createDataFrame([("c", "b"), ("c", "b")], "u string, v string"))
    assert dict(map(tuple, forest.components().collect())) == {"b": "b", "c": "b", "x": "x"}
