"""Connected components against union-find, in one task and by steps; one-letter slips against all pairs."""

import random

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import components, entities


def brute(edges):
    up = {x: x for e in edges for x in e}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for u, v in edges:
        a, z = sorted((root(u), root(v)))
        up[z] = a
    return {x: root(x) for x in up}


@pytest.mark.parametrize("one_task", [500_000, 0])
@pytest.mark.parametrize("kind", ["long", "string"])
def test_components(spark, one_task, kind):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(40)] + [(rng.randrange(200, 400), rng.randrange(200, 400)) for _ in range(150)]
    edges = [(u, v) if kind == "long" else (f"n{u:04d}", f"n{v:04d}") for u, v in edges if u != v]
    got = components.connected_components(spark.createDataFrame(edges, f"u {kind}, v {kind}").repartition(5), one_task=one_task)
    assert {r.node: r.root for r in got.collect()} == brute(edges)
    assert components.connected_components(spark.createDataFrame([], f"u {kind}, v {kind}"), one_task=one_task).count() == 0


def test_slips(spark):
    rng = random.Random(4)
    base = ["".join(rng.choices("ABCDE1", k=rng.randrange(18, 26))) for _ in range(40)]
    keys = set(base)
    for k in base:
        i = rng.randrange(len(k))
        keys.add(k[:i] + rng.choice("XYZ9") + k[i + 1 :])
        keys.add(k[:i] + k[i + 1 :])
    digits = lambda k: [c for c in k if c.isdigit()]
    want = [(a, b) for a in keys for b in keys if a < b and len(a) == len(b) >= 20 and a[:5] == b[:5] and digits(a) == digits(b) and sum(x != y for x, y in zip(a, b)) == 1]
    got = [tuple(r) for r in entities.slips(spark.createDataFrame([(k,) for k in keys], "k string")).collect()]
    assert all(tuple(sorted(e)) in want for e in got) and brute(got) == brute(want)


def test_shared_folder_must_be_named_on_a_cluster(spark):
    class Context:
        master = "spark://host:7077"
        getCheckpointDir = staticmethod(lambda: None)

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(RuntimeError):
        components.shared_dir(Session())
    assert components.small(spark.range(3)).count() == 3 and components.small(spark.range(3), 1).select(F.max("id")).first()[0] == 2
