"""Embedding near-duplicates on larger tables: cells, blocks of a crowded cell, clashing columns; recall against brute force."""

import numpy as np
import pytest

pytest.importorskip("ledgerloom.llm")
from ledgerloom.llm import collisions  # noqa: E402


def brute(x, label, threshold=0.98):
    x = x.astype(np.float32).astype(np.float64)
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = (x @ x.T >= threshold) & (label[:, None] == label[None, :])
    comp = np.arange(len(x))
    while True:
        low = np.where(near, comp[None, :], len(x)).min(1)
        if (low == comp).all():
            return near.sum(1) - 1, comp
        comp = low


def frame(spark, x, label):
    rows = [(i, r, int(a), "v", 1, "k") for i, (r, a) in enumerate(zip(x.astype(np.float32).tolist(), label))]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, node string, mult int, key string")


def test_pairs_around_the_threshold(spark):
    rng = np.random.default_rng(0)
    base = rng.standard_normal((1500, 64))
    x = np.concatenate([base, base + rng.standard_normal(base.shape) * rng.uniform(0.02, 0.25, (1500, 1))])
    label = np.tile(rng.integers(0, 2, 1500), 2)
    links, comp = brute(x, label)
    got = collisions.near_duplicates(frame(spark, x, label), rows=64).toPandas().set_index("vec_id").sort_index()
    assert list(got.columns) == ["n_links", "component_id", "kept"] and links.sum() > 1500
    assert (got.n_links.to_numpy() <= links).all() and got.n_links.sum() >= 0.995 * links.sum()
    assert (got.component_id.to_numpy() == comp).mean() > 0.995 and (got.kept == (got.component_id == got.index)).all()


def test_crowded_cell_is_exact(spark):
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.standard_normal((1, 64)) + rng.standard_normal((1800, 64)) * 0.09, rng.standard_normal((700, 64))])
    label = np.zeros(len(x), int)
    links, comp = brute(x, label)
    got = collisions.near_duplicates(frame(spark, x, label)).toPandas().set_index("vec_id").sort_index()
    assert links.max() > 1000 and got.n_links.sum() >= 0.999 * links.sum() and (got.n_links.to_numpy() <= links).all()
    assert (got.component_id.to_numpy() == comp).all()


def test_lists_and_cells_grow_slowly():
    small, large, huge = (collisions.Projections(n) for n in (500, 500_000, 500_000_000))
    assert small.cuts == 0 and small.cuts < large.cuts < huge.cuts and small.lists < large.lists < huge.lists < 50
    assert small.least <= small.count and huge.least == small.least
