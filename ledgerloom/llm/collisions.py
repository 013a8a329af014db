"""Embedding near-duplicates by collision counting on sorted one-dimensional projections.

Each of several lists holds the vectors of a label sorted by a projection of its own. In a list, a query meets the rows whose projection
lies in a window centred on its own; over `count` further projections, the windows that hold both are counted, and a pair passes with
`least` collisions or more: the largest count that keeps `recall` of the pairs at the threshold, as their projected differences are
normal. Passing pairs are verified by cosine in double precision.

One projection alone leaves a third of a label in each window, so work would grow with the square of a label. Therefore a list is cut
into cells of `cuts` more projections, as many as keep about `rows` rows of the largest label in a cell; and there are as many lists as
let a pair at the threshold share a cell and a window in one of them with probability `recall`. A label of up to `rows` rows is not cut.
Cells that hold far more (near copies) are dealt out as pairs of blocks, so no task holds a cell of unbounded size.

The first pass carries projections only, a byte or two each; vectors travel in the second pass, for rows that passed with someone.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounds, connected_components, durable, runs, small

STEP = 64.0  # grid of a projection: 1/64 of a unit, where a unit vector's projection has a deviation of 1
DEVIATIONS = 3.0  # half a window, in deviations of a pair at the threshold
CELL = 10.0  # a cell, in the same deviations


class Projections:
    """Lists, cells, window and count for vectors of one threshold, of which a label holds up to `largest`."""

    def __init__(self, largest: int, threshold: float = 0.98, count: int = 16, recall: float = 0.999, rows: int = 512, seed: int = 5):
        self.threshold, self.count, self.seed = threshold, count, seed
        sd = math.sqrt(2 - 2 * threshold)
        self.window, self.width = math.ceil(DEVIATIONS * sd * STEP) + 1, CELL * sd
        inside = math.erf(DEVIATIONS / math.sqrt(2))
        together = 1 - math.sqrt(2 / math.pi) / CELL  # a pair at the threshold in one cell of one projection
        z = self.width / math.sqrt(2)
        apart = math.erf(z / math.sqrt(2)) - math.sqrt(2 / math.pi) / z * (1 - math.exp(-z * z / 2))  # an unlike pair, at right angles
        self.cuts = max(0, math.ceil(math.log(max(1, largest) / rows) / -math.log(apart)))
        met = inside * together**self.cuts
        self.lists = max(2, math.ceil(math.log(1 - recall) / math.log(1 - met)))
        self.least, tail = count, 0.0
        while self.least > 0:
            tail += math.comb(count, self.least) * inside**self.least * (1 - inside) ** (count - self.least)
            if tail >= 1 - (1 - recall) / 10:
                break
            self.least -= 1

    def project(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Cells (rows x lists, hashed), the lists' own projections (rows x lists) and those to count (rows x count), of unit vectors."""
        rng = np.random.default_rng([self.seed, x.shape[1]])
        grid = lambda n: np.clip(np.rint(x @ rng.standard_normal((x.shape[1], n)) * STEP), -32_000, 32_000).astype("<i2")
        own, counted = grid(self.lists), grid(self.count)
        cells = np.zeros((len(x), self.lists), np.uint64)
        for _ in range(self.cuts):
            at = np.floor((x @ rng.standard_normal((x.shape[1], self.lists)) + rng.uniform(0, self.width, self.lists)) / self.width).astype(np.int64)
            cells = (cells ^ at.view(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            cells ^= cells >> np.uint64(29)
        return cells.view(np.int64), own, counted


def _vectors(column) -> np.ndarray:
    """Equally long arrays of a column as a matrix."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _units(column) -> np.ndarray:
    x = _vectors(column)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # so that no square overflows or vanishes
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _packed(column, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), -1)


def _bytes(table: np.ndarray) -> pa.Array:
    return pa.array([r.tobytes() for r in table], pa.binary())


def _hits(a: np.ndarray, z: np.ndarray, p: Projections) -> np.ndarray:
    """Which rows of a and z collide in enough windows."""
    n = np.zeros((len(a), len(z)), np.int8)
    for i in range(a.shape[1]):
        n += np.abs(a[:, i, None].astype(np.int32) - z[None, :, i]) <= p.window
    return n >= p.least


def _windows(own: np.ndarray, first: np.ndarray, second: np.ndarray, p: Projections, block: int = 256):
    """Rows of `first` by blocks, in the order of the list's projection, and the rows of `second` in the span of their windows."""
    a, z = first[np.argsort(own[first], kind="stable")], second[np.argsort(own[second], kind="stable")]
    values = own[z].astype(np.int64)
    for i in range(0, len(a), block):
        part = a[i : i + block]
        lo = np.searchsorted(values, int(own[part[0]]) - p.window, "left")
        hi = np.searchsorted(values, int(own[part[-1]]) + p.window, "right")
        if hi > lo:
            yield part, z[lo:hi]


def _dealt(listed: DataFrame) -> DataFrame:
    """Rows of each cell as pairs of blocks: `task` (the key to meet on) and `side`, the row's block there (0 or 1; 2: the only one).

    A cell of g rows has about sqrt(g / 64) blocks; each pair of them is a task, so a task holds about 2 * sqrt(64 * g) rows.
    """
    sizes = listed.groupBy("key").agg(F.count("*").alias("g")).filter("g > 256").select("key", F.ceil(F.sqrt(F.col("g") / 64)).cast("int").alias("s"))
    d = listed.join(small(sizes), "key", "left").withColumn("s", F.coalesce("s", F.lit(1)))
    d = d.withColumn("own", F.pmod(F.xxhash64("node"), F.col("s")).cast("int"))
    d = d.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("s") - 1)))
    side = F.when(F.col("own") == F.col("other"), 2).when(F.col("own") < F.col("other"), 0).otherwise(1)
    return d.withColumn("side", side.cast("int")).withColumn("task", F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other"))).drop("s", "own", "other", "key")


def _pairs(own: np.ndarray, side: np.ndarray, p: Projections):
    """Blocks of rows that a task compares. Within one block each pair is seen from both sides, across two blocks once."""
    only = np.flatnonzero(side == 2)
    if len(only):
        yield from ((a, z, True) for a, z in _windows(own, only, only, p))
    else:
        yield from ((a, z, False) for a, z in _windows(own, np.flatnonzero(side == 0), np.flatnonzero(side == 1), p))


def near_duplicates(vectors: DataFrame, threshold: float = 0.98, **options) -> DataFrame:
    """vec_id, n_links, component_id, kept for vectors (vec_id, embedding, label): links join equal non-null labels at cosine >= threshold.

    Null, empty or zero vectors, null or non-finite components, and null labels: no links, own component. Equal vectors of a label are
    one node with a multiplicity, so copies cost one row. Vectors of different length never link. A null vec_id is linked but names
    nothing. Repeated rows each return and link with each other. Ties at the threshold link. Empty table: no rows. Other columns of
    vectors are not read, whatever their names. `options`: of Projections.
    """
    v = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("x"), F.col("label"))
    fine = F.coalesce(F.col("label").isNotNull() & (F.size("x") > 0) & F.forall("x", lambda a: a.isNotNull() & ~F.isnan(a) & (F.abs(a) < float("inf"))) & F.exists("x", lambda a: a != 0), F.lit(False))
    v = v.withColumn("x", F.when(fine, F.transform("x", lambda a: a + 0.0))).withColumn("label", F.col("label").cast("string"))
    nodes = durable(v.filter("x is not null").groupBy("label", "x").agg(F.count("*").alias("mult"), F.min("vec_id").alias("first")).withColumn("node", F.monotonically_increasing_id()))
    p = Projections(nodes.groupBy("label").count().agg(F.max("count")).first()[0] or 0, threshold, **options)

    def by_length(batches):
        for b in batches:
            size = b.column("n").to_numpy()
            for n in np.unique(size):
                yield int(n), b.filter(pa.array(size == n))

    def sketch(batches):
        for n, t in by_length(batches):
            cells, own, counted = p.project(_units(t.column("x")))
            k, rows = p.lists, np.repeat(np.arange(t.num_rows), p.lists)
            yield pa.RecordBatch.from_arrays(
                [t.column("node").take(pa.array(rows)), t.column("label").take(pa.array(rows)), pa.array([n] * len(rows), pa.int32()), pa.array(np.tile(np.arange(k, dtype=np.int32), t.num_rows)),
                 pa.array(cells.ravel()), pa.array(own.ravel().astype(np.int32)), _bytes(counted).take(pa.array(rows))],
                ["node", "label", "n", "t", "cell", "place", "q"],
            )

    listed = nodes.select("node", "label", "x", F.size("x").alias("n")).mapInArrow(sketch, "node long, label string, n int, t int, cell long, place int, q binary")
    listed = listed.select(F.xxhash64("label", "n", "t", "cell").alias("key"), "node", "place", "q")

    def meet(batches):
        """Nodes that pass the count with another node."""
        for t in runs(batches, "task"):
            node, place, side = (t.column(c).to_numpy() for c in ("node", "place", "side"))
            s, e = bounds(t.column("task").to_numpy())
            found = []
            for i, j in zip(s[e - s > 1], e[e - s > 1]):
                q, names = _packed(t.column("q").slice(i, j - i), "<i2"), node[i:j]
                for a, z, _ in _pairs(place[i:j], side[i:j], p):
                    ok = _hits(q[a], q[z], p) & (names[a, None] != names[None, z])
                    found += [names[a][ok.any(1)], names[z][ok.any(0)]]
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(np.concatenate(found)) if found else np.empty(0, np.int64))], ["node"])

    live = durable(_on_task(_dealt(listed), "node", "place", "side", "q").mapInArrow(meet, "node long").distinct())

    def deal(batches):
        for n, t in by_length(batches):
            cells, own, counted = p.project(_units(t.column("x")))
            met, every = _bytes(cells), _bytes(own)
            for i in range(p.lists):
                yield pa.RecordBatch.from_arrays(
                    [t.column("node"), t.column("label"), t.column("n"), t.column("mult"), t.column("x"), pa.array([i] * t.num_rows, pa.int32()), pa.array(cells[:, i]), met, every, _bytes(counted)],
                    ["node", "label", "n", "mult", "x", "t", "cell", "cells", "places", "q"],
                )

    full = nodes.join(live, "node", "left_semi").select("node", "label", F.size("x").alias("n"), "mult", "x")
    kinds = "node long, label string, n int, mult long, x array<double>, t int, cell long, cells binary, places binary, q binary"
    rows = full.mapInArrow(deal, kinds).select(F.xxhash64("label", "n", "t", "cell").alias("key"), "node", "mult", "x", "t", "cells", "places", "q")

    def verify(batches):
        """Links of each node, a pair counted in the first list in which it meets, and edges that span what is linked."""
        for t in runs(batches, "task"):
            node, mult, number, side = (t.column(c).to_numpy() for c in ("node", "mult", "t", "side"))
            s, e = bounds(t.column("task").to_numpy())
            us, vs, ns = [], [], []
            for i, j in zip(s[e - s > 1], e[e - s > 1]):
                x, q = _units(t.column("x").slice(i, j - i)), _packed(t.column("q").slice(i, j - i), "<i2")
                cells, places = _packed(t.column("cells").slice(i, j - i), "<i8"), _packed(t.column("places").slice(i, j - i), "<i2").astype(np.int32)
                names, m, g = node[i:j], mult[i:j], int(number[i])
                links = np.zeros(j - i, np.int64)
                for a, z, both in _pairs(places[:, g], side[i:j], p):
                    near = _hits(q[a], q[z], p) & (x[a] @ x[z].T >= p.threshold) & (names[a, None] != names[None, z])
                    near &= np.abs(places[a, g, None] - places[None, z, g]) <= p.window
                    new = near.copy()
                    for h in range(g):
                        new &= ~((cells[a, h, None] == cells[None, z, h]) & (np.abs(places[a, h, None] - places[None, z, h]) <= p.window))
                    links[a] += new @ m[z]
                    if not both:
                        np.add.at(links, z, m[a] @ new)
                    r, c = _forest(near)
                    us.append(names[a[r]])
                    vs.append(names[z[c]])
                    ns.append(np.zeros(len(r), np.int64))
                some = np.flatnonzero(links)
                us.append(names[some])
                vs.append(names[some])
                ns.append(links[some])
            columns = [np.concatenate(c).astype(np.int64) if c else np.empty(0, np.int64) for c in (us, vs, ns)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["u", "v", "links"])

    met = _on_task(_dealt(rows), "node", "mult", "x", "t", "side", "cells", "places", "q")
    found = durable(met.mapInArrow(verify, "u long, v long, links long"))
    comp = connected_components(found.filter("u <> v").select("u", "v"))
    links = found.groupBy("u").agg(F.sum("links").alias("links")).withColumnRenamed("u", "node")
    named = nodes.join(comp, "node", "left").withColumn("root", F.coalesce("root", "node")).join(links, "node", "left")
    least = named.groupBy("root").agg(F.min("first").alias("component_id"))
    named = named.join(least, "root").select("label", "x", (F.coalesce("links", F.lit(0)) + F.col("mult") - 1).alias("n_links"), "component_id")
    good = v.filter("x is not null").join(named, ["label", "x"]).select("vec_id", "n_links", "component_id")
    lone = v.filter("x is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return good.union(lone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def _on_task(df: DataFrame, *columns: str) -> DataFrame:
    return df.repartition("task").sortWithinPartitions("task").select("task", *columns)


def _forest(near: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (row, column) that connect all that `near` connects: each column once, and rows that share a column."""
    up = list(range(len(near)))

    def root(x):
        while up[x] != x:
            up[x] = x = up[up[x]]
        return x

    rows, cols = [], []
    owner = np.full(near.shape[1], -1)
    for r in np.flatnonzero(near.any(1)):
        c = np.flatnonzero(near[r])
        o = owner[c]
        fresh = c[o < 0]
        owner[fresh] = r
        rows.extend([r] * len(fresh))
        cols.extend(fresh)
        for w in np.unique(o[o >= 0]):
            if (a := root(int(r))) != (z := root(int(w))):
                up[a] = z
                rows.append(r)
                cols.append(c[o == w][0])
    return np.array(rows, np.int64), np.array(cols, np.int64)
