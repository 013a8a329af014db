"""Durable cuts in the lineage, and connected components."""

from __future__ import annotations

import re
import tempfile

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Only in local mode, where all is one machine, a temporary one stands in."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not re.match(r"local(\[|$)", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="ledgerloom-"))
    at = sc.getCheckpointDir()
    return "file:///" + at[6:].lstrip("/") if at.startswith("file:/") else at


def durable(df: DataFrame) -> DataFrame:
    """df, computed once and kept in the shared folder, so that a lost executor costs no recomputation."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def small(df: DataFrame, rows: int = 100_000) -> DataFrame:
    """A durable cut of df, marked for broadcast where it has at most `rows` rows; beyond that it joins by shuffle."""
    df = durable(df)
    return F.broadcast(df) if df.count() <= rows else df


def _contract(batches):
    """The edges of a partition as stars around the smallest node of each of its parts."""
    up: dict = {}

    def root(x):
        while (p := up.setdefault(x, x)) != x:
            up[x] = x = up[p]
        return x

    def stars():
        pairs = [(x, r) for x in list(up) if (r := root(x)) != x]
        up.clear()
        return pa.RecordBatch.from_arrays([pa.array([p[i] for p in pairs], kind) for i in (0, 1)], ["u", "v"])

    kind = pa.int64()
    for b in batches:
        kind = b.column(0).type
        for u, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            a, z = root(u), root(v)
            if a != z:
                up[max(a, z)] = min(a, z)
        if len(up) > 500_000:
            yield stars()
    if up:
        yield stars()


def connected_components(edges: DataFrame, made_by=None, one_task: int = 500_000) -> DataFrame:
    """(node, root) for every node of edges (u, v: longs or strings); root is the smallest node of its component.

    Partitions contract their own edges first. What is left, if at most `one_task` edges, is contracted by one task; else large-star and
    small-star steps alternate until the edges stand still, each cut by a checkpoint. `made_by`: what makes batches of edges out of those
    of `edges`, run in the same worker as the first contraction, as two Python operators in one stage would hold two workers a task;
    it gives longs. No edges: no rows.
    """
    kind = "long" if made_by else edges.schema["u"].dataType.simpleString()
    schema = f"u {kind}, v {kind}"
    e = durable(edges.mapInArrow(lambda batches: _contract(made_by(batches) if made_by else batches), schema).distinct())
    n, seen = e.count(), None
    if 0 < n <= one_task:
        e = durable(e.repartition(1).mapInArrow(_contract, schema))
    while n > one_task:
        sig = tuple(e.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())
        if sig == seen:
            break
        seen = sig
        both = e.union(e.select("v", "u"))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        big = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        least = big.groupBy("u").agg(F.min("v").alias("m"))
        e = durable(big.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").union(least).distinct())
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).union(e.select("v", "v")).distinct()
