"""Connected components that grow: new edges contract onto a stored forest, and old edges are never read again.

nodes (part, node, root, batch): every node once, with the root it had when it came; appended, sorted by part, so a lookup skips the row
groups of other parts. moves (node, root): roots that have since gone into another; merges since the last compaction, not nodes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.versions import Versions
from .components import connected_components, durable

PARTS = 256


def _part(node: str = "node"):
    return F.pmod(F.xxhash64(node), F.lit(PARTS)).cast("int").alias("part")


class Forest:
    """Components of all edges added to a folder so far; each addition is one version of it."""

    def __init__(self, spark: SparkSession, folder: str, kind: str = "string"):
        self.spark, self.kind, self.store = spark, kind, Versions(spark, folder)

    def _read(self, name: str, fields: str) -> DataFrame:
        return self.store.read(name) if self.store.latest() is not None else self.spark.createDataFrame([], fields)

    def _nodes(self) -> DataFrame:
        return self._read("nodes", f"batch string, part int, node {self.kind}, root {self.kind}").select("part", "node", "root")

    def _moves(self) -> DataFrame:
        return self._read("moves", f"node {self.kind}, root {self.kind}")

    def add(self, edges: DataFrame, most_parts: int = PARTS) -> int:
        """Adds edges (u, v); the number of the new version.

        Endpoints are looked up in their parts of the stored nodes, edges are lifted to roots, and components are sought among lifted edges
        and moves alone. A node without a partner comes as an edge to itself. Null ends are left out. Repeated edges, edges known before, and
        an empty addition change nothing but the number.
        """
        e = durable(edges.select("u", "v").filter("u is not null and v is not null").distinct())
        ends = durable(e.select(F.col("u").alias("node")).union(e.select("v")).distinct().select("node", _part()))
        parts = [r.part for r in ends.select("part").distinct().limit(most_parts).collect()]
        known = durable(self._nodes().filter(F.col("part").isin(parts)).join(ends, ["part", "node"], "left_semi").select("node", "root"))
        fresh = ends.join(known, "node", "left_anti")
        up = lambda c: known.select(F.col("node").alias(c), F.col("root").alias(f"r_{c}"))
        lifted = e.join(up("u"), "u", "left").join(up("v"), "v", "left").select(F.coalesce("r_u", "u").alias("u"), F.coalesce("r_v", "v").alias("v")).filter("u <> v")
        met = durable(connected_components(lifted.union(self._moves().select("node", "root"))))
        new = fresh.join(met, "node", "left").select(F.lit(f"{len(self.store.numbers()):09d}").alias("batch"), "part", "node", F.coalesce("root", "node").alias("root"))
        moves = met.filter("node <> root").join(fresh.select("node"), "node", "left_anti")
        return self.store.commit({"nodes": new.repartitionByRange("part").sortWithinPartitions("part"), "moves": moves}, {"nodes": "batch"})

    def components(self, number: int | None = None) -> DataFrame:
        """(node, root) of all nodes, the root being the least node of its component; of an earlier version, if a number is given."""
        if self.store.latest() is None:
            return self.spark.createDataFrame([], f"node {self.kind}, root {self.kind}")
        nodes, moves = (self.store.read(n, number) for n in ("nodes", "moves"))
        m = moves.select(F.col("node").alias("root"), F.col("root").alias("_now"))
        return nodes.join(m, "root", "left").select("node", F.coalesce("_now", "root").alias("root"))

    def compact(self) -> int:
        """All nodes as one batch with their present roots, and no moves."""
        old = [r.value for r in self.store.origin("nodes").collect()]  # a row per addition
        nodes = self.components().select(F.lit(f"{len(self.store.numbers()):09d}").alias("batch"), _part(), "node", "root")
        moves = self.spark.createDataFrame([], f"node {self.kind}, root {self.kind}")
        return self.store.commit({"nodes": nodes.repartitionByRange("part").sortWithinPartitions("part"), "moves": moves}, {"nodes": "batch"}, {"nodes": old})
