"""Entity resolution: names that share a key, a former name or a one-letter slip are one entity."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import names as N
from .components import connected_components, durable


def slips(keys: DataFrame) -> DataFrame:
    """Edges (a, b) between keys (k) of 20 letters or more, of equal length, digits and first five letters, that differ in one place.

    Rows meet on a hash of the key with that place cut out, and each links to the least of its bucket, so no bucket is expanded to pairs;
    a link is checked on the keys.
    """
    k = keys.filter(F.length("k") >= 20).select("k", N.digits_of(F.col("k")).alias("digits")).distinct()
    rest = F.transform(F.sequence(F.lit(1), F.length("k")), lambda i: F.xxhash64(i, F.col("k").substr(F.lit(1), i - 1), F.col("k").substr(i + 1, F.length("k")), F.col("digits")))
    cut = k.select("k", "digits", F.explode(rest).alias("form"))
    least = cut.groupBy("form").agg(F.min("k").alias("b"), F.max("k").alias("top")).filter("b <> top").drop("top")
    alike = (F.length("a") == F.length("b")) & (F.substring("a", 1, 5) == F.substring("b", 1, 5)) & (F.col("digits") == N.digits_of(F.col("b"))) & (F.levenshtein("a", "b", 1) == 1)
    return cut.join(least, "form").withColumnRenamed("k", "a").filter("a <> b").filter(alike).select("a", "b")


def keyed(names: DataFrame) -> DataFrame:
    """(name, pk, aks): distinct names with the canonical keys of their primary name and of their aliases."""
    d = names.select("name").filter("name is not null").distinct().withColumn("n", N.entity_names(F.col("name")))
    pk = N.canonical_key(N.repair_legal_form(F.col("n.primary")))
    d = d.withColumn("pk", F.when(pk != "", pk).otherwise(F.regexp_replace(F.upper("name"), "[^A-Z0-9]", "")))
    return d.withColumn("aks", F.filter(F.transform("n.aliases", lambda a: N.canonical_key(N.repair_legal_form(a))), lambda k: k != "")).drop("n")


def alias_edges(d: DataFrame) -> DataFrame:
    """(a, b): the primary key and each alias key of keyed names."""
    return d.select(F.col("pk").alias("a"), F.explode("aks").alias("b"))


def entity_keys(names: DataFrame) -> DataFrame:
    """(name, entity_key) per distinct name; the key is the least canonical key of the entity: of names, aliases and one-letter slips."""
    d = durable(keyed(names))
    alias = alias_edges(d)
    edges = alias.filter("a <> b").union(slips(d.select(F.col("pk").alias("k")).union(alias.select("b"))))
    roots = connected_components(edges.select(F.col("a").alias("u"), F.col("b").alias("v")))
    return d.join(roots, d.pk == roots.node, "left").select("name", F.coalesce("root", "pk").alias("entity_key"))
