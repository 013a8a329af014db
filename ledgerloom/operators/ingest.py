"""From scraped names to hits, master list and run log: the cleaning chain of every source, in its order."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import clean, names as N

MASTER = {"rbi_nbfc": "Active", "rbi_nbfc_cancelled": "Cancelled"}  # fixed values: master lists and the status of their rows


class Ingested(NamedTuple):
    hits: DataFrame
    master: DataFrame
    run_log: DataFrame


def add_seeds(names: DataFrame, seeds: DataFrame) -> DataFrame:
    """names (source_key, ord, name, classification) and, after them, the seeds whose key their source lacks."""
    have = names.select("source_key", N.canonical_key(N.entity_names(F.col("name"))["primary"]).alias("key")).distinct()
    lacking = seeds.withColumn("key", N.canonical_key(F.col("name"))).join(have, ["source_key", "key"], "left_anti")
    return names.unionByName(lacking.select("source_key", (F.lit(1 << 60) + F.col("pos")).alias("ord"), "name", F.lit(None).cast("string").alias("classification")))


def apply_stale(names: DataFrame, runs: DataFrame, previous: DataFrame, on_empty: bool = False) -> tuple[DataFrame, DataFrame]:
    """Names with an old_status column, and runs (source_key, status, ...) with failed sources marked stale_previous_run.

    A source that failed and has no name takes its rows of `previous` (source_key, name, category, status). `on_empty` does so for
    sources without names too.
    """
    failed = runs.filter(F.col("status").isin("error", *(["empty"] if on_empty else []))).select("source_key").join(names.select("source_key").distinct(), "source_key", "left_anti")
    old = previous.join(failed, "source_key", "left_semi").select("source_key", F.row_number().over(Window.partitionBy("source_key").orderBy("name", "category")).cast("long").alias("ord"), "name", F.col("category").alias("classification"), F.col("status").alias("old_status"))
    stale = old.select("source_key").distinct().withColumn("_stale", F.lit(True))
    marked = runs.join(stale, "source_key", "left").withColumn("status", F.when(F.col("_stale"), "stale_previous_run").otherwise(F.col("status"))).drop("_stale")
    return names.withColumn("old_status", F.lit(None).cast("string")).unionByName(old), marked


def clean_names(names: DataFrame, sources: DataFrame) -> DataFrame:
    """English-only sources, renames, leading junk, ordered distinct, labels. A changed name loses its classification and old status."""
    per_name = Window.partitionBy("source_key", "name").orderBy("ord").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    n = names.withColumn("classification", F.last("classification", True).over(per_name)).withColumn("old_status", F.last("old_status", True).over(per_name))
    n = n.join(F.broadcast(sources.select("source_key", "english")), "source_key").filter(~F.col("english") | N.is_english_name(F.col("name"))).drop("english")
    n = n.withColumn("raw", F.col("name")).withColumn("name", clean.clean_leading_junk(clean.override_name(F.col("source_key"), F.col("raw"), clean.OVERRIDES))).filter("name <> ''")
    same = F.col("name") == F.col("raw")
    n = n.withColumn("classification", F.when(same, F.col("classification"))).withColumn("old_status", F.when(same, F.col("old_status")))
    first = n.groupBy("source_key", "name").agg(F.min("ord").alias("ord"), F.max("classification").alias("classification"), F.max("old_status").alias("old_status"))
    return first.filter(~clean.is_label(F.col("name")))


def ingest(names: DataFrame, runs: DataFrame, sources: DataFrame, seeds: DataFrame, previous: DataFrame) -> Ingested:
    """names (source_key, ord, name, classification), runs (source_key, status, expected_count, note); sources is a small dimension."""
    n, marked = apply_stale(add_seeds(names, seeds), runs, previous)
    n = clean_names(n, sources)
    dim = F.broadcast(sources.select("source_key", F.col("ord").alias("source_ord"), "category", "category_return", "regulator", "status_override"))
    cat = clean.reporting_category(F.col("source_key"), F.col("category"), F.col("category_return"), F.col("name"), F.col("classification"))
    hits = n.join(dim, "source_key").withColumn("cat", cat).select(
        F.struct("source_ord", "ord").alias("ord"), "name", F.col("cat.category_return").alias("category_return"), F.col("cat.category_regulator").alias("category_regulator"), "regulator", "source_key",
        F.coalesce(F.nullif("old_status", F.lit("")), "status_override", F.lit("Active")).alias("status"),
    )
    counts = n.groupBy("source_key").agg(F.count("*").alias("count"))
    log = marked.join(counts, "source_key", "left").withColumn("count", F.coalesce("count", F.lit(0)))
    log = log.withColumn("status", F.when((F.col("status") == "ok") & (F.col("count") == 0), "empty").otherwise(F.col("status"))).join(dim.select("source_key", "category", "regulator"), "source_key", "left")
    good = log.filter("status = 'ok'").select("source_key")
    status = F.create_map(*[F.lit(x) for kv in MASTER.items() for x in kv])
    master = hits.filter(F.col("source_key").isin(*MASTER)).join(F.broadcast(good), "source_key", "left_semi").select("ord", "name", status[F.col("source_key")].alias("status"))
    return Ingested(hits, master, log)


def may_publish(run_log: DataFrame, core: tuple[str, ...] = tuple(MASTER)) -> DataFrame:
    """One row: publish, the core sources that are missing, failed or empty, and the stale ones."""
    bad = lambda k: ~F.coalesce(F.max((F.col("source_key") == k) & ~F.col("status").isin("error", "empty") & (F.col("count") > 0)), F.lit(False))
    checks = run_log.agg(*[bad(k).alias(f"_{i}") for i, k in enumerate(core)], F.array_sort(F.collect_set(F.when(F.col("status") == "stale_previous_run", F.col("source_key")))).alias("s"))
    missing = F.filter(F.array(*[F.when(F.col(f"_{i}"), k) for i, k in enumerate(core)]), lambda x: x.isNotNull())
    return checks.select((F.size(missing) == 0).alias("publish"), F.array_join(missing, ",").alias("missing"), F.array_join("s", ",").alias("stale"))


def hub_ids(sources: DataFrame, hub: DataFrame) -> DataFrame:
    """Ids of sources (source_key, intm_id, label_hint) checked against hub counts (intm_id, label, expected_count).

    A configured id whose label does not fit the hint gives way to the only row that fits; with none or several it stays, with a
    warning. Both tables hold one row per register, so the hint join is small by nature.
    """
    own = sources.join(hub, "intm_id", "left")
    odd = own.filter("label is not null and label_hint is not null").filter(~F.expr("lower(label) rlike concat('(?i)', label_hint)"))
    fits = odd.select("source_key", "label_hint").join(hub, F.expr("lower(label) rlike concat('(?i)', label_hint)"))
    one = fits.groupBy("source_key").agg(F.count("*").alias("n"), F.first(F.struct("intm_id", "label", "expected_count")).alias("new"))
    j = own.join(odd.select("source_key", F.lit(True).alias("odd")), "source_key", "left").join(one, "source_key", "left")
    moved = F.coalesce(F.col("odd") & (F.col("n") == 1), F.lit(False))
    pick = lambda c: F.when(moved, F.col(f"new.{c}")).otherwise(F.col(c))
    warning = F.when(moved, F.lit("id replaced")).when(F.col("odd"), F.when(F.coalesce("n", F.lit(0)) == 0, "no hub row matches").otherwise("more than one hub row matches"))
    return j.select("source_key", pick("intm_id").alias("intm_id"), pick("label").alias("hub_label"), pick("expected_count").alias("expected_count"), F.when(moved, F.col("intm_id")).alias("changed_from"), warning.alias("warning"))
