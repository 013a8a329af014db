"""Relations of the audited workbook. hits: (ord, name, category_return, category_regulator, regulator, source_key, status);
keys: (name, entity_key); resolved: resolve.resolve's rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _first_per_source(hits: DataFrame, keys: DataFrame) -> DataFrame:
    fields = [c for c in hits.columns if c not in ("ord", "source_key")]
    h = hits.join(keys, "name").groupBy("source_key", "entity_key").agg(F.min("ord").alias("ord"), F.min_by(F.struct(*fields), "ord").alias("h"))
    return h.select("source_key", "entity_key", "ord", "h.*")


def membership_rows(hits: DataFrame, keys: DataFrame, resolved: DataFrame) -> DataFrame:
    """Combine List: a row per (source, entity), the first hit of each, flagged where its source holds the entity's final category."""
    r = resolved.select("entity_key", F.col("source_key").alias("final_source"), "all_categories", "category_count")
    j = _first_per_source(hits, keys).join(r, "entity_key", "left")
    return j.select(
        "ord", "name", F.col("category_regulator").alias("category"), "category_return", "regulator", "status", F.coalesce("all_categories", "category_regulator").alias("all_categories"), F.coalesce("category_count", F.lit(1)).alias("category_count"),
        "source_key", F.when(F.col("final_source") == F.col("source_key"), "Yes").otherwise("No").alias("is_final"), "entity_key",
    )


def multi_category(resolved: DataFrame) -> DataFrame:
    """Entities of several categories, with all memberships by rank, then order of hits."""
    ranked = F.array_sort(F.transform("memberships", lambda m: F.struct(m["rank"].alias("rank"), m["ord"].alias("ord"), m["category_regulator"].alias("category"), m["regulator"].alias("regulator"))))
    text = F.array_join(F.transform(ranked, lambda m: F.concat(m["category"], F.lit(" (rank "), m["rank"].cast("string"), F.lit(", "), F.coalesce(m["regulator"], F.lit("")), F.lit(")"))), "  |  ")
    return resolved.filter("category_count > 1").select("entity_key", "name", F.col("category").alias("final_category"), "final_rank", text.alias("all_memberships"))


def source_reconciliation(hits: DataFrame, keys: DataFrame, resolved: DataFrame, run_log: DataFrame) -> DataFrame:
    """Per source of the run log (source_key, status, count, expected_count, note): counts against the portal's and its share of final rows."""
    won = resolved.select("entity_key", F.col("source_key").alias("winner"))
    s = hits.join(keys, "name").select("source_key", "entity_key").distinct().join(won, "entity_key", "left")
    g = s.groupBy("source_key").agg(F.count("*").alias("unique_entities"), F.count_if(F.col("winner") == F.col("source_key")).alias("_wins"))
    zero = lambda c: F.coalesce(c, F.lit(0))
    return run_log.join(g, "source_key", "left").select(
        "source_key", "status", F.col("expected_count").alias("portal_count"), F.col("count").alias("scraped"), (F.col("count") - F.col("expected_count")).alias("diff"), zero("unique_entities").alias("unique_entities"),
        zero("unique_entities").alias("combine_rows"), (zero("unique_entities") - zero("_wins")).alias("held_back"), F.coalesce("note", F.lit("")).alias("note"),
    )


def with_final_status(hits: DataFrame, keys: DataFrame, final: DataFrame, final_keys: DataFrame, sources: tuple[str, ...] = ("rbi_nbfc", "rbi_nbfc_cancelled")) -> DataFrame:
    """Hits of the master sources take the final status (name, final_status) of their entity."""
    f = final.join(final_keys, "name").groupBy("entity_key").agg(F.max_by("final_status", "name").alias("_final"))
    k = hits.join(keys, "name", "left").join(f, "entity_key", "left")
    return k.withColumn("status", F.when(F.col("source_key").isin(*sources), F.coalesce("_final", "status")).otherwise(F.col("status"))).select(*hits.columns)


def run_totals(run_log: DataFrame) -> DataFrame:
    is_ = lambda s: F.count_if(F.col("status") == s)
    return run_log.agg(F.count("*").alias("sources"), is_("ok").alias("ok"), is_("error").alias("failed"), is_("empty").alias("empty"), is_("stale_previous_run").alias("stale"), is_("skipped_manual").alias("manual"), F.sum("count").alias("names"))
