"""Reconciling a master list with dated status changes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import names as N


def match_names(master: DataFrame, names: DataFrame) -> DataFrame:
    """(entity_name, master_key, tier): distinct names meet master rows (master_key, name) by the first tier that hits.

    Tiers: 1 legacy key, 2 canonical key, 3 an alias of the name, 4 an alias of the master row, 5 one edit with a single candidate key.
    Master keys of all kinds are one index, a name's keys of all tiers its probes, so tiers 1 to 4 are one join. Only names that no
    tier hit, and whose first letters and digits some master key has, go on to the fifth.
    """
    p = master.select("master_key", N.split_annotations(F.col("name")).alias("n")).select("master_key", N.canonical_key(F.col("n.primary")).alias("k"), "n.aliases")
    entry = lambda kind, key: F.struct(F.lit(kind).alias("kind"), key.alias("key"))
    index = p.select("master_key", F.inline(F.concat(F.array(entry("legacy", F.col("master_key")), entry("canonical", F.col("k"))), F.transform("aliases", lambda a: entry("alias", N.canonical_key(a)))))).filter("key <> ''").distinct()
    probe = lambda kind, tier, pos, key: F.struct(F.lit(kind).alias("kind"), F.lit(tier).alias("tier"), pos.alias("pos"), key.alias("key"))
    d = names.select("entity_name").filter("entity_name is not null").distinct()
    d = d.select("entity_name", N.normalize_name(F.col("entity_name")).alias("legacy"), N.split_annotations(F.col("entity_name")).alias("n")).select("entity_name", "legacy", N.canonical_key(F.col("n.primary")).alias("dk"), "n.aliases")
    fixed = F.array(probe("legacy", 1, F.lit(0), F.col("legacy")), probe("canonical", 2, F.lit(0), F.col("dk")), probe("alias", 4, F.lit(0), F.col("dk")))
    d = d.select("entity_name", F.inline(F.concat(fixed, F.transform("aliases", lambda a, i: probe("canonical", 3, i, N.canonical_key(a))))))
    met = d.join(index, ["kind", "key"], "left")
    place = F.struct("tier", "pos")
    met = met.withColumn("best", F.min(F.when(F.col("master_key").isNotNull(), place)).over(Window.partitionBy("entity_name")))
    hit = met.filter(F.col("master_key").isNotNull() & (place == F.col("best"))).select("entity_name", "master_key", "tier").distinct()
    rest = met.filter("best is null and tier = 2 and length(key) >= 16").select("entity_name", F.col("key").alias("dk"))
    # within one edit: the keys share a form with at most one letter cut out; guards are hashed in, so no block of like names is compared in full
    guarded = lambda x, k: x.withColumn("p5", F.substring(k, 1, 5)).withColumn("dg", N.digits_of(F.col(k)))
    cut = lambda k: F.transform(F.sequence(F.lit(1), F.length(k)), lambda i: F.xxhash64(F.concat(k.substr(F.lit(1), i - 1), k.substr(i + 1, F.length(k))), F.col("p5"), F.col("dg")))
    forms = lambda x, k: x.select(k, F.explode(F.array_distinct(F.concat(F.array(F.xxhash64(k, "p5", "dg")), cut(F.col(k))))).alias("form"))
    known = guarded(p.select("k").filter(F.length("k") >= 15).distinct(), "k")
    slips = guarded(rest.select("dk").distinct(), "dk").join(known.select("p5", "dg").distinct(), ["p5", "dg"], "left_semi")
    c = forms(slips, "dk").join(forms(known, "k"), "form").filter((F.col("dk") != F.col("k")) & N.within_one_edit(F.col("dk"), F.col("k")) & (F.substring("dk", 1, 5) == F.substring("k", 1, 5)) & (N.digits_of(F.col("dk")) == N.digits_of(F.col("k"))))
    one = c.groupBy("dk").agg(F.count_distinct("k").alias("n"), F.min("k").alias("k")).filter("n = 1")
    near = rest.join(one.select("dk", "k"), "dk").join(p.select("k", "master_key"), "k").select("entity_name", "master_key", F.lit(5).alias("tier"))
    return hit.union(near)


def match(master: DataFrame, deltas: DataFrame) -> DataFrame:
    """(delta_ord, master_key, tier) for deltas (ord, entity_name), by match_names."""
    return deltas.select(F.col("ord").alias("delta_ord"), "entity_name").join(match_names(master, deltas), "entity_name").select("delta_ord", "master_key", "tier")


def _collapsed(master: DataFrame) -> DataFrame:
    return master.withColumn("master_key", N.normalize_name(F.col("name"))).groupBy("master_key").agg(F.max_by("name", "ord").alias("name"), F.max_by("status", "ord").alias("master_status"))


def reconcile(master: DataFrame, deltas: DataFrame) -> DataFrame:
    """Final status of each master row (ord, name, status), collapsed by legacy key with the last value, after deltas
    (ord, entity_name, action, effective_date): the latest date wins, the later row on a tie; Restored means Active."""
    m = _collapsed(master)
    hit = deltas.withColumnRenamed("ord", "delta_ord").join(match_names(m, deltas), "entity_name")
    last = hit.groupBy("master_key").agg(F.max(F.struct("effective_date", "delta_ord", "action")).alias("l"), F.count("*").alias("n_changes"))
    action = F.when(F.col("l.action") == "Restored", "Active").otherwise(F.col("l.action"))
    return m.join(last, "master_key", "left").select("master_key", "name", "master_status", F.coalesce(action, "master_status").alias("final_status"), F.col("l.effective_date").alias("effective_date"), F.coalesce("n_changes", F.lit(0)).cast("long").alias("n_changes"))


def unmatched(master: DataFrame, deltas: DataFrame) -> DataFrame:
    """Deltas with a name that no tier hit."""
    return deltas.filter("entity_name is not null").join(match_names(_collapsed(master), deltas).select("entity_name").distinct(), "entity_name", "left_anti").select(*deltas.columns)


MATCH_TYPES = {1: "Exact", 2: "Normalised", 3: "Alias", 4: "Alias", 5: "Approximate"}


def applied(master: DataFrame, deltas: DataFrame) -> DataFrame:
    """One row per change and master row it meets: the history. Restored reads Active. Order: effective_date, ord."""
    m = _collapsed(master)
    kind = F.create_map(*[F.lit(x) for kv in MATCH_TYPES.items() for x in kv])
    d = deltas.select("ord", "entity_name", "action", "effective_date", "pr_title", "pr_link", "note")
    hit = d.join(match_names(m, deltas), "entity_name").join(m, "master_key")
    status = F.when(F.col("action") == "Restored", "Active").otherwise(F.col("action"))
    return hit.select("master_key", "name", "master_status", "ord", status.alias("status"), "effective_date", "pr_title", "pr_link", "note", F.col("entity_name").alias("pr_name"), kind[F.col("tier")].alias("match_type"))


def with_history(master: DataFrame, h: DataFrame) -> DataFrame:
    """Each master row with its changes h (master_key, history: not empty, in order), its final status, and where that came from."""
    last = F.try_element_at("history", F.lit(-1))
    return _collapsed(master).join(h, "master_key", "left").select(
        "master_key", "name", "master_status", F.coalesce(last["status"], "master_status").alias("final_status"), F.when(F.size("history") > 0, "Yes").otherwise("No").alias("changed"), last["effective_date"].alias("effective_date"),
        F.when(last.isNotNull(), F.concat(F.lit("Press Release ("), F.coalesce(last["pr_title"], F.lit("")), F.lit(")"))).otherwise("Master List").alias("status_source"), "history",
    )


def history(master: DataFrame, deltas: DataFrame) -> DataFrame:
    """Each master row with its changes as an ordered array, its final status, and where that came from."""
    item = F.struct("effective_date", "ord", "status", "pr_title", "pr_link", "note", "pr_name", "match_type")
    return with_history(master, applied(master, deltas).groupBy("master_key").agg(F.array_sort(F.collect_list(item)).alias("history")))


def release_summary(master: DataFrame, deltas: DataFrame) -> DataFrame:
    """Per release (its link, else its title): names expected and extracted, by how they matched. Releases without names are left out."""
    tier = match_names(_collapsed(master), deltas).groupBy("entity_name").agg(F.min("tier").alias("tier"))
    d = deltas.filter("coalesce(entity_name, '') <> ''").withColumn("release", F.coalesce(F.nullif("pr_link", F.lit("")), "pr_title")).join(tier, "entity_name", "left")
    n = lambda *tiers: F.count_if(F.col("tier").isin(*tiers))
    order = F.struct("effective_date", "ord")
    g = d.groupBy("release").agg(
        F.min_by(F.struct("pr_title", "pr_link", "action", "effective_date", "expected_count"), order).alias("f"), F.count("*").alias("extracted"), n(1).alias("exact"), n(2).alias("normalised"), n(3, 4).alias("alias"), n(5).alias("approximate"), F.count_if(F.col("tier").isNull()).alias("not_in_master"),
    )
    expected = F.col("f.expected_count")
    complete = F.when(expected.isNull(), "n/a (no count in title)").when(expected == F.col("extracted"), "Yes").otherwise(F.format_string("No (%d of %d)", "extracted", expected))
    matched = F.col("exact") + F.col("normalised") + F.col("alias") + F.col("approximate")
    return g.select("release", "f.*", "extracted", "exact", "normalised", "alias", "approximate", matched.alias("matched"), "not_in_master", complete.alias("complete"))


def change_log(master: DataFrame, deltas: DataFrame) -> DataFrame:
    """Every change that met the master list, and every one whose release gave no name."""
    named = applied(master, deltas).select("name", F.col("status").alias("action"), "effective_date", "pr_title", "pr_link", F.lit("verify against source press release").alias("flag"), F.coalesce("note", F.lit("")).alias("note"), "pr_name", "match_type")
    lone = deltas.filter("coalesce(entity_name, '') = ''").select(F.lit("(no name extracted)").alias("name"), "action", "effective_date", "pr_title", "pr_link", F.lit("names not extracted automatically").alias("flag"), F.lit("").alias("note"), F.lit("").alias("pr_name"), F.lit("").alias("match_type"))
    return named.unionByName(lone)
