"""Queries over the test tables, and the same in DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import names as N
from ..operators import entities, resolve, status

# Names as registries write them, from customer rows; the same text runs on both engines.
RAW = """select c_custkey as ord, case c_custkey % 4 when 0 then concat('M/s ', c_name, ' Private Limited') when 1 then concat('The ', c_name, ' & Co. Pvt. Ltd.')
 when 2 then concat(c_name, ' Limited (Formerly known as Old ', c_name, ' Ltd)') else concat(replace(c_name, '#', ' '), ' (P) Ltd') end as name,
 case c_mktsegment when 'HOUSEHOLD' then 'HFCs' when 'MACHINERY' then 'NBFC' when 'AUTOMOBILE' then 'Private Sector Banks in India' when 'BUILDING' then 'Brokers' else 'ICC' end as category,
 c_nationkey as nation from customer"""


def _raw(spark, sf_dir):
    spark.read.parquet(f"{sf_dir}/customer.parquet").createOrReplaceTempView("customer")
    return spark.sql(RAW)


def name_keys(spark, sf_dir):
    c = F.col("name")
    return _raw(spark, sf_dir).select("ord", N.normalize_name(c).alias("legacy"), N.canonical_key(c).alias("canonical"), N.split_annotations(c)["primary"].alias("primary_name"), N.is_english_name(c).alias("english"), N.digits_of(c).alias("digits"))


def category_ranks(spark, sf_dir):
    return _raw(spark, sf_dir).select("ord", "category", resolve.category_rank(F.col("category")).cast("long").alias("rank"))


def _hits(spark, sf_dir):
    return _raw(spark, sf_dir).select("ord", "name", F.col("category").alias("category_return"), F.col("category").alias("category_regulator"), F.col("nation").cast("string").alias("regulator"), F.col("nation").cast("string").alias("source_key"), F.lit("Active").alias("status"))


def registry_resolved(spark, sf_dir):
    """Entity by canonical key of the repaired name, aliases and slips. The names hold distinct numbers, so no two are one entity."""
    h = _hits(spark, sf_dir)
    return resolve.resolve(h, entities.entity_keys(h)).drop("memberships")


def resolved_by_nation(spark, sf_dir):
    h = _hits(spark, sf_dir)
    keys = h.select("name", "source_key").distinct().withColumnRenamed("source_key", "entity_key")
    return resolve.resolve(h, keys).select("entity_key", "name", "category", F.col("final_rank").cast("long").alias("final_rank"), "category_count")


def status_reconciled(spark, sf_dir):
    """Customers as master list; their orders as dated changes under another spelling of the name."""
    master = spark.read.parquet(f"{sf_dir}/customer.parquet").select(F.col("c_custkey").alias("ord"), F.concat("c_name", F.lit(" Private Limited")).alias("name"), F.lit("Active").alias("status"))
    o = spark.read.parquet(f"{sf_dir}/orders.parquet").join(master.select(F.col("ord").alias("o_custkey"), "name"), "o_custkey")
    action = F.when(F.col("o_orderstatus") == "F", "Cancelled").when(F.col("o_orderstatus") == "P", "Restored").otherwise("Suspended")
    spelling = F.regexp_replace(F.upper("name"), "PRIVATE LIMITED", "(P) Ltd.")
    return status.reconcile(master, o.select(F.col("o_orderkey").alias("ord"), spelling.alias("entity_name"), action.alias("action"), F.col("o_orderdate").cast("date").alias("effective_date")))


QUERIES = {f.__name__: f for f in (name_keys, category_ranks, registry_resolved, resolved_by_nation, status_reconciled)}

_RANK = "case category when 'HFCs' then 7 when 'NBFC' then 8 when 'ICC' then 8 when 'Brokers' then 10 else 2 end"
_CANON = "upper(name)"
for _p, _t in ((r"^\s*(?:M/S\.?|MESSRS\.?)\s+", ""), ("&", " AND "), (r"[.,;:/\\\-_\"()\[\]]", " "), (r"\s+", " "), (r"^\s+|\s+$", ""), (r"^THE\s+", ""), (r"(?:\bP|PRIVATE|PVT)\s*(?:LIMITED|LTD)\s*$", "PVTLTD"), (r"\bPRIVATE\b", "PVT"), (r"\s*\bLIMITED\s*$", " LTD"), ("[^A-Z0-9]", "")):
    _CANON = f"regexp_replace({_CANON}, '{_p}', '{_t}', 'g')"

ORACLE = {
    "registry_resolved": f"""select {_CANON.replace("upper(name)", "upper(p)", 1)} as entity_key, name, category, category as category_return, cast(nation as varchar) as regulator, cast(nation as varchar) as source_key, 'Active' as status,
        cast({_RANK} as int) as final_rank, category as all_categories, cast(1 as bigint) as category_count from (select *, regexp_replace(name, ' \\(Formerly.*', '') as p from ({RAW}))""",
    "name_keys": f"""select ord, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(upper(name), '[.,()]', '', 'g'), '\\bPRIVATE\\b', 'PVT', 'g'), '\\bLIMITED\\b', 'LTD', 'g'), '\\s+', ' ', 'g')) as legacy,
        {_CANON} as canonical, trim(regexp_replace(regexp_replace(replace(name, '(P)', ' PVT '), '\\(Formerly[^)]*\\)', ' '), '\\s+', ' ', 'g')) as primary_name,
        len(regexp_extract_all(name, '[A-Za-z]')) >= 3 as english, regexp_replace(name, '[^0-9]', '', 'g') as digits from ({RAW})""",
    "category_ranks": f"select ord, category, cast({_RANK} as bigint) as rank from ({RAW})",
    "resolved_by_nation": f"""select cast(nation as varchar) as entity_key, arg_min(name, ord) as name, arg_min(category, {_RANK} * 1000000000000 + ord) as category, cast(min({_RANK}) as bigint) as final_rank, count(distinct category) as category_count from ({RAW}) group by nation""",
    "status_reconciled": """with m as (select c_custkey, c_name || ' Private Limited' as name, upper(c_name) || ' PVT LTD' as master_key from customer),
        l as (select o_custkey, arg_max(o_orderstatus, (cast(o_orderdate as date), o_orderkey)) as s, max(cast(o_orderdate as date)) as d, count(*) as n from orders group by o_custkey)
        select master_key, name, 'Active' as master_status, case s when 'F' then 'Cancelled' when 'O' then 'Suspended' else 'Active' end as final_status, d as effective_date, coalesce(n, 0) as n_changes
        from m left join l on m.c_custkey = l.o_custkey""",
}
