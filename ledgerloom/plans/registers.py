"""Registers, press releases and reports over the test tables, and the same in DuckDB SQL.

Inputs are SQL texts that both engines run alike; the forms to compare are built from what the inputs were made of.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import clean, documents, names as N
from ..operators import ingest, paging, reports, resolve, sections, status
from ..sources import catalog
from ..streaming import status as stream

BASE = "translate(c_name, '#0123456789', 'NABCDEFGHIJ')"
HITS = f"""select c_custkey * 2 as ord, concat({BASE}, case c_custkey % 4 when 0 then ' Limited' when 1 then ' Ltd.' when 2 then ' Private Limited' else ' (P) Ltd' end) as name,
 case c_mktsegment when 'HOUSEHOLD' then 'HFCs' when 'MACHINERY' then 'NBFC' when 'AUTOMOBILE' then 'Private Sector Banks in India' when 'BUILDING' then 'Brokers' else 'ICC' end as category,
 concat('s', cast(c_nationkey as varchar(9))) as source_key, c_custkey as cust from customer
 union all select c_custkey * 2 + 1, concat({BASE}, case c_custkey % 4 when 0 then ' Ltd' when 1 then ' LIMITED' when 2 then ' Pvt. Ltd.' else ' Private Ltd' end),
 case when c_custkey % 2 = 0 then 'Mutual Funds' else 'Brokers' end, 'second', c_custkey from customer where c_custkey % 3 = 0"""
MASTER = f"""select c_custkey as ord, concat({BASE}, ' Private Limited', case when c_custkey % 7 = 0 then concat(' (Formerly known as Old ', {BASE}, ' Ltd)') else '' end) as name,
 case when c_custkey % 5 = 0 then 'Cancelled' else 'Active' end as status from customer"""
DELTAS = f"""select event_id as ord, case event_id % 5 when 0 then concat({BASE}, ' Private Limited', case when c_custkey % 7 = 0 then concat(' (Formerly known as Old ', {BASE}, ' Ltd)') else '' end)
 when 1 then concat('M/s ', upper({BASE}), ' (P) LTD.') when 2 then concat('Old ', {BASE}, ' Ltd') when 3 then concat(replace({BASE}, 'Customer', 'Customar'), ' Private Limited') else concat('Zeta ', {BASE}) end as entity_name,
 case event_type when 'error' then 'Cancelled' when 'signup' then 'Restored' when 'purchase' then 'Surrendered' else 'Suspended' end as action, cast(ts as date) as effective_date,
 concat('RBI on ', event_type) as pr_title, concat('r/', event_type, '/', cast(cast(ts as date) as varchar(10))) as pr_link, cast(null as varchar(9)) as note,
 case when event_type = 'view' then null else cast(day(ts) as int) end as expected_count, user_id from events join customer on user_id = c_custkey where event_type <> 'click'"""


def _sql(spark, sf_dir, text, *tables):
    for t in tables:
        spark.read.parquet(f"{sf_dir}/{t}.parquet").createOrReplaceTempView(t)
    return spark.sql(text)


def _hits(spark, sf_dir):
    h = _sql(spark, sf_dir, HITS, "customer")
    h = h.select("ord", "name", F.col("category").alias("category_return"), F.col("category").alias("category_regulator"), F.lit("R").alias("regulator"), "source_key", F.lit("Active").alias("status"))
    keys = h.select("name", N.canonical_key(F.col("name")).alias("entity_key")).distinct()
    return h, keys, resolve.resolve(h, keys)


def _changes(spark, sf_dir):
    return _sql(spark, sf_dir, MASTER, "customer"), _sql(spark, sf_dir, DELTAS, "customer", "events").drop("user_id")


def membership_rows(spark, sf_dir):
    return reports.membership_rows(*_hits(spark, sf_dir)).drop("category_return")


def multi_category(spark, sf_dir):
    return reports.multi_category(_hits(spark, sf_dir)[2]).withColumn("final_rank", F.col("final_rank").cast("long"))


def source_reconciliation(spark, sf_dir):
    h, keys, resolved = _hits(spark, sf_dir)
    log = h.groupBy("source_key").agg(F.count("*").alias("count")).select("source_key", F.lit("ok").alias("status"), "count", (F.col("count") + F.length("source_key")).alias("expected_count"), F.lit(None).cast("string").alias("note"))
    return reports.source_reconciliation(h, keys, resolved, log)


def final_status(spark, sf_dir):
    h = status.history(*_changes(spark, sf_dir))
    return h.select("name", "master_status", "final_status", "changed", "effective_date", "status_source", F.greatest(F.size("history"), F.lit(0)).cast("long").alias("n_changes"))


def change_log(spark, sf_dir):
    return status.change_log(*_changes(spark, sf_dir))


def release_summary(spark, sf_dir):
    return status.release_summary(*_changes(spark, sf_dir))


def unmatched_mentions(spark, sf_dir):
    return status.unmatched(*_changes(spark, sf_dir)).select("ord", "entity_name", "action", "effective_date", "pr_title", "pr_link")


def latest_status(spark, sf_dir):
    return stream.latest(_changes(spark, sf_dir)[1])


def cut_names(spark, sf_dir):
    d = _sql(spark, sf_dir, f"select c_custkey, concat({BASE}, ' Private  Limited, India Plot 12 Fort, Mumbai') as t from customer", "customer")
    return d.select("c_custkey", clean.cut_at_legal_form(F.col("t")).alias("legal"), clean.cut_at_address(F.col("t")).alias("address"), clean.cut_at_first_suffix(F.col("t")).alias("suffix"), clean.sheet_key(F.col("t")).alias("sheet_key"))


def title_rules(spark, sf_dir):
    d = _sql(spark, sf_dir, TITLES, "events")
    return d.select("event_id", clean.expected_count(F.col("title")).alias("expected_count"), clean.action(F.col("title")).alias("action"), clean.relevant_title(F.col("title")).alias("relevant"))


TITLES = """select event_id, event_type, case event_type when 'error' then concat('RBI cancels Certificate of Registration of ', cast(event_id % 40 as varchar(9)), ' NBFCs') when 'signup' then 'Restoration of CoR of two NBFCs'
 when 'purchase' then 'Twenty HFCs surrender registration certificate' when 'view' then 'Guidelines for suspended NBFCs' else 'Daily bulletin' end as title from events"""


def reporting_category(spark, sf_dir):
    d = _sql(spark, sf_dir, CLASSES, "customer")
    c = clean.reporting_category(F.col("source_key"), F.lit("NBFC"), F.lit("Other NBFCs"), F.col("name"), F.col("classification"))
    return d.select("c_custkey", c["category_regulator"].alias("category"), c["category_return"].alias("category_return"))


CLASSES = f"""select c_custkey, case when c_custkey % 2 = 0 then 'rbi_nbfc' else 'other' end as source_key, concat({BASE}, case when c_custkey % 3 = 0 then ' ARC Ltd' when c_custkey % 3 = 1 then ' Arc Ltd' else ' Asset Reconstruction Ltd' end) as name,
 case c_custkey % 5 when 0 then 'HFC' when 1 then 'ICC' when 2 then 'ARC' when 3 then '' end as classification from customer"""


def html_tables_roundtrip(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/supplier.parquet").select("s_nationkey", F.col("s_suppkey").alias("k"), F.format_string("<tr><td>%d</td><td>%s &amp; Co. Ltd</td></tr>", "s_suppkey", "s_name").alias("r"))
    page = rows.groupBy("s_nationkey").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", "r"))), lambda x: x["r"]), "").alias("h"))
    html = F.concat(F.lit("<table><tr><th>Sr No</th><th>Name</th></tr>"), "h", F.lit("</table>"))
    return page.select("s_nationkey", F.posexplode(documents.table_names(html)).alias("pos", "name"))


def numbered_roundtrip(spark, sf_dir):
    """Suppliers of each nation as one numbered line each, with a number in the address that must not begin an entry."""
    s = spark.read.parquet(f"{sf_dir}/supplier.parquet").select("s_nationkey", "s_suppkey", F.translate("s_name", "#0123456789", "NABCDEFGHIJ").alias("n"))
    page = s.groupBy("s_nationkey").agg(F.array_sort(F.collect_list(F.struct("s_suppkey", "n"))).alias("a"))
    line = F.array_join(F.transform("a", lambda x, i: F.concat((i + 1).cast("string"), F.lit(". "), x["n"], F.lit(" Bank Ltd. Plot No. 99. Sector"))), "\n")
    e = page.select("s_nationkey", F.posexplode(documents.numbered_entries(line, reject=sections.REJECT)).alias("pos", "e"))
    return e.select("s_nationkey", "pos", clean.cut_at_first_suffix(F.col("e")).alias("name"))


def page_links(spark, sf_dir):
    p = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", documents.html_links(F.col("html")).alias("l"))
    return p.select("page_id", F.size("l").cast("long").alias("n_links"), clean.absolute_url(F.get("l", F.lit(0))["href"], F.col("url")).alias("first_link"))


def month_walk(spark, sf_dir):
    o = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", F.col("o_orderdate").cast("date").alias("d"))
    stated = N.master_list_date(F.concat(F.lit("List as on "), F.date_format("d", "MMMM d, yyyy")))
    return o.select("o_orderkey", stated.alias("stated"), F.explode(catalog.months(stated, F.date_add("d", 75))).alias("month"))


def paged_listing(spark, sf_dir):
    return paging.table_pages(_sql(spark, sf_dir, PAGED, "orders").groupBy("source_key", "page_ix").agg(F.collect_set("name").alias("names"))).select("source_key", "page_ix", "n_new")


PAGED = """select o_orderstatus as source_key, cast(floor((row_number() over (partition by o_orderstatus order by o_orderkey) - 1) / 25) + 1 as bigint) as page_ix, concat('N', cast(o_custkey as varchar(12))) as name from orders"""


def file_stats(spark, sf_dir):
    return paging.file_stats(_sql(spark, sf_dir, FILES, "orders"))


FILES = "select o_orderstatus as file, case when o_orderkey % 11 = 0 then '  ' when o_orderkey % 11 = 1 then 'Sl. No.' when o_orderkey % 11 = 2 then repeat('x', 200) else concat('N', cast(o_custkey as varchar(12))) end as name from orders"


def ingested_hits(spark, sf_dir):
    return _ingest(spark, sf_dir).hits.select("name", "source_key", "category_regulator", "category_return", "regulator", "status")


def run_log(spark, sf_dir):
    return _ingest(spark, sf_dir).run_log.select("source_key", "status", "count")


def publish_gate(spark, sf_dir):
    return ingest.may_publish(_ingest(spark, sf_dir).run_log)


SCRAPED = f"""select c_custkey as ord, case c_custkey % 3 when 0 then 'rbi_nbfc' when 1 then 'irdai_brokers' else 'irdai_health' end as source_key, case when c_custkey % 9 = 0 then 'Name of the Company' when c_custkey % 4 = 0 then concat('. , / ', {BASE}, ' Ltd') else concat({BASE}, ' Ltd') end as name,
 case when c_custkey % 5 = 0 then 'HFC' end as classification from customer"""


def _ingest(spark, sf_dir):
    scraped = _sql(spark, sf_dir, SCRAPED, "customer")
    runs = spark.createDataFrame([("rbi_nbfc", "ok", None, None), ("irdai_brokers", "ok", 5, None), ("irdai_health", "ok", None, None), ("sebi_mutual_funds", "error", 62, "HTTP 403"), ("rbi_nbfc_cancelled", "ok", None, None)], "source_key string, status string, expected_count int, note string")
    old = spark.read.parquet(f"{sf_dir}/supplier.parquet").select(F.lit("sebi_mutual_funds").alias("source_key"), F.concat("s_name", F.lit(" AMC")).alias("name"), F.lit("Mutual Funds").alias("category"), F.lit("Old").alias("status"))
    return ingest.ingest(scraped, runs, catalog.sources(spark), catalog.seeds(spark), old)


QUERIES = {f.__name__: f for f in (
    membership_rows, multi_category, source_reconciliation, final_status, change_log, release_summary, unmatched_mentions, latest_status, cut_names, title_rules, reporting_category,
    html_tables_roundtrip, numbered_roundtrip, page_links, month_walk, paged_listing, file_stats, ingested_hits, run_log, publish_gate,
)}

_RANK = "case category when 'HFCs' then 7 when 'Private Sector Banks in India' then 2 when 'Mutual Funds' then 5 when 'Brokers' then 10 else 8 end"
_ENTITIES = f"""h as (select *, concat(upper({BASE}), case when cust % 4 < 2 then 'LTD' else 'PVTLTD' end) as entity_key, {_RANK} as rank from ({HITS}) join customer on c_custkey = cust),
 r as (select entity_key, arg_min(source_key, (rank, ord)) as winner, arg_min(category, (rank, ord)) as final_category, min(rank) as final_rank, arg_min(name, ord) as name, string_agg(category, ' | ' order by ord) as all_categories,
 string_agg(category || ' (rank ' || rank || ', R)', '  |  ' order by rank, ord) as all_memberships, count(distinct category) as category_count from h group by entity_key)"""
_TIERS = f"""d as (select *, case ord % 5 when 0 then 'Exact' when 1 then 'Normalised' when 2 then case when user_id % 7 = 0 then 'Alias' end when 3 then 'Approximate' end as match_type, case action when 'Restored' then 'Active' else action end as new_status from ({DELTAS})),
 m as (select * from ({MASTER}))"""
_SEEDS = " union all ".join(f"select '{n}' as name" for n in catalog.SEEDS["irdai_health"])
_HITS_SQL = f"""select distinct case when ord % 4 = 0 then substr(name, 7) else name end as name, source_key, case when ord % 4 <> 0 and classification = 'HFC' then 'HFCs' when source_key = 'rbi_nbfc' then 'NBFC' when source_key = 'irdai_brokers' then 'Brokers' else 'Health insurer' end as category_regulator,
 case when ord % 4 <> 0 and classification = 'HFC' then 'Housing Finance Companies' when source_key = 'rbi_nbfc' then 'Other NBFCs' when source_key = 'irdai_brokers' then 'Other Financial Entities' else 'Insurance Companies' end as category_return,
 case when source_key = 'rbi_nbfc' then 'RBI' else 'IRDAI' end as regulator, 'Active' as status from ({SCRAPED}) where ord % 9 <> 0
 union all select name, 'irdai_health', 'Health insurer', 'Insurance Companies', 'IRDAI', 'Active' from ({_SEEDS})
 union all select s_name || ' AMC', 'sebi_mutual_funds', 'Mutual Funds', 'Mutual Fund Companies', 'SEBI', 'Old' from supplier"""

ORACLE = {
    "membership_rows": f"""with {_ENTITIES} select h.ord, h.name, h.category, 'R' as regulator, 'Active' as status, all_categories, category_count, h.source_key, case when winner = h.source_key then 'Yes' else 'No' end as is_final, entity_key from h join r using (entity_key)""",
    "multi_category": f"with {_ENTITIES} select entity_key, name, final_category, cast(final_rank as bigint) as final_rank, all_memberships from r where category_count > 1",
    "source_reconciliation": f"""with {_ENTITIES} select source_key, 'ok' as status, count(*) + length(source_key) as portal_count, count(*) as scraped, -length(source_key) as diff, count(distinct entity_key) as unique_entities, count(distinct entity_key) as combine_rows,
        count(distinct entity_key) - count(distinct case when winner = source_key then entity_key end) as held_back, '' as note from h join r using (entity_key) group by source_key""",
    "final_status": f"""with {_TIERS}, l as (select user_id, arg_max(new_status, (effective_date, ord)) as s, max(effective_date) as effective_date, arg_max(pr_title, (effective_date, ord)) as t, count(*) as n from d where match_type is not null group by user_id)
        select name, status as master_status, coalesce(s, status) as final_status, case when n > 0 then 'Yes' else 'No' end as changed, effective_date, case when n > 0 then 'Press Release (' || t || ')' else 'Master List' end as status_source, coalesce(n, 0) as n_changes from m left join l on m.ord = l.user_id""",
    "change_log": f"""with {_TIERS} select m.name, new_status as action, effective_date, pr_title, pr_link, 'verify against source press release' as flag, '' as note, entity_name as pr_name, match_type from d join m on d.user_id = m.ord where match_type is not null""",
    "release_summary": f"""with {_TIERS} select pr_link as release, any_value(pr_title) as pr_title, pr_link, any_value(action) as action, any_value(effective_date) as effective_date, max(expected_count) as expected_count, count(*) as extracted, count(case when match_type = 'Exact' then 1 end) as exact, count(case when match_type = 'Normalised' then 1 end) as normalised,
        count(case when match_type = 'Alias' then 1 end) as alias, count(case when match_type = 'Approximate' then 1 end) as approximate, count(match_type) as matched, count(*) - count(match_type) as not_in_master,
        case when max(expected_count) is null then 'n/a (no count in title)' when max(expected_count) = count(*) then 'Yes' else 'No (' || count(*) || ' of ' || max(expected_count) || ')' end as complete from d group by pr_link""",
    "unmatched_mentions": f"with {_TIERS} select ord, entity_name, action, effective_date, pr_title, pr_link from d where match_type is null",
    "latest_status": f"""with {_TIERS}, k as (select *, case ord % 5 when 2 then 'OLD' || upper(substr(entity_name, 5, length(entity_name) - 8)) || 'LTD' when 4 then upper(replace(entity_name, ' ', '')) when 3 then upper(split_part(entity_name, ' ', 1)) || 'PVTLTD'
        when 1 then split_part(entity_name, ' ', 2) || 'PVTLTD' else upper(split_part(entity_name, ' ', 1)) || 'PVTLTD' end as entity_key from d)
        select entity_key, arg_max(new_status, (effective_date, ord)) as status, max(effective_date) as effective_date, count(*) as n_changes from k group by entity_key""",
    "cut_names": f"select c_custkey, {BASE} || ' Private Limited, India' as legal, {BASE} || ' Private Limited' as address, {BASE} || ' Private Limited' as suffix, upper({BASE}) || ' PRIVATE LIMITED INDIA PLOT 12 FORT MUMBAI' as sheet_key from customer",
    "title_rules": f"""select event_id, cast(case event_type when 'error' then event_id % 40 when 'signup' then 2 when 'purchase' then 20 end as int) as expected_count, case event_type when 'error' then 'Cancelled' when 'signup' then 'Restored' when 'purchase' then 'Surrendered' when 'view' then 'Suspended' end as action,
        event_type in ('error', 'signup', 'purchase') as relevant from ({TITLES})""",
    "reporting_category": f"""select c_custkey, case when c_custkey % 5 = 0 then 'HFCs' when c_custkey % 2 = 0 and (c_custkey % 5 = 2 or c_custkey % 3 <> 1) then 'ARC' when coalesce(classification, '') = '' then 'NBFC' else classification end as category,
        case when c_custkey % 5 = 0 then 'Housing Finance Companies' when c_custkey % 2 = 0 and (c_custkey % 5 = 2 or c_custkey % 3 <> 1) then 'Other Financial Entities' else 'Other NBFCs' end as category_return from ({CLASSES})""",
    "html_tables_roundtrip": "select s_nationkey, cast(row_number() over (partition by s_nationkey order by s_suppkey) - 1 as int) as pos, s_name || ' & Co. Ltd' as name from supplier",
    "numbered_roundtrip": "select s_nationkey, cast(row_number() over (partition by s_nationkey order by s_suppkey) - 1 as int) as pos, translate(s_name, '#0123456789', 'NABCDEFGHIJ') || ' Bank Ltd.' as name from supplier",
    "page_links": r"""select page_id, cast(len(regexp_extract_all(html, '<a href="([^"]*)"', 1)) as bigint) as n_links, regexp_extract(url, '^[a-z]+://[^/?#]+') || regexp_extract(html, '<a href="([^"]*)"', 1) as first_link from pages""",
    "month_walk": "select o_orderkey, cast(o_orderdate as date) as stated, cast(unnest(generate_series(date_trunc('month', o_orderdate), date_trunc('month', o_orderdate + interval 75 day), interval 1 month)) as date) as month from orders",
    "paged_listing": f"""with p as (select * from ({PAGED}) where page_ix <= 80), f as (select source_key, name, min(page_ix) as page_ix from p group by all), n as (select source_key, page_ix, count(*) as n_new from f group by all),
        g as (select distinct source_key, page_ix from p), w as (select source_key, page_ix, coalesce(n_new, 0) as n_new, min(case when n_new is null then page_ix end) over (partition by source_key) as stop from g left join n using (source_key, page_ix))
        select source_key, page_ix, n_new from w where stop is null or page_ix < stop""",
    "file_stats": f"""select file, count(*) as data_rows, count_if(trim(name) = '') as blank, count_if(name = 'Sl. No.') as serial, count_if(length(name) = 200) as too_long, count(distinct case when name like 'N%' then name end) as unique_names, count_if(name like 'N%') - count(distinct case when name like 'N%' then name end) as repeated from ({FILES}) group by file""",
    "ingested_hits": _HITS_SQL,
    "run_log": f"""select k as source_key, case when k = 'sebi_mutual_funds' then 'stale_previous_run' when count(h.name) = 0 then 'empty' else 'ok' end as status, count(h.name) as count from (select unnest(['rbi_nbfc', 'irdai_brokers', 'irdai_health', 'sebi_mutual_funds', 'rbi_nbfc_cancelled']) as k) left join ({_HITS_SQL}) h on h.source_key = k group by k""",
    "publish_gate": "select false as publish, 'rbi_nbfc_cancelled' as missing, 'sebi_mutual_funds' as stale",
}
