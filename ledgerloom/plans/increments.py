"""Runs that go on from earlier ones, over the test tables, and what a run over everything gives, in DuckDB SQL."""

from __future__ import annotations

import datetime
import uuid

from pyspark.sql import functions as F

from ..functions import tabular
from ..operators import entities, reports
from ..operators.components import durable, shared_dir
from ..operators.forest import Forest
from ..sources import parsed, registers as source, staged, versions
from ..streaming import catchup, history as H
from . import pages, registers
from .pages import CHAINS, SUPPLIERS
from .registers import DELTAS, _sql

# Every tenth change is withdrawn, every tenth corrected.
FIXED = f"""select ord, entity_name, case when ord % 10 = 5 then 'Cancelled' else action end as action, case when ord % 10 = 5 then date_add(effective_date, 1) else effective_date end as effective_date, pr_title, pr_link, note, expected_count, user_id
 from ({DELTAS}) x where ord % 10 <> 0"""


def _fresh(spark, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def streamed_history(spark, sf_dir):
    """Changes, corrections and withdrawals in two arrivals without order, a correction often before what it corrects; the state takes them back."""
    base = _fresh(spark, "history")
    master, told = registers._changes(spark, sf_dir)
    fixed = spark.sql(FIXED).filter("ord % 10 = 5")
    rows = H.versioned(told).union(H.versioned(fixed, F.lit(2))).union(H.versioned(told.filter("ord % 10 = 0"), F.lit(2), F.lit(True)))
    rows = durable(rows.withColumn("arrival", F.pmod(F.xxhash64("release_ord", "version"), F.lit(2))))
    master = durable(master)
    for i in range(2):
        rows.filter(F.col("arrival") == i).drop("arrival").write.parquet(f"{base}/in/batch={i}")
        H.match_stream(H.read_batches(spark, f"{base}/in", H.VERSIONED), master, f"{base}/matched", f"{base}/state-matched").awaitTermination()
        H.start(H.track(H.read_batches(spark, f"{base}/matched", H.MATCHED)), f"{base}/history", f"{base}/state-history").awaitTermination()
    h = H.now(master, H.read_updates(spark, f"{base}/history"))
    last = F.try_element_at("history", F.lit(-1))
    return h.select("name", "master_status", "final_status", "changed", "effective_date", "status_source", F.greatest(F.size("history"), F.lit(0)).cast("long").alias("n_changes"), last["pr_name"].alias("last_name"))


def streamed_feeds(spark, sf_dir):
    """The feed comes first and is published; what the archive has as well is taken back when it comes."""
    base = _fresh(spark, "feeds")
    archive, feed = pages._feeds(spark, sf_dir)
    for name, rows in (("feed", feed), ("archive", archive)):
        H.flat(rows).write.parquet(f"{base}/{name}/batch=0")
        both = (H.read_batches(spark, f"{base}/{x}", H.CHANGE) for x in ("archive", "feed"))
        H.start(H.merge_feeds(*both), f"{base}/merged", f"{base}/state").awaitTermination()
    merged = spark.read.schema(f"{H.VERSIONED}, batch long").parquet(f"{base}/merged")
    return H.standing(merged).select(F.col("release_ord").alias("ord"), "entity_name", "pr_link")


def staged_month(spark, sf_dir, month: str):
    """Files of a month: a listing of a third of the nations' releases and the pages of these; in March also the feed, with what it has in common."""
    m = datetime.date.fromisoformat(f"{month}-01")
    third = m.month % 3 - 2 if m.month == 2 else 1
    row = f"concat('<tr><td>Date : {m:%b} ', n * 7 % 28 + 1, ', 2024</td><td><a href=\"x.aspx?prid=', k, '\">RBI cancels CoR of one NBFC</a></td></tr>')"
    item = f"concat('<item><title>RBI cancels CoR of one NBFC</title><link>https://r.in/x.aspx?prid=', k, '</link><pubDate>Mon, ', n * 7 % 28 + 1, ' {m:%b} 2024 10:00:00</pubDate></item>')"
    p = pages._lines(spark, sf_dir, row, item)
    utf8 = lambda c: F.encode(c, "UTF-8").alias("content")
    lists = p.filter(F.col("nation") % 3 == third).select(F.lit("rbi_releases").alias("source_key"), F.lit(f"in/rbi_releases/{month}.html").alias("path"), utf8(F.concat(F.lit("<html><table>"), pages._join("a0"), F.lit("</table>"))))
    feed = p.filter("nation % 3 > 0").select(F.lit("rbi_feed"), F.concat(F.lit("in/rbi_feed/"), F.col("nation").cast("string"), F.lit(".xml")), utf8(pages._join("a1")))
    own = F.col("nation") % 3 == 0 if m.month == 2 else F.col("nation") % 3 > 0
    leaf = _sql(spark, sf_dir, SUPPLIERS, "supplier").filter(own).select(F.lit("rbi_release_pages"), F.concat(F.lit("in/rbi_release_pages/prid-"), "k", F.lit(".html")), utf8(F.concat(F.lit("<html><table><tr><td>Sr</td><td>Name of the company</td></tr><tr><td>1</td><td>"), "w", F.lit(" Finance Limited</td></tr></table>"))))
    files = lists.union(leaf) if m.month == 2 else lists.union(leaf).union(feed)
    return files.withColumns({"month": F.lit(month), "modified": F.lit("2024-04-01").cast("timestamp"), "kind": F.lit("html")})


def streamed_catch_up(spark, sf_dir):
    """Two runs, a month each: the second one reads the new month alone, and the feed gives way to it."""
    base = _fresh(spark, "catch-up")
    master = durable(_sql(spark, sf_dir, f"select k as ord, concat(w, ' Finance Ltd') as name, 'Active' as status from ({SUPPLIERS})", "supplier"))
    got = None
    for month in ("2024-02", "2024-03"):
        staged.stage(staged_month(spark, sf_dir, month), f"{base}/raw")
        got = catchup.catch_up(spark, f"{base}/raw", f"{base}/work", master, datetime.date(2024, 2, 10), "https://r.in/")
    return got.final.select("name", "final_status", "effective_date", F.greatest(F.size("history"), F.lit(0)).cast("long").alias("n_changes"))


def grown_components(spark, sf_dir):
    """Former names come in three additions, slips with the last; entities merge as they come."""
    c = _sql(spark, sf_dir, CHAINS, "customer")
    d = durable(entities.keyed(c))
    edge = F.col("a").alias("u"), F.col("b").alias("v")
    alias = entities.alias_edges(d).select(*edge)
    slips = entities.slips(d.select(F.col("pk").alias("k")).union(alias.select("v"))).select(*edge)
    forest = Forest(spark, _fresh(spark, "forest"))
    forest.add(d.select(F.col("pk").alias("u"), F.col("pk").alias("v")))
    part = F.pmod(F.xxhash64("u", "v"), F.lit(2))
    forest.add(alias.filter(part == 0))
    forest.add(alias.filter(part == 1).union(slips))
    keys = d.join(forest.components(), d.pk == F.col("node")).select("name", F.col("root").alias("entity_key"))
    return c.join(keys, "name").select("id", "name", "entity_key")


def published_versions(spark, sf_dir):
    """A second run replaces half of the sources; the others keep the rows of the first, which stays readable. Styles are columns."""
    rows = durable(reports.membership_rows(*registers._hits(spark, sf_dir)).drop("category_return", "ord"))
    v = versions.Versions(spark, _fresh(spark, "versions"))
    key = {"combine_list": "source_key"}
    v.commit(versions.with_styles({"combine_list": rows}), key)
    again = rows.filter(F.length("source_key") % 2 == 0).withColumn("status", F.lit("Checked"))
    v.commit(versions.with_styles({"combine_list": again}), key)
    read = lambda n: v.read("combine_list", n).select(F.lit(n).cast("long").alias("version"), "source_key", "name", "status", "muted", "highlighted")
    return read(0).union(read(1))


def parsed_once(spark, sf_dir):
    """Pages are parsed in two runs; the second parses only contents that the first has not met."""
    p = spark.read.parquet(f"{sf_dir}/pages.parquet").select(F.col("page_id").cast("string").alias("path"), "page_id", F.encode("html", "UTF-8").alias("content"))
    store = _fresh(spark, "parsed")
    parsed.parse(p.filter("page_id % 2 = 0"), store)
    got = parsed.parse(p, store)
    return got.files.join(p.select("path", "page_id"), "path").select("page_id", F.size("out.links").cast("long").alias("links"), "now")


def registers_source(spark, sf_dir):
    """Register files written out and read by the data source, with filters on the register and the page."""
    folder = _fresh(spark, "registers")
    s = _sql(spark, sf_dir, SUPPLIERS, "supplier")
    files = s.select(F.concat(F.lit("r"), "nation").alias("source_key"), F.concat(F.lit("0-"), "n", F.lit(".html")).alias("file"), F.encode(F.concat(F.lit("<p>"), "w", F.lit("</p>")), "UTF-8").alias("content"))
    source.write_files(files, folder)
    source.register(spark)
    d = spark.read.format("registers").load(folder).filter("source_key in ('r1', 'r2', 'r3') and page_ix >= 2 and size > 5")
    return d.select("source_key", F.col("page_ix").cast("long").alias("page_ix"), F.col("content").cast("string").alias("html"))


def in_sequence_sql(spark, sf_dir):
    """Numbered entries that carry their list on, by the table function from SQL: stray numbers between them fall out."""
    tabular.register(spark)
    marks = _sql(spark, sf_dir, f"""select nation as doc_id, n * 2 as pos, cast(n as int) as number, w as body from ({SUPPLIERS})
        union all select nation, n * 2 + 1, cast(n + 40 + n % 5 as int), 'stray' from ({SUPPLIERS})""", "supplier")  # fmt: skip
    marks.createOrReplaceTempView("marks")
    return spark.sql("select doc_id as nation, number, body from in_sequence(table(marks), false)")


QUERIES = {f.__name__: f for f in (streamed_history, streamed_feeds, streamed_catch_up, grown_components, published_versions, parsed_once, registers_source, in_sequence_sql)}

_T = registers._TIERS.replace(f"({DELTAS})", f"({FIXED.replace('date_add(effective_date, 1)', 'cast(effective_date + 1 as date)')})")
ORACLE = {
    "streamed_history": f"""with {_T}, l as (select user_id, arg_max(new_status, (effective_date, ord)) as s, max(effective_date) as effective_date, arg_max(pr_title, (effective_date, ord)) as t, arg_max(entity_name, (effective_date, ord)) as e, count(*) as n from d where match_type is not null group by user_id)
        select name, status as master_status, coalesce(s, status) as final_status, case when n > 0 then 'Yes' else 'No' end as changed, effective_date, case when n > 0 then 'Press Release (' || t || ')' else 'Master List' end as status_source, coalesce(n, 0) as n_changes, e as last_name from m left join l on m.ord = l.user_id""",
    "streamed_feeds": pages.ORACLE["feed_union_dedupe"],
    "streamed_catch_up": f"""with s as (select *, cast(n * 7 % 28 as int) as d from ({SUPPLIERS})), t as (select w, case when nation % 3 = 0 then date '2024-02-01' + d else date '2024-03-01' + d end as day from s)
        select w || ' Finance Ltd' as name, case when day >= date '2024-02-10' then 'Cancelled' else 'Active' end as final_status, case when day >= date '2024-02-10' then day end as effective_date, case when day >= date '2024-02-10' then 1::bigint else 0::bigint end as n_changes from t""",
    "grown_components": pages.ORACLE["entity_components"],
    "published_versions": f"""with r as (select 0::bigint as version, * from ({registers.ORACLE['membership_rows']}) union all select 1::bigint, * from ({registers.ORACLE['membership_rows']}))
        select version, source_key, name, case when version = 1 and length(source_key) % 2 = 0 then 'Checked' else status end as status, is_final = 'No' as muted, is_final <> 'No' and category_count > 1 as highlighted from r""",
    "parsed_once": """select page_id, cast(len(regexp_extract_all(html, '<a href="')) as bigint) as links, html not in (select html from pages where page_id % 2 = 0) as now from pages""",
    "registers_source": f"select 'r' || nation as source_key, cast(n as bigint) as page_ix, '<p>' || w || '</p>' as html from ({SUPPLIERS}) where nation in (1, 2, 3) and n >= 2",
    "in_sequence_sql": f"select nation, cast(n as int) as number, w as body from ({SUPPLIERS})",
}
