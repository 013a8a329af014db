"""One run of the registry: from a folder of staged files to the report relations."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import names as N
from ..operators import entities, ingest, releases, reports, resolve, scans, status
from ..operators.components import durable
from ..sources import catalog, staged
from ..sources.versions import Versions, with_styles

PREVIOUS = "source_key string, name string, category string, status string"


def master_date(runs: DataFrame, override: datetime.date | None = None) -> datetime.date | None:
    """The master list's day: the one given, else the one its title states, else none (then no release is applied)."""
    if override:
        return override
    titled = runs.filter(F.col("source_key").isin(*ingest.MASTER) & (F.col("status") == "ok")).select("source_key", N.master_list_date(F.col("title")).alias("day")).filter("day is not null")
    first = titled.orderBy("source_key").first()
    return first.day if first else None


def _number(link):
    return F.regexp_extract(link, r"(?i)prid[=-](\d+)", 1)


def _text():
    return F.decode("content", "UTF-8")


def _numbered(pages: DataFrame) -> DataFrame:
    return pages.select(_number(F.col("path")).alias("number"), _text().alias("html"))


def archive_releases(listings: DataFrame, pages: DataFrame, since: datetime.date, base: str) -> DataFrame:
    """Releases of staged listings (path, content), which are named by month, with their staged pages (path, content), named by number."""
    month = F.to_date(F.concat(F.regexp_extract("path", r"(\d{4}-\d{2})\.[^./]*$", 1), F.lit("-01")))
    entries = staged.listing_entries(listings.select(month.alias("month"), F.lit(base).alias("base"), _text().alias("html")))
    entries = entries.withColumn("ord", (F.year("month") * 12 + F.month("month")).cast("long") * 1_000_000 + F.col("pos"))
    return releases.relevant(entries, F.lit(since), True).withColumn("number", _number(F.col("link"))).join(_numbered(pages), "number", "left").select("ord", "title", "link", "action", "effective_date", "html")


def feed_releases(feeds: DataFrame, pages: DataFrame, since: datetime.date) -> DataFrame:
    """Releases of staged feeds (path, content); those without a staged page keep their description. Items of one feed keep their order."""
    items = staged.feed_items(feeds.select(F.col("path").alias("feed"), _text().alias("xml")))
    at = F.lit(1 << 60) + F.pmod(F.xxhash64("feed"), F.lit(1 << 30)) * (1 << 20) + F.col("pos")
    items = releases.relevant(items.withColumnRenamed("pub_date", "effective_date").withColumn("ord", at), F.lit(since), False)
    return items.withColumn("number", _number(F.col("link"))).join(_numbered(pages), "number", "left").select("ord", "title", "link", "action", "effective_date", F.coalesce("html", "description").alias("html"))


def changes(files: DataFrame, since: datetime.date, until: datetime.date, base: str) -> tuple[DataFrame, DataFrame]:
    """Dated changes since the master list, and the releases they come from.

    Listings are staged by month (rbi_releases/<year>-<month>.html); those from the master list's month to `until` are walked. Releases are
    staged by number (rbi_release_pages/prid-<number>.html). The feed (rbi_feed) adds what the archive lacks.
    """
    month = F.to_date(F.concat(F.regexp_extract("path", r"(\d{4}-\d{2})\.[^./]*$", 1), F.lit("-01")))
    window = F.array_contains(catalog.months(F.lit(since), F.lit(until)), month)
    pages = files.filter("source_key = 'rbi_release_pages'")
    archive = archive_releases(files.filter("source_key = 'rbi_releases'").filter(window), pages, since, base)
    feed = feed_releases(files.filter("source_key = 'rbi_feed'"), pages, since)
    found = durable(releases.deltas(archive))
    return durable(releases.with_feed(found, releases.deltas(feed, count_names=False))), archive


def run(spark: SparkSession, folder: str, override: datetime.date | None = None, until: datetime.date | None = None, previous: str | None = None, base: str = "https://localhost/", top_up: bool = False, store: str | None = None) -> dict[str, DataFrame]:
    """The report relations by name, ready for staged.write_sheets. `base`: address of the staged listings; `previous`: folder of the last published ones, for sources that failed.

    `store`: folder of parse results that spares the pages an earlier run has parsed; the run log states files, bytes and milliseconds per source.
    `override`: day of the master list, where its title states none; `top_up`: pages add what an intermediary's download lacks.
    `failed_files` holds what was staged for sources that failed or gave no name, for diagnosis.
    Without a master list, or a day for it, releases are not applied and their relations are left out.
    """
    files, sources = staged.read_staged(spark, folder), catalog.sources(spark)
    scanned = scans.scan(files, sources, top_up, store)
    names, runs = durable(scanned.names), durable(scanned.runs)
    old = staged.previous_snapshot(spark, previous) if previous else spark.createDataFrame([], PREVIOUS)
    got = ingest.ingest(names, runs.drop("title"), sources, catalog.seeds(spark), old)
    hits, log = durable(got.hits), durable(got.run_log)
    day = master_date(runs, override)
    out, final = {}, None
    if day and not got.master.isEmpty():
        master = durable(got.master)
        deltas, archive = changes(files, day, until or datetime.date.today(), base)
        final = durable(status.history(master, deltas))
        out |= {
            "final_status": final, "change_log": status.change_log(master, deltas), "release_summary": status.release_summary(master, deltas),
            "unmatched_mentions": status.unmatched(master, deltas), "incomplete_releases": releases.incomplete(archive, deltas),
        }
    keys = entities.entity_keys(hits.select("name").union(final.select("name")) if final is not None else hits.select("name"))
    if final is not None:
        changed = final.filter("changed = 'Yes'").select("name", "final_status")
        hits = durable(reports.with_final_status(hits, keys, changed, keys))
    resolved = durable(resolve.resolve(hits, keys))
    failed = log.filter("status in ('error', 'empty', 'stale_previous_run')").join(sources.select("source_key", "page"), "source_key").select(F.col("page").alias("source_key")).distinct()
    return out | {
        "combine_list": reports.membership_rows(hits, keys, resolved), "resolved": resolved, "multi_category": reports.multi_category(resolved),
        "source_reconciliation": reports.source_reconciliation(hits, keys, resolved, log), "run_log": log, "run_totals": reports.run_totals(log), "publish": ingest.may_publish(log),
        "failed_files": files.join(F.broadcast(failed), "source_key", "left_semi"),
    }


def publish(spark: SparkSession, relations: dict[str, DataFrame], folder: str) -> int | None:
    """The relations of a run as one new version of `folder`, styles as columns; its number, or None where the gate keeps the run back.

    The membership relation is replaced source by source: one without rows keeps those of its last good run. Readers see all relations of
    this run or all of the one before.
    """
    if not relations["publish"].first().publish:
        return None
    return Versions(spark, folder).commit(with_styles(relations), {"combine_list": "source_key"})
