"""Catching up on releases as a chain of streams: each run reads only what was staged since the one before.

raw/source_key=../month=..  ->  archive, feed (changes of new months and feeds)  ->  merged (archive wins)  ->  matched (met with the
master list)  ->  history (per master row). Every arrow has its checkpoint; every folder is written by micro-batch, so a run that broke off
goes on where it was and a batch that was half written is written again.
"""

from __future__ import annotations

import datetime
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import releases
from ..plans import run
from ..sources import staged
from . import history as H


class CaughtUp(NamedTuple):
    final: DataFrame  # as status.history has it
    rows_read: dict[str, int]  # of each stream, in this run


def _rows(query: StreamingQuery) -> int:
    """Waits for the query's end; the rows that its micro-batches took."""
    query.awaitTermination()
    return sum(p["numInputRows"] for p in query.recentProgress)


def _listen(spark: SparkSession, raw: str, source: str, to_changes, work: str, files: int | None) -> StreamingQuery:
    """New staged files of a source as flat changes in work/<source>. Pages are read from the months of the batch alone."""
    r = spark.readStream.schema(staged.RAW.replace(", source_key string", ""))
    stream = (r.option("maxFilesPerTrigger", files) if files else r).parquet(f"{raw}/source_key={source}")

    def save(batch: DataFrame, number: int) -> None:
        batch = batch.persist()
        months = [r.month for r in batch.select("month").distinct().collect()]  # the months of one batch of files
        pages = staged.read_raw(spark, raw).filter((F.col("source_key") == "rbi_release_pages") & F.col("month").isin(*months))
        H.flat(to_changes(batch, pages)).write.mode("overwrite").parquet(f"{work}/{source}/batch={number}")
        batch.unpersist()

    return stream.writeStream.option("checkpointLocation", f"{work}/state-{source}").trigger(availableNow=True).foreachBatch(save).start()


def catch_up(spark: SparkSession, raw: str, work: str, master: DataFrame, since: datetime.date, base: str, files: int | None = None, wait_ms: int = 0) -> CaughtUp:
    """Final status and history of master (ord, name, status) after all staged releases since `since`; reads what is new to `work`.

    A month is staged once, with its release pages (staged.stage), when it is complete; the feed covers the month that runs. `work`
    belongs to one master list: another list, or another day of it, takes another folder. `files`: how many staged files a micro-batch takes.
    Equal to status.history over run.changes, whatever came in which run. Nothing staged: the master list as it is.
    """
    month = F.to_date(F.concat("month", F.lit("-01")))
    fresh = lambda d: d.filter(month >= F.trunc(F.lit(since), "month"))
    read = {}
    sources = {
        "rbi_releases": lambda d, pages: releases.deltas(run.archive_releases(fresh(d), pages, since, base)),
        "rbi_feed": lambda d, pages: releases.deltas(run.feed_releases(d, pages, since), count_names=False),
    }
    for source, to_changes in sources.items():
        if staged.has_raw(spark, raw, source):
            read[source] = _rows(_listen(spark, raw, source, to_changes, work, files))
    feeds = (H.read_batches(spark, f"{work}/{source}", H.CHANGE, files) for source in sources)
    read["merged"] = _rows(H.start(H.merge_feeds(*feeds, wait_ms=wait_ms), f"{work}/merged", f"{work}/state-merged", **({"once": True} if wait_ms else {})))
    read["matched"] = _rows(H.match_stream(H.read_batches(spark, f"{work}/merged", H.VERSIONED, files), master, f"{work}/matched", f"{work}/state-matched"))
    read["history"] = _rows(H.start(H.track(H.read_batches(spark, f"{work}/matched", H.MATCHED, files)), f"{work}/history", f"{work}/state-history"))
    updates = H.read_updates(spark, f"{work}/history")
    return CaughtUp(H.now(master, updates), read)
