"""Keyed state over dated changes: what an entity went through, with corrections and withdrawals, and two feeds of which one wins.

A change is a row (ord, entity_name, action, effective_date, pr_title, pr_link, note) with its origin, a version and a flag: of the rows of
one change (ord, name, link, origin) the one of the highest version counts, and a withdrawn one takes the change back. So the state, and all that is read from it, is the
same for any order of arrival and any cut into micro-batches.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from ..functions import cells
from ..operators import status

CHANGE = "release_ord long, pos long, entity_name string, action string, effective_date date, pr_title string, pr_link string, expected_count int, note string"
VERSIONED = f"{CHANGE}, origin string, version long, withdrawn boolean"
#: One change of an entity, as its history holds it.
ITEM = "effective_date date, release_ord long, pos long, status string, pr_title string, pr_link string, note string, pr_name string, match_type string"
FIELDS = [f.split()[0] for f in ITEM.split(", ")]
MATCHED = f"master_key string, {ITEM}, origin string, version long, withdrawn boolean"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"


def flat(changes: DataFrame) -> DataFrame:
    """Changes of releases.deltas, or with a plain number as ord, in the columns of CHANGE; others are left out, missing ones null."""
    kind = changes.schema["ord"].dataType
    major, minor = (F.col("ord.release_ord"), F.col("ord.pos")) if isinstance(kind, T.StructType) else (F.col("ord"), F.lit(0))
    c = changes.withColumns({"release_ord": major.cast("long"), "pos": minor.cast("long")})
    return c.select(*[(F.col(f.split()[0]) if f.split()[0] in c.columns else F.lit(None)).cast(f.split()[1]).alias(f.split()[0]) for f in CHANGE.split(", ")])


def versioned(changes: DataFrame, version: Column | None = None, withdrawn: Column | None = None) -> DataFrame:
    """Flat changes of the archive as first versions that stand, unless told otherwise."""
    return flat(changes).withColumns({"origin": F.lit("archive"), "version": (F.lit(1) if version is None else version).cast("long"), "withdrawn": F.lit(False) if withdrawn is None else withdrawn})


class ArchiveWins(StatefulProcessor):
    """Per (link, name): whether the archive has it, and the feed's rows that stand or wait.

    A row of the feed stands until the archive has the same link and name, then it is withdrawn. With `wait_ms` it is held back that long
    first, so that what the archive soon has is never published. Repeats inside either feed stay.
    """

    def __init__(self, wait_ms: int = 0):
        self.wait_ms = wait_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        row = f"array<struct<{', '.join(f.replace(' ', ': ', 1) for f in CHANGE.split(', '))}>>"
        self.seen = handle.getValueState("seen", f"archived boolean, standing {row}, waiting {row}")  # of one link and name: a handful

    def _told(self, rows: list[tuple], origin: str, version: int = 1) -> Iterator[Row]:
        names = [f.split()[0] for f in VERSIONED.split(", ")]
        for r in rows:
            yield Row(**dict(zip(names, (*r, origin, version, version > 1))))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:  # noqa: N802, N803
        names = [f.split()[0] for f in CHANGE.split(", ")]
        archive, feed = [], []
        for r in rows:
            (archive if r["origin"] == "archive" else feed).append(tuple(r[n] for n in names))
        yield from self._told(archive, "archive")
        archived, standing, waiting = self._load()
        if archive and not archived:
            yield from self._told(standing, "feed", 2)
            if waiting:
                for t in list(self.handle.listTimers()):
                    self.handle.deleteTimer(t)
            self.seen.update((True, [], []))
        elif feed and not archived:
            if self.wait_ms:
                waiting += feed
                self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.wait_ms)
            else:
                standing += feed
                yield from self._told(feed, "feed")
            self.seen.update((False, standing, waiting))

    def _load(self) -> tuple[bool, list[tuple], list[tuple]]:
        archived, standing, waiting = self.seen.get() or (False, [], [])
        return archived, [tuple(r) for r in standing or []], [tuple(r) for r in waiting or []]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N802, N803
        archived, standing, waiting = self._load()
        if waiting:
            self.seen.update((archived, standing + waiting, []))
        yield from self._told(waiting, "feed")

    def close(self) -> None:
        pass


class _Provider:
    """Arbitrary state lives in RocksDB; the session's own choice comes back."""

    def __init__(self, spark: SparkSession):
        self.conf = spark.conf

    def __enter__(self):
        self.old = self.conf.get(PROVIDER, None)
        self.conf.set(PROVIDER, ROCKS)

    def __exit__(self, *_):
        self.conf.set(PROVIDER, self.old) if self.old else self.conf.unset(PROVIDER)


def merge_feeds(archive: DataFrame, feed: DataFrame, wait_ms: int = 0) -> DataFrame:
    """Two streams of flat changes as one of versioned ones: releases.with_feed, whichever comes first.

    With `wait_ms` a query asks for batch after batch to serve its timers: start it with once=True, or as a running one. Without, state is an
    aggregate per (link, name) that never leaves the JVM: when the archive first had it, and the feed's rows with the time of their micro-batch."""
    if not wait_ms:
        at, now = F.col("_at"), F.current_timestamp()  # the same in all of a micro-batch, also when it is run again
        both = archive.withColumn("_feed", F.lit(False)).unionByName(feed.withColumn("_feed", F.lit(True))).withColumn("_at", now)
        rest = [n for n in (f.split()[0] for f in CHANGE.split(", ")) if n not in ("pr_link", "entity_name")]
        seen = both.groupBy("pr_link", "entity_name").agg(F.min(F.when(~F.col("_feed"), at)).alias("_archived"), F.collect_list(F.when(F.col("_feed"), F.struct(*rest, "_at"))).alias("_fed"))
        first = F.col("_archived").isNull()
        moved = F.filter("_fed", lambda r: F.when(first, r["_at"] == now).otherwise((F.col("_archived") == now) & (r["_at"] != now)))
        told = seen.select("pr_link", "entity_name", F.when(first, 1).otherwise(2).cast("long").alias("version"), (~first).alias("withdrawn"), F.inline(moved)).withColumn("origin", F.lit("feed"))
        names = [f.split()[0] for f in VERSIONED.split(", ")]
        stands = archive.withColumns({"origin": F.lit("archive"), "version": F.lit(1).cast("long"), "withdrawn": F.lit(False)})
        return stands.select(*names).union(told.select(*names))
    both = archive.withColumn("origin", F.lit("archive")).unionByName(feed.withColumn("origin", F.lit("feed")))
    # null and empty are not alike: a list of no or one item keeps them apart
    told = lambda c: F.to_json(F.array_compact(F.array(c)))
    keyed = both.withColumns({"_link": told("pr_link"), "_name": told("entity_name")}).groupBy("_link", "_name")
    return keyed.transformWithState(ArchiveWins(wait_ms), VERSIONED, "Update", "ProcessingTime" if wait_ms else "None")


def start(stream: DataFrame, folder: str, state: str, **trigger) -> StreamingQuery:
    """Appends each micro-batch to folder/batch=N, over what a broken attempt of the same batch left. Default trigger: what is there, then stop."""

    def save(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/batch={number}")

    with _Provider(stream.sparkSession):
        return stream.writeStream.outputMode("update").option("checkpointLocation", state).trigger(**(trigger or {"availableNow": True})).foreachBatch(save).start()


def match_stream(changes: DataFrame, master: DataFrame, folder: str, state: str, **trigger) -> StreamingQuery:
    """Versioned changes of a stream, each micro-batch met with the master list (ord, name, status) by status.applied; to folder/batch=N."""

    def save(batch: DataFrame, number: int) -> None:
        ord_ = F.struct("release_ord", "pos", "origin", "version", "withdrawn")
        hit = status.applied(master, batch.withColumn("ord", ord_))
        columns = ["master_key", *[F.col(f"ord.{f}").alias(f) if f in ("release_ord", "pos") else F.col(f) for f in FIELDS], "ord.origin", "ord.version", "ord.withdrawn"]
        hit.select(*columns).write.mode("overwrite").parquet(f"{folder}/batch={number}")

    return changes.writeStream.option("checkpointLocation", state).trigger(**(trigger or {"availableNow": True})).foreachBatch(save).start()


HISTORY = f"master_key string, history array<struct<{', '.join(f.replace(' ', ': ', 1) for f in ITEM.split(', '))}>>"


def track(matched: DataFrame) -> DataFrame:
    """(master_key, history) of every master row that a micro-batch of matched changes met: those that stand, each in its highest version.

    State is an aggregate of all versions told, so no row leaves the JVM.
    """
    name = ["release_ord", "pos", "pr_name", "pr_link", "origin"]
    row = F.struct(*name, "version", "withdrawn", *[f for f in FIELDS if f not in name])
    told = matched.groupBy("master_key").agg(F.array_sort(F.collect_set(row)).alias("told"))
    same = lambda x, z: F.struct(*[x[n] for n in name]).eqNullSafe(F.struct(*[z[n] for n in name]))
    last = lambda t, x, i: F.get(t, i + 1).isNull() | ~same(x, F.get(t, i + 1))
    stands = cells.let(F.col("told"), lambda t: F.filter(t, lambda x, i: last(t, x, i) & ~F.coalesce(x["withdrawn"], F.lit(False))))
    return told.select("master_key", F.transform(stands, lambda x: F.struct(*[x[f].alias(f) for f in FIELDS])).alias("history"))


def _made(spark: SparkSession, folder: str) -> str:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(path)
    return folder


def read_batches(spark: SparkSession, folder: str, schema: str, files: int | None = None) -> DataFrame:
    """A stream over what start() and match_stream() append, `files` at a time. The folder may be empty at first."""
    r = spark.readStream.schema(f"{schema}, batch long")
    return (r.option("maxFilesPerTrigger", files) if files else r).parquet(_made(spark, folder)).drop("batch")


def read_updates(spark: SparkSession, folder: str) -> DataFrame:
    """(master_key, history, batch) that track() has written by start()."""
    return spark.read.schema(f"{HISTORY}, batch long").parquet(_made(spark, folder))


def standing(rows: DataFrame) -> DataFrame:
    """Of versioned changes those that stand, in their highest version."""
    name = ["release_ord", "pos", "entity_name", "pr_link", "origin"]
    rest = [f.split()[0] for f in CHANGE.split(", ") if f.split()[0] not in name]
    last = rows.groupBy(*name).agg(F.max_by(F.struct("withdrawn", *rest), F.struct("version", "withdrawn")).alias("l"))
    return last.filter("not l.withdrawn").select(*name, *[f"l.{c}" for c in rest])


def now(master: DataFrame, updates: DataFrame) -> DataFrame:
    """status.history out of the updates (master_key, history, batch) that the stream has written: of each master row its last one."""
    last = updates.groupBy("master_key").agg(F.max_by("history", "batch").alias("history"))
    items = F.transform("history", lambda h: F.struct(h["effective_date"].alias("effective_date"), F.struct(h["release_ord"].alias("release_ord"), h["pos"].alias("pos")).alias("ord"), *[h[f].alias(f) for f in FIELDS[3:]]))
    return status.with_history(master, last.select("master_key", F.array_sort(items).alias("history")).filter(F.size("history") > 0))
