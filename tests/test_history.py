"""Stateful streams: equal to the batch result for any order of arrival, any cut into batches, either feed first."""

import datetime
import itertools
import random

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import releases, status
from ledgerloom.streaming import history as H

D = datetime.date
MASTER = [(1, "Alpha Finance Limited", "Active"), (2, "Beta Credit Limited (Formerly known as Gamma Loans Ltd)", "Active"), (3, "Delta Capital Limited", "Cancelled"), (4, "Epsilon Leasing Limited", "Active")]
CHANGES = [
    (1, "Alpha Finance Ltd.", "Cancelled", D(2024, 1, 5), "t1", "l1", None),
    (2, "ALPHA FINANCE LIMITED", "Restored", D(2024, 2, 1), "t2", "l2", "n"),
    (3, "Gamma Loans Ltd", "Surrendered", D(2024, 1, 9), "t3", "l3", None),
    (4, "Delta Capital Limited", "Restored", D(2024, 3, 1), "t4", "l4", None),
    (5, "Delta Capital Limited", "Suspended", D(2024, 3, 1), "t5", "l5", None),
    (6, "Nobody Known Limited", "Cancelled", D(2024, 3, 1), "t6", "l6", None),
    (7, None, "Cancelled", D(2024, 3, 1), "t7", "l7", None),
    (8, "Alpha Finance Limited", "Suspended", None, "t8", "l8", None),
]
SCHEMA = "ord long, entity_name string, action string, effective_date date, pr_title string, pr_link string, note string"


def _plain(h):
    flat = F.transform("history", lambda x: F.struct(x["effective_date"], x["status"], x["pr_title"], x["pr_link"], x["note"], x["pr_name"], x["match_type"]))
    return sorted(map(str, h.withColumn("history", flat).collect()))


def _stream(spark, base, parts, wait=None):
    """Writes each part (versioned rows) as files and runs the chain after each."""
    master = spark.createDataFrame(MASTER, "ord long, name string, status string")
    for part in parts:
        spark.createDataFrame(part, H.VERSIONED).withColumn("batch", F.lit(0).cast("long")).drop("batch").write.mode("append").parquet(f"{base}/in/batch={parts.index(part)}")
        H.match_stream(H.read_batches(spark, f"{base}/in", H.VERSIONED, 1), master, f"{base}/matched", f"{base}/s1").awaitTermination()
        H.start(H.track(H.read_batches(spark, f"{base}/matched", H.MATCHED)), f"{base}/out", f"{base}/s2").awaitTermination()
    return H.now(master, H.read_updates(spark, f"{base}/out"))


def _row(c, version=1, withdrawn=False):
    return (c[0], 0, c[1], c[2], c[3], c[4], c[5], None, c[6], "archive", version, withdrawn)


@pytest.mark.parametrize("seed", [1])
def test_any_order_with_corrections(spark, tmp_path, seed):
    """Corrected and withdrawn changes, dealt to batches at random, even a withdrawal before what it withdraws."""
    told = [_row(c) for c in CHANGES]
    fixed = (4, "Delta Capital Limited", "Cancelled", D(2024, 4, 1), "t4b", "l4", None)
    told += [_row(fixed, 2), _row(CHANGES[2], 2, True), _row(CHANGES[0], 3), _row(CHANGES[0], 2, True)]
    rnd = random.Random(seed)
    rnd.shuffle(told)
    cuts = sorted(rnd.sample(range(1, len(told)), 1))
    parts = [told[a:b] for a, b in itertools.pairwise([0, *cuts, len(told)])]
    got = _stream(spark, str(tmp_path), parts)
    left = [c for c in CHANGES if c[0] not in (3, 4)] + [fixed]
    master = spark.createDataFrame(MASTER, "ord long, name string, status string")
    assert _plain(got) == _plain(status.history(master, spark.createDataFrame(left, SCHEMA)))


def test_moved_name(spark, tmp_path):
    """A corrected name moves the change to another entity: the old one takes it back."""
    wrong, right = (1, "Alpha Finance Limited", "Cancelled", D(2024, 1, 5), "t", "l", None), (1, "Epsilon Leasing Limited", "Cancelled", D(2024, 1, 5), "t", "l", None)
    got = {r.name: r.final_status for r in _stream(spark, str(tmp_path), [[_row(wrong)], [_row(wrong, 2, True), _row(right, 2)]]).collect()}
    assert got["Alpha Finance Limited"] == "Active" and got["Epsilon Leasing Limited"] == "Cancelled"


ARCHIVE = [(1, "A Ltd", "l1"), (2, "A Ltd", "l1"), (3, None, "l2"), (4, "C Ltd", None)]
FEED = [(11, "A Ltd", "l1"), (12, None, "l2"), (13, "B Ltd", "l1"), (14, "B Ltd", "l1"), (15, "C Ltd", None), (16, "", "l2")]


def _change(r):
    return (r[0], 0, r[1], "Cancelled", D(2024, 1, 1), "t", r[2], None, None)


def _net(rows):
    """What stands of versioned rows."""
    best = {}
    for r in rows:
        k = (r.release_ord, r.entity_name, r.pr_link, r.origin)
        best[k] = max(best.get(k, (0, False)), (r.version, r.withdrawn))
    return sorted(k[0] for k, v in best.items() if not v[1])


@pytest.mark.parametrize("order", ["archive", "feed", "mixed", "together"])
def test_archive_wins(spark, tmp_path, order):
    base = str(tmp_path)
    put = lambda rows, name, i: spark.createDataFrame([_change(r) for r in rows], H.CHANGE).write.parquet(f"{base}/{name}/batch={i}") if rows else None
    steps = {"archive": [(ARCHIVE, []), ([], FEED)], "feed": [([], FEED), (ARCHIVE, [])], "mixed": [(ARCHIVE[:1], FEED[:2]), (ARCHIVE[1:2], FEED[2:]), (ARCHIVE[2:], [])], "together": [(ARCHIVE, FEED)]}[order]
    for i, (a, f) in enumerate(steps):
        put(a, "archive", i)
        put(f, "feed", i)
        both = H.merge_feeds(*(H.read_batches(spark, f"{base}/{n}", H.CHANGE) for n in ("archive", "feed")))
        H.start(both, f"{base}/merged", f"{base}/state").awaitTermination()
    one = lambda rows: H.flat(spark.createDataFrame([(r[0], r[1], r[2]) for r in rows], "ord long, entity_name string, pr_link string"))
    want = sorted(r.release_ord for r in releases.with_feed(one(ARCHIVE), one(FEED)).collect())
    got = spark.read.parquet(f"{base}/merged").collect()
    assert _net(got) == want == [1, 2, 3, 4, 13, 14, 16]
    if order == "archive":
        assert not any(r.withdrawn for r in got)


def test_feed_waits(spark, tmp_path):
    """With a wait, what the archive soon has is never published; what it lacks is, once the timer is due."""
    base = str(tmp_path)
    put = lambda rows, name, i: spark.createDataFrame([_change(r) for r in rows], H.CHANGE).write.parquet(f"{base}/{name}/batch={i}")

    def step():
        both = H.merge_feeds(*(H.read_batches(spark, f"{base}/{n}", H.CHANGE) for n in ("archive", "feed")), wait_ms=1)
        H.start(both, f"{base}/merged", f"{base}/state", once=True).awaitTermination(60)
        return spark.read.schema(f"{H.VERSIONED}, batch long").parquet(f"{base}/merged").collect()

    put(FEED, "feed", 0)
    step()
    put(ARCHIVE, "archive", 0)
    step()
    put([(99, "Z Ltd", "l9")], "archive", 1)
    got = step()
    assert _net(got) == [1, 2, 3, 4, 13, 14, 16, 99]
