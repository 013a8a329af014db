"""Two feeds merged without a wait: state is an aggregate in the JVM, whatever the order and the number of runs."""

import datetime

from ledgerloom.streaming import history as H


def _change(i, name, link):
    return (i, 0, name, "Cancelled", datetime.date(2024, 1, 1), "t", link, None, None)


def test_feeds_meet_in_the_jvm(spark, tmp_path):
    base = str(tmp_path)
    steps = [
        ([], [(1, "A", "l"), (2, "", "l"), (3, None, None)]),
        ([(11, "A", "l")], [(4, "A", "l"), (5, "B", "l")]),
        ([(12, "A", "l")], [(6, "A", "l"), (7, "B", "l")]),
        ([(13, None, None), (14, None, "l")], []),
    ]
    for i, (archive, feed) in enumerate(steps):
        for name, rows in (("archive", archive), ("feed", feed)):
            if rows:
                spark.createDataFrame([_change(*r) for r in rows], H.CHANGE).write.parquet(f"{base}/{name}/batch={i}")
        both = H.merge_feeds(*(H.read_batches(spark, f"{base}/{n}", H.CHANGE) for n in ("archive", "feed")))
        q = H.start(both, f"{base}/merged", f"{base}/state")
        q.awaitTermination()
        assert {o["operatorName"] for p in q.recentProgress for o in p["stateOperators"]} == {"stateStoreSave"}
    got = spark.read.schema(f"{H.VERSIONED}, batch long").parquet(f"{base}/merged")
    told = sorted((r.release_ord, r.origin, r.version, r.withdrawn) for r in got.collect())
    fed = lambda i: (i, "feed", 1, False)
    assert told == sorted([fed(1), fed(2), fed(3), fed(5), fed(7), (1, "feed", 2, True), (3, "feed", 2, True), *((i, "archive", 1, False) for i in (11, 12, 13, 14))])
    assert sorted(r.release_ord for r in H.standing(got).collect()) == [2, 5, 7, 11, 12, 13, 14]
