"""Histories of changes: state is an aggregate in the JVM; versions that come late or twice change nothing."""

import datetime

from ledgerloom.streaming import history as H

D = datetime.date


def _row(key, i, link, day, version=1, withdrawn=False, status="Cancelled"):
    return (key, day, i, 0, status, "t", link, None, "n", "Exact", "archive", version, withdrawn)


def test_histories_in_the_jvm(spark, tmp_path):
    base = str(tmp_path)
    steps = [
        [_row("a", 1, "l", D(2024, 1, 1)), _row("a", 2, None, None), _row("b", 1, "l", D(2024, 1, 1), 2, True)],
        [_row("a", 1, "l", D(2024, 2, 1), 3), _row("a", 1, "l", D(2024, 1, 5), 2, True), _row("b", 1, "l", D(2024, 1, 1)), _row("a", 2, None, None)],
    ]
    for i, rows in enumerate(steps):
        spark.createDataFrame(rows, H.MATCHED).write.parquet(f"{base}/in/batch={i}")
        q = H.start(H.track(H.read_batches(spark, f"{base}/in", H.MATCHED)), f"{base}/out", f"{base}/state")
        q.awaitTermination()
        assert {o["operatorName"] for p in q.recentProgress for o in p["stateOperators"]} == {"stateStoreSave"}
    got = {(r.batch, r.master_key): sorted((h.release_ord, str(h.effective_date)) for h in r.history) for r in H.read_updates(spark, f"{base}/out").collect()}
    assert got == {(0, "a"): [(1, "2024-01-01"), (2, "None")], (0, "b"): [], (1, "a"): [(1, "2024-02-01"), (2, "None")], (1, "b"): []}
