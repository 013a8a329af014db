"""Catching up by streams: a second run reads what is new alone, and the result is that of one batch over everything."""

import datetime

from pyspark.sql import functions as F

from ledgerloom.operators import status
from ledgerloom.plans import run
from ledgerloom.sources import staged
from ledgerloom.streaming import catchup

D, BASE = datetime.date, "https://r.in/"


def _files(spark, rows):
    got = [(k, m, f"in/{k}/{name}", datetime.datetime(2024, 5, 1), "html", html.encode()) for k, m, name, html in rows]
    return spark.createDataFrame(got, "source_key string, month string, path string, modified timestamp, kind string, content binary")


def _listing(month, *entries):
    return ("rbi_releases", month, f"{month}.html", "<html><table>" + "".join(f'<tr><td>Date : {d}, 2024</td><td><a href="x.aspx?prid={n}">RBI cancels CoR of one NBFC</a></td></tr>' for n, d in entries) + "</table>")


def _page(month, n, *names):
    rows = "".join(f"<tr><td>{i}</td><td>{x}</td></tr>" for i, x in enumerate(names, 1))
    return ("rbi_release_pages", month, f"prid-{n}.html", f"<table><tr><td>Sr</td><td>Name of the company</td></tr>{rows}</table>")


def _feed(month, name, *entries):
    return ("rbi_feed", month, name, "".join(f"<item><title>RBI cancels CoR of one NBFC</title><link>{BASE}x.aspx?prid={n}</link><pubDate>Mon, {d} 2024 10:00:00</pubDate></item>" for n, d in entries))


def test_two_runs(spark, tmp_path):
    raw, work = str(tmp_path / "raw"), str(tmp_path / "work")
    master = spark.createDataFrame([(1, "Alpha Finance Limited", "Active"), (2, "Beta Finance Limited", "Active"), (3, "Gamma Finance Limited", "Active"), (4, "Delta Finance Limited", "Active")], "ord long, name string, status string")
    since = D(2024, 1, 10)
    first = [_listing("2023-12", (9, "Jan 20")), _listing("2024-01", (1, "Jan 5"), (2, "Jan 12")), _page("2024-01", 1, "Alpha Finance Limited"), _page("2024-01", 2, "Beta Finance Limited"), _feed("2024-02", "f1.xml", (3, "3 Feb"), (4, "10 Jan")), _page("2024-02", 3, "Gamma Finance Limited")]
    second = [_listing("2024-02", (3, "Feb 4"), (5, "Feb 6")), _page("2024-02", 5, "Delta Finance Limited", "Alpha Finance Limited"), _feed("2024-02", "f2.xml", (5, "6 Feb"))]
    staged.stage(_files(spark, first), raw)
    one = catchup.catch_up(spark, raw, work, master, since, BASE)
    got = {r.name: r for r in one.final.collect()}
    assert got["Beta Finance Limited"].final_status == "Cancelled" and got["Gamma Finance Limited"].effective_date == D(2024, 2, 3) and got["Alpha Finance Limited"].changed == "No"
    assert one.rows_read["rbi_releases"] == 2 and one.rows_read["rbi_feed"] == 1
    staged.stage(_files(spark, second), raw)
    two = catchup.catch_up(spark, raw, work, master, since, BASE, files=1)
    assert two.rows_read["rbi_releases"] == 1 and two.rows_read["rbi_feed"] == 1
    files = _files(spark, first + second).drop("month")
    deltas, _ = run.changes(files, since, D(2024, 2, 28), BASE)
    show = lambda h: sorted((r.name, r.final_status, r.effective_date, r.status_source, [(x.effective_date, x.ord.release_ord, x.ord.pos, x.pr_link, x.pr_name) for x in r.history or []]) for r in h.collect())
    assert show(two.final) == show(status.history(master, deltas))
    assert {r.name: r.effective_date for r in two.final.collect()}["Gamma Finance Limited"] == D(2024, 2, 4)
    three = catchup.catch_up(spark, raw, work, master, since, BASE)
    assert sum(three.rows_read.values()) == 0 and show(three.final) == show(two.final)


def test_nothing_staged(spark, tmp_path):
    master = spark.createDataFrame([(1, "Alpha Finance Limited", "Active")], "ord long, name string, status string")
    got = catchup.catch_up(spark, str(tmp_path / "raw"), str(tmp_path / "work"), master, D(2024, 1, 1), BASE)
    assert [(r.final_status, r.changed) for r in got.final.select("final_status", "changed", F.col("history")).collect()] == [("Active", "No")]
