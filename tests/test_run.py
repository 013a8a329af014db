"""One run over a staged folder that holds every kind of source, from files to reports."""

import datetime

import pytest

from ledgerloom.operators import scans, sections
from ledgerloom.plans import run as plan
from ledgerloom.sources import catalog, staged

from .test_documents import book


def table(*names, head="Name of the Company"):
    return "<html><table><tr><th>Sl. No.</th><th>" + head + "</th></tr>" + "".join(f"<tr><td>{i}</td><td>{n}</td></tr>" for i, n in enumerate(names, 1)) + "</table></html>"


BANKS = """Foreign banks in India
Sr.No
1. AB Bank PLC 41 Liberty Building
2. BNP Paribas Centre House
Regional Rural Banks Sr.No 1. Foo Gramin Bank 2. Bar Bank
State Co-operative Banks
1. Assam Co-op Bank Ltd. X
2. Bihar State Co-op Bank Ltd. Y
Coastal Local Area Bank Ltd"""
PAYMENTS = "<p>A. Certificates of Authorisation issued by RBI to set up and operate systems in India today</p><table><tr><td>1.</td><td>Razor Software Pvt Ltd</td><td>B</td></tr></table><p>B. Certificates of Authorisation Revoked</p>"
FILES = {
    "rbi_nbfc/list.xlsx": book([["List of NBFCs as on March 5, 2024"], ["Sl. No.", "NBFC Name", "Classification"], ["1", "Alpha Finance Private Limited", "ICC"], ["2", "Beta Capital Ltd (Formerly known as Gamma Capital Ltd)", ""], ["3", "Delta Housing Ltd", "HFC"]]),
    "rbi_nbfc_cancelled/list.xlsx": book([["List"], ["Sl. No.", "Name"], ["1", "Omega Leasing Limited"]]),
    "irdai_life/0-0.html": b"<html>moved</html>",
    "irdai_life/1-0.html": table("Life One Ltd", "Life Two Ltd"),
    "irdai_brokers/0-0.html": table("Broker A Ltd", "Broker B Ltd"),
    "irdai_brokers/0-1.html": table("Broker C Ltd"),
    "irdai_brokers/0-2.html": table("Broker A Ltd"),
    "irdai_brokers/0-3.html": table("Broker Z Ltd"),
    "irdai_health/0-0.html": table("Star Health and Allied Insurance Co Ltd"),
    "pfrda_pension_fund/0-0.html": table("Old Pension Funds Ltd New Pension Management Limited", "Other Company Ltd", head="Name of the Pension Fund"),
    "irdai_tpa/0-0.html": b"<html>no table</html>",
    "irdai_tpa/linked.txt": "Page 1\nMedi Assist TPA Ltd\nSr. No\n12",
    "nhb_hfc/list.txt": "Name of the company\nNest Housing Finance Ltd\nNest Housing Finance Ltd\nHome Loans Ltd",
    "rbi_banks/page.txt": BANKS,
    "rbi_pss/page.html": "<html>" + PAYMENTS,
    "sebi_hub/hub.html": '<table><tr><th>Name</th><th>Category</th><th>Count</th></tr><tr><td>1</td><td><a href="x?intmId=7">Credit Rating Agencies</a></td><td>2</td></tr></table>',
    "sebi_credit_rating/0-0.html": table("Rating One Ltd", "Rating Two Ltd", head="Name"),
    "sebi_credit_rating/0-1.html": table("Rating Three Ltd", head="Name"),
    "sebi_mutual_funds/export.xls": table("Fund One", head="Name"),
    "amfi_amc/1.html": b"<html><p>Name of Assest Management Co. : First AMC Ltd</p><p>x</p>",
    "amfi_amc/2.html": b"<html><p>nothing</p>",
    "sebi_custodians/export.xlsx": b"PK\x03\x04 damaged",
    "rbi_bank_scheduled_urban_coop/notes.xlsx": b"PK\x03\x04 saved, not read",
    "rbi_releases/2024-02.html": '<table><tr><td>Date : Feb 10, 2024</td><td><a href="x?prid=1">RBI cancels Certificate of Registration of one NBFC early</a></td></tr></table>',
    "rbi_releases/2024-04.html": '<table><tr><td>Date : Apr 10, 2024</td><td><a href="x?prid=2">RBI cancels Certificate of Registration of two NBFCs</a></td></tr><tr><td>Date : Apr 11, 2024</td><td><a href="x?prid=3">RBI restores CoR of one NBFC</a></td></tr></table>',
    "rbi_release_pages/prid-1.html": table("Alpha Finance Private Limited"),
    "rbi_release_pages/prid-2.html": table("ALPHA FINANCE (P) LTD.", "Nobody Known Ltd"),
    "rbi_release_pages/prid-3.html": table("Omega Leasing Ltd"),
    "rbi_feed/feed.xml": "<rss><item><title>RBI suspends CoR of one NBFC</title><link>x?prid=9</link><pubDate>Mon, 15 Apr 2024 10:00:00</pubDate><description>&lt;p&gt;1. Gamma Capital Ltd 2. x&lt;/p&gt;</description></item></rss>",
}


def staged_folder(folder, files=FILES):
    for name, data in files.items():
        (folder / name).parent.mkdir(parents=True, exist_ok=True)
        (folder / name).write_bytes(data if isinstance(data, bytes) else data.encode())
    return str(folder)


def test_scan(spark, tmp_path):
    got = scans.scan(staged.read_staged(spark, staged_folder(tmp_path)), catalog.sources(spark))
    names = {}
    for r in got.names.orderBy("source_key", "ord").collect():
        names.setdefault(r.source_key, []).append(r.name)
    assert names.pop("rbi_nbfc")[0] == "Alpha Finance Private Limited"
    assert {k: v for k, v in names.items() if k.startswith("irdai")} == {
        "irdai_life": ["Life One Ltd", "Life Two Ltd"], "irdai_brokers": ["Broker A Ltd", "Broker B Ltd", "Broker C Ltd"], "irdai_health": ["Star Health and Allied Insurance Co Ltd"], "irdai_tpa": ["Medi Assist TPA Ltd"],
    }
    assert names["pfrda_pension_fund"] == ["Old Pension Funds Ltd", "New Pension Management Limited"] and names["nhb_hfc"] == ["Nest Housing Finance Ltd", "Home Loans Ltd"]
    assert (names["rbi_bank_lab"], names["rbi_bank_foreign"], names["rbi_bank_state_coop"], names["rbi_bank_non_scheduled_state_coop"]) == (["Coastal Local Area Bank Ltd"], ["AB Bank PLC", "BNP Paribas"], ["Bihar State Co-op Bank Ltd."], ["Assam Co-op Bank Ltd."])
    assert names["rbi_pss_operating"] == ["Razor Software Pvt Ltd"] and names["amfi_amc"] == ["First AMC Ltd"] and names["sebi_mutual_funds"] == ["Fund One"]
    assert sorted(names["sebi_credit_rating"]) == ["Rating One Ltd", "Rating Two Ltd"]  # the hub's count is met by the first page
    runs = {r.source_key: r for r in got.runs.collect()}
    assert len(runs) == 54 and runs["rbi_nbfc"].title == "List of NBFCs as on March 5, 2024" and runs["sebi_credit_rating"].expected_count == 2
    assert {k: r.status for k, r in runs.items() if k in ("amfi_distributor", "irdai_imf", "rbi_nbfc", "rbi_bank_pb")} == {"amfi_distributor": "skipped_manual", "irdai_imf": "error", "rbi_nbfc": "ok", "rbi_bank_pb": "ok"}
    assert runs["irdai_imf"].error == "no staged file" and "1 of 2 pages" in runs["amfi_amc"].note and "keywords without a bank" in runs["rbi_bank_state_coop"].note


def test_refused_and_damaged_workbooks(spark, tmp_path):
    files = {"rbi_nbfc/list.xlsx": "<html>captcha</html>", "rbi_nbfc_cancelled/list.xlsx": b"PK\x03\x04 damaged"}
    runs = {r.source_key: r for r in scans.scan(staged.read_staged(spark, staged_folder(tmp_path, files)), catalog.sources(spark)).runs.collect()}
    assert runs["rbi_nbfc"].status == "error" and "CAPTCHA" in runs["rbi_nbfc"].error and runs["rbi_nbfc_cancelled"].status == "error"


def test_run(spark, tmp_path):
    folder = staged_folder(tmp_path / "in")
    out = plan.run(spark, folder, until=datetime.date(2024, 4, 30))
    assert {r.name[:5]: r.final_status for r in out["final_status"].collect()} == {"Alpha": "Cancelled", "Beta ": "Suspended", "Delta": "Active", "Omega": "Active"}
    assert [r.entity_name for r in out["unmatched_mentions"].collect()] == ["Nobody Known Ltd"]
    combined = {r.name: r for r in out["combine_list"].collect()}
    assert combined["Alpha Finance Private Limited"].status == "Cancelled" and combined["Delta Housing Ltd"].category == "HFCs" and combined["Care Health Insurance Limited"].is_final == "Yes"
    log = {r.source_key: r.status for r in out["run_log"].collect()}
    assert log["rbi_nbfc"] == "ok" and log["rbi_bank_pb"] == "empty" and log["irdai_imf"] == "error" and out["publish"].first().publish
    assert out["run_totals"].first().sources == 54 and {r.source_key for r in out["failed_files"].collect()} == {"rbi_banks", "rbi_pss", "sebi_custodians", "rbi_bank_scheduled_urban_coop"}
    staged.write_raw(out["failed_files"], str(tmp_path / "raw"))
    assert spark.read.parquet(str(tmp_path / "raw")).count() == 4
    staged.write_sheets({k: out[k] for k in ("combine_list", "run_log", "final_status")}, str(tmp_path / "out"))
    less = {k: v for k, v in FILES.items() if not k.startswith(("irdai_life", "rbi_nbfc/"))}
    again = plan.run(spark, staged_folder(tmp_path / "less", less), until=datetime.date(2024, 4, 30), previous=str(tmp_path / "out"))
    log = {r.source_key: r.status for r in again["run_log"].collect()}
    assert log["irdai_life"] == log["rbi_nbfc"] == "stale_previous_run" and "final_status" not in again
    assert {r.name: r.status for r in again["combine_list"].collect()}["Alpha Finance Private Limited"] == "Cancelled"


def test_master_date(spark):
    runs = spark.createDataFrame([("rbi_nbfc", "ok", "as on March 5, 2024"), ("other", "ok", "as on March 6, 2024")], "source_key string, status string, title string")
    assert plan.master_date(runs) == datetime.date(2024, 3, 5) and plan.master_date(runs, datetime.date(2020, 1, 1)) == datetime.date(2020, 1, 1)
    assert plan.master_date(runs.filter("source_key = 'other'")) is None


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("x Coastal Local Area Bank Ltd 520001 Andhra Pradesh Subhadra Local Area Bank Limited y", ["Coastal Local Area Bank Ltd", "Subhadra Local Area Bank Limited"]),
        ("Local Area Bank Ltd", []),
        (None, []),
    ],
)
def test_local_area_banks_on_one_line(spark, text, want):
    assert spark.createDataFrame([(text,)], "t string").select(sections.local_area_banks("t")).first()[0] == want


def test_link_choice(spark):
    page = '<a href="about.html">About</a><a href="f/list.PDF?x">no</a><a href="f/list.pdf">List</a><a href="g">list.xlsx</a>'
    got = staged.linked_file(spark.createDataFrame([("s", "https://r.in/a/b.aspx", page), ("t", "https://r.in/", "none")], "source_key string, base string, html string")).collect()
    assert [tuple(r) for r in got] == [("s", "https://r.in/a/f/list.pdf")]
