"""Cleaning and cutting of names, document parsers, sections, releases, paging, ingest, sinks and the stream."""

import datetime
import io
import zipfile

from pyspark.sql import functions as F

from ledgerloom.functions import clean, documents, names as N
from ledgerloom.operators import entities, ingest, paging, releases, reports, resolve, sections, status
from ledgerloom.sources import catalog, markup, staged
from ledgerloom.streaming import status as stream


def one(spark, f, *values):
    return [r[1] for r in spark.createDataFrame(list(enumerate(values)), "i int, v string").select("i", f(F.col("v"))).orderBy("i").collect()]


def test_cuts(spark):
    assert one(spark, clean.cut_at_legal_form, "Card Pro Solutions Pvt. Ltd. Prepaid Payment Instruments", "UAE Exchange Centre LLC, UAE Dubai", "Infibeam Avenues Limited (formerly Avenues India Private Limited) x", "no form", None) == [
        "Card Pro Solutions Pvt. Ltd.", "UAE Exchange Centre LLC, UAE", "Infibeam Avenues Limited (formerly Avenues India Private Limited)", None, None]
    assert one(spark, clean.cut_at_address, "AB Bank PLC 41 / 42 Liberty Building", "American Express Banking Corporation Cyber City", "BNP Paribas", "Qatar National Bank (Q.P.S.C.) Raheja Tower") == ["AB Bank PLC", "American Express Banking Corporation", "BNP Paribas", "Qatar National Bank (Q.P.S.C.)"]
    assert one(spark, clean.cut_at_first_suffix, "The Bihar State Co-op Bank Ltd. Ashok", "none") == ["The Bihar State Co-op Bank Ltd.", None]
    assert one(spark, clean.payment_name, "1\tBank of India\tMumbai", "Foo Payments Prepaid instruments", "Acme\nServices Private Limited Delhi") == ["Bank of India", "Foo Payments", "Acme Services Private Limited"]


def test_cleaning(spark):
    assert one(spark, clean.strip_devanagari, "भारतीय जीवन / LIC of India /", "Plain (x)", "मराठी (English Name Ltd)") == ["LIC of India", "Plain (x)", "English Name Ltd"]
    assert one(spark, clean.clean_leading_junk, ". . / NAME Ltd", "...", "(P) Co", None) == ["NAME Ltd", "...", "(P) Co", ""]
    assert one(spark, clean.is_label, "Sr. No.", "Name of the Company", "[object Object]", "Alpha Ltd") == [True, True, True, False]
    assert one(spark, clean.acceptable_company, "ABC Ltd", "Registered Office Address", "12/34", "31-Jul-26", "Mumbai 400001", "Cancellation Order No 5") == [True, False, False, False, False, False]
    assert one(spark, clean.link_id, "x?intmId=30", "x?intmId=300&b=1", "x?aintmId=3") == ["30", "300", None]
    assert one(spark, lambda c: clean.absolute_url(c, F.lit("https://a.b/c/d.html?x=1")), "/q", "e.html", "?z", "//h/k", "http://x/y", "#f") == ["https://a.b/q", "https://a.b/c/e.html", "https://a.b/c/d.html?z", "https://h/k", "http://x/y", "https://a.b/c/d.html?x=1#f"]
    assert one(spark, clean.manager_name, "x\nName of Assest Management Co. : Foo AMC Ltd\nz") == ["Foo AMC Ltd"]
    rename = lambda key: one(spark, lambda c: clean.override_name(F.lit(key), c, clean.OVERRIDES), "Standard Chartered Investments & Loans (India) Limited", "Other Co Limited")
    assert rename("rbi_nbfc")[0].startswith("Standard Chartered Capital Limited (Formerly: ") and rename("rbi_nbfc")[1] == "Other Co Limited" == rename("sebi_broker_equity")[1]


def test_titles(spark):
    assert one(spark, clean.expected_count, "cancels CoR of 59 NBFCs", "restores Two NBFCs", "none") == [59, 2, None]
    assert one(spark, clean.action, "RBI cancels", "Restoration after cancellation", "surrender", "suspended", "x") == ["Cancelled", "Restored", "Surrendered", "Suspended", None]
    assert one(spark, N.master_list_date, "as on 30-June-2026", "as of Jul 5, 2024") == [datetime.date(2026, 6, 30), datetime.date(2024, 7, 5)]


RELEASE = "<table><tr><th>Sr. No.</th><th>Name of the Company</th><th>Date</th></tr><tr><td>1</td><td>ABC Finance Ltd</td><td>July 09,1998</td></tr></table><table><tr><td>2</td><td>XYZ Capital Limited</td><td>x</td></tr></table><table><tr><td>a</td><td>b</td></tr></table><p>also: 1. ABC Finance Ltd 2. PQR Leasing Private Limited, Mumbai</p>"


def test_releases(spark):
    r = spark.createDataFrame(
        [(1, "RBI cancels CoR of three NBFCs", "l1", "2024-02-01", RELEASE), (2, "RBI cancels CoR of 2 NBFCs", "l2", "2024-02-02", "<p>nothing</p>"), (3, "Guidelines on CoR", "l3", "2024-02-03", ""), (4, "RBI restores CoR of one NBFC", "l4", "2024-01-01", "<p>the following: 1. Solo Finance Ltd Delhi</p>")],
        "ord long, title string, link string, effective_date string, html string",
    ).withColumn("effective_date", F.to_date("effective_date"))
    since = F.lit("2024-01-01").cast("date")
    d = releases.deltas(releases.relevant(r, since, True))
    assert sorted((x.ord.release_ord, x.entity_name, x.action, x.note) for x in d.filter("entity_name is not null").collect()) == [
        (1, "ABC Finance Ltd", "Cancelled", None), (1, "PQR Leasing Private Limited", "Cancelled", None), (1, "XYZ Capital Limited", "Cancelled", None), (4, "Solo Finance Ltd", "Restored", None)]
    assert [(x.pr_link, x.note) for x in d.filter("entity_name is null").collect()] == [("l2", "names not extracted")]
    assert releases.relevant(r, since, False).filter("ord = 4").count() == 0
    assert releases.with_feed(d, d).count() == d.count() and [x.link for x in releases.incomplete(r, d).collect()] == ["l2"]


def test_tables_and_links():
    page = markup.Page("<table><tr><th>Sr No<th>Name</tr><tr><td>1<td>A<br>B <table><tr><td>in</td></tr></table></td></tr></table><script>no</script><a href='/x?prid=1'>A title</a>")
    assert page.tables[0][1] == ["1", "A B in"] or page.tables[0][1][1].startswith("A B")
    assert page.tables[1] == [["in"]] and "no" not in page.text.split() and page.links[-1][:2] == ("/x?prid=1", "A title")
    hub = "<table><tr><th>S</th><th>Type</th><th>Count</th></tr><tr><td>1</td><td>Brokers</td><td><a href='x?intmId=30'>12</a></td></tr><tr><td>2</td><td>Agents</td><td>7</td></tr></table>"
    assert markup.hub_counts(hub) == [("30", "Brokers", 12)] and markup.hub_counts(None) == []


def test_table_names(spark):
    """Title rows, Devanagari columns, serial labels, short rows, tables of one row; releases with sequels and misplaced headers."""
    row = lambda *c: "<tr>" + "".join(f"<td>{x}</td>" for x in c) + "</tr>"
    table = lambda *rows: "<table>" + "".join(row(*r) for r in rows) + "</table>"
    pages = [
        table(("title",), ("मराठी name", "English name"), ("अ", "Foo Ltd"), ("ब",)), table(("a", "b"), ("1", "2"), ("3", "")), table(("Name", "x")), "", "<p>no table</p>",
        table(("No", "Company"), ("Sl. No.", "Sl. No."), ("1", " Alpha Ltd ")) + table(("Registered entity",), ("x", "Institution"), ("1", "Beta")),
        table(("Name", "Agent"), ("क", "C Ltd"), ("ख", "D Ltd")),
    ]
    df = spark.createDataFrame(list(enumerate(pages)), "i int, html string")
    got = {r.i: r.n for r in df.select("i", documents.table_names(F.col("html")).alias("n")).collect()}
    assert got == {0: ["Foo Ltd"], 1: ["1", "3"], 2: [], 3: [], 4: [], 5: ["Alpha Ltd", "Beta"], 6: ["C Ltd", "D Ltd"]}
    registers = ["<p>Name\nAlpha Ltd\nRegistration No. 1</p><p>Name\nBeta Ltd\nRegistration No. 2</p>", table(("No", "Name"), ("1", "C"), ("2", ""), ("3", "C")), None]
    df = spark.createDataFrame(list(enumerate(registers)), "i int, html string")
    assert {r.i: r.n for r in df.select("i", documents.intermediary_names(F.col("html")).alias("n")).collect()} == {0: ["Alpha Ltd", "Beta Ltd"], 1: ["C"], 2: []}
    head = ("Sr. No", "Name of the company", "Date")
    releases_ = [
        table(head, ("1", "Alpha Finance", "Jan 5, 2024"), ("2", "Beta Finance", "Jan 6, 2024")) + table(("3", "Gamma Finance", "x"), ("4", "Alpha Finance", "y")) + table(("a", "not counted", "z")) + table(("5", "too narrow")),
        table(("No", "Name", "Firm"), ("1", "12", "Delta Leasing"), ("2", "13", "Epsilon Leasing")) + table(("7", "14", "Zeta Leasing")),
        table(("Name", "No"), ("1", "2")) + table(("1", "Lost")), table(("Name of the company",), ("Name",), ("Eta Limited",)), None,
    ]
    df = spark.createDataFrame(list(enumerate(releases_)), "i int, html string")
    got = {r.i: r.n for r in df.select("i", documents.release_table_names(F.col("html")).alias("n")).collect()}
    assert got == {0: ["Alpha Finance", "Beta Finance", "Gamma Finance"], 1: ["Delta Leasing", "Epsilon Leasing", "Zeta Leasing"], 2: [], 3: ["Eta Limited"], 4: []}


def test_lists():
    assert [e.split(".")[0] for e in markup.numbered_entries("1. Alpha, Plot 8. Sector 2. Beta 004. x 5. Far 3. Gamma", reject=sections.REJECT)] == ["Alpha, Plot 8", "Beta 004", "Gamma"]
    assert len(markup.numbered_entries("1. A 2. B 1. C 2. D", restart=True)) == 4 and len(markup.numbered_entries("1. A 2. B 1. C 2. D")) == 2 and markup.numbered_entries(None) == []
    names = "• {} Pension Fund Limited\n"
    text = "List of Pension Funds\nmenu\n" + "List of Pension Funds\n" + "".join(names.format(x) for x in "ABC") + "Note\nZ Pension Fund Limited\n"
    assert markup.list_line_names(text, "^list of pension", "pension", "^note") == [f"{x} Pension Fund Limited" for x in "ABC"]


def test_sections(spark):
    text = "Foreign banks in India\nSr.No\n1. AB Bank PLC 41 Liberty Building, No. 8. Sector 5\n2. BNP Paribas Centre House\nRegional Rural Banks Sr.No 1. Foo Gramin Bank 2. Bar Bank\nState Co-operative Banks\n1. Assam Co-op Bank Ltd. X\n2. Bihar State Co-op Bank Ltd. Y"
    page = spark.createDataFrame([("d", text)], "doc_id string, text string")
    assert sections.foreign_banks(page).first().names == ["AB Bank PLC", "BNP Paribas"]
    r = sections.state_coop_banks(page, ["Assam", "Daman"]).first()
    assert (r.scheduled, r.non_scheduled, r.unmatched) == (["Bihar State Co-op Bank Ltd."], ["Assam Co-op Bank Ltd."], ["Daman"])
    assert page.select(sections.listed_banks(F.col("text"), "rrb")).first()[0][:2] == ["Foo Gramin Bank", "Bar Bank"]
    pay = "A. Certificates of Authorisation issued by RBI to set up and operate systems in India today\n1.\tRazorpay Software Pvt Ltd\tB\n2.\tBank of India\tMumbai\n1.\tRazorpay Software Private Limited (formerly X)\tB\nB. Certificates of Authorisation Revoked\n1. Foo Ltd"
    got = sections.payment_entities(spark.createDataFrame([("d", pay)], "doc_id string, text string"), "operating").orderBy("pos").collect()
    assert [x.name for x in got] == ["Razorpay Software Private Limited (formerly X)", "Bank of India"]
    assert one(spark, sections.local_area_banks, "1. Coastal Local Area Bank Ltd\tAddr\nCoastal Local Area Bank Limited") == [["Coastal Local Area Bank Ltd"]]


def book(rows):
    cell = lambda r, c, v: f'<c r="{chr(65 + c)}{r}" t="inlineStr"><is><t>{v}</t></is></c>'
    sheet = "".join(f"<row>{''.join(cell(i + 1, j, v) for j, v in enumerate(r) if v)}</row>" for i, r in enumerate(rows))
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook {ns} xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets><sheet name="S" r:id="a"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="a" Target="worksheets/s.xml"/></Relationships>')
        z.writestr("xl/worksheets/s.xml", f"<worksheet {ns}><sheetData>{sheet}</sheetData></worksheet>")
    return out.getvalue()


def test_staged(spark, tmp_path):
    b = book([["List as on March 5, 2024"], ["Sl. No.", "Name", "Classification"], ["1", "A Ltd", "HFC"], ["2", "B Ltd", ""], ["3", "A Ltd", ""]])
    assert markup.workbook_names(b) == ([("A Ltd", "HFC"), ("B Ltd", None)], "List as on March 5, 2024")
    for key, name, data in (("x", "f.xlsx", b), ("h", "f.xls", b"<html><table><tr><th>No</th><th>Name</th></tr><tr><td>1</td><td>H Ltd</td></tr></table>"), ("c", "f.csv", b'Sr,Name\n1,"C, D Ltd"\n2,"E ""Q"" Ltd"'), ("u", "f.bin", bytes(range(256)))):
        (tmp_path / key).mkdir()
        (tmp_path / key / name).write_bytes(data)
    files = staged.read_staged(spark, str(tmp_path))
    assert {r.source_key: r.kind for r in files.collect()} == {"x": "xlsx", "h": "html", "c": "csv", "u": "unknown"}
    got = sorted((r.source_key, r.pos, r.name, r.classification) for r in staged.staged_names(staged.newest(files)).collect())
    assert got == [("c", 0, "C, D Ltd", None), ("c", 1, 'E "Q" Ltd', None), ("h", 0, "H Ltd", None), ("x", 0, "A Ltd", "HFC"), ("x", 1, "B Ltd", None)]
    assert one(spark, staged.text_line_names, "Page 1\n12\nSr. No\nAlpha  Ltd") == [["Alpha Ltd"]]


def test_feeds(spark):
    xml = "<rss><item><title>A &amp; B</title><link>http://l</link><pubDate>Mon, 05 Feb 2024 10:00:00</pubDate></item><item><title><![CDATA[C]]></title></item></rss>"
    assert [(r.title, r.link, str(r.pub_date)) for r in staged.feed_items(spark.createDataFrame([("f", xml)], "feed string, xml string")).orderBy("pos").collect()] == [("A & B", "http://l", "2024-02-05"), ("C", "", "None")]
    pages = spark.sql("""select date'2024-01-01' month, 'https://r.in/a/b.aspx' base, '<table><tr><td>Date : Jan 05, 2024</td><td><a href="x.aspx?prid=5">RBI cancels it</a></td></tr><tr><td><a href="y?prid=6">An undated one</a></td></tr></table>' html""")
    assert [(r.link, str(r.stated_date), str(r.effective_date)) for r in staged.listing_entries(pages).orderBy("pos").collect()] == [("https://r.in/a/x.aspx?prid=5", "2024-01-05", "2024-01-05"), ("https://r.in/a/y?prid=6", "None", "2024-01-01")]


def test_paging(spark):
    page = lambda *rows: spark.createDataFrame(list(rows), "source_key string, page_ix int, names array<string>, target int")
    walk = lambda p: [(r.page_ix, r.reason) for r in paging.walked_pages(p).orderBy("page_ix").collect()]
    assert walk(page(("s", 1, ["A", "B"], None), ("s", 2, ["C"], None), ("s", 3, ["A", "B"], None), ("s", 4, ["Z"], None))) == [(1, None), (2, "repeated page")]
    assert walk(page(("s", 1, ["A", "B"], 3), ("s", 2, ["C"], 3), ("s", 3, ["D"], 3))) == [(1, None), (2, "target")]
    dry = page(("s", 1, ["A", "B", "C"], None), ("s", 2, ["A"], None), ("s", 3, ["B"], None), ("s", 4, ["C"], None), ("s", 5, ["D"], None))
    assert walk(dry)[-1] == (4, "no new names")
    files = spark.createDataFrame([("s", "A")], "source_key string, name string")
    assert paging.topped_up(files, dry).count() == 1 and paging.topped_up(files, dry, True).count() == 4


def test_hub_ids(spark):
    s = spark.createDataFrame([("a", "1", "broker"), ("b", "2", None), ("c", "3", "agent")], "source_key string, intm_id string, label_hint string")
    hub = spark.createDataFrame([("1", "Agents", 5), ("9", "Brokers", 7), ("3", "Other", 2), ("4", "Agents too", 1)], "intm_id string, label string, expected_count int")
    got = {r.source_key: (r.intm_id, r.expected_count, r.changed_from, r.warning) for r in ingest.hub_ids(s, hub).collect()}
    assert got == {"a": ("9", 7, "1", "id replaced"), "b": ("2", None, None, None), "c": ("3", 2, None, "more than one hub row matches")}


def test_audit_rows(spark):
    """The audit example: an entity of two sources, one of one."""
    rows = [(1, "Acme Securities Ltd", "Stock Brokers in equity segment", "sebi_broker_equity"), (2, "Acme Securities Ltd", "Mutual Funds", "sebi_mutual_funds"), (3, "Beta Brokers Ltd", "Stock Brokers in equity segment", "sebi_broker_equity")]
    h = spark.createDataFrame(rows, "ord long, name string, category_regulator string, source_key string").select("ord", "name", F.lit("O").alias("category_return"), "category_regulator", F.lit("SEBI").alias("regulator"), "source_key", F.lit("Active").alias("status"))
    keys = h.select("name", clean.sheet_key(F.col("name")).alias("entity_key")).distinct()
    r = resolve.resolve(h, keys)
    log = spark.createDataFrame([("sebi_broker_equity", "ok", 2, 3, None), ("none", "error", 0, None, "x")], "source_key string, status string, count int, expected_count int, note string")
    got = {x.source_key: (x.scraped, x.diff, x.unique_entities, x.combine_rows, x.held_back) for x in reports.source_reconciliation(h, keys, r, log).collect()}
    assert got == {"sebi_broker_equity": (2, -1, 2, 2, 1), "none": (0, None, 0, 0, 0)}
    assert reports.membership_rows(h, keys, r).count() == 3 and reports.multi_category(r).count() == 1
    final = spark.createDataFrame([("Beta Brokers Limited", "Cancelled")], "name string, final_status string")
    new = reports.with_final_status(h, entities.entity_keys(h), final, entities.entity_keys(final), ("sebi_broker_equity",))
    assert {(x.name, x.status) for x in new.collect()} == {("Acme Securities Ltd", "Active"), ("Beta Brokers Ltd", "Cancelled")}
    assert reports.run_totals(log).first().failed == 1


def test_catalog(spark):
    s = catalog.sources(spark)
    assert s.count() == 54 and s.filter("type = 'sebi_intermediary_custom'").count() == 19 and s.filter("english").count() == 8
    ranks = {r.category: r.rank for r in s.select("category", resolve.category_rank(F.col("category")).alias("rank")).distinct().collect()}
    assert ranks["Public Sector Banks in India"] == 1 and ranks["Pension Fund"] == 6 and ranks["PSS Ceased"] == 999 and ranks["Mutual Funds"] == 5


def test_sheets(spark, tmp_path):
    df = spark.createDataFrame([("s", "n", "c", "Active")], "source_key string, name string, category string, status string")
    for form in ("csv", "json", "parquet"):
        staged.write_sheets({"combine_list": df}, str(tmp_path), form)
    assert staged.previous_snapshot(spark, str(tmp_path)).collect() == df.collect()


def test_stream_equals_batch(spark, tmp_path):
    rows = [(1, "A Ltd", "Cancelled", "2024-01-05"), (2, "A Limited", "Restored", "2024-01-01"), (3, "B Ltd", "Suspended", "2024-01-01"), (4, "a ltd.", "Restored", "2024-01-05"), (5, None, "Restored", "2024-01-09")]
    df = spark.createDataFrame(rows, "ord long, entity_name string, action string, effective_date string").withColumn("effective_date", F.to_date("effective_date"))
    inbox = str(tmp_path / "in")
    for i in (3, 1, 2, 4, 5):  # one file an arrival, out of order
        df.filter(F.col("ord") == i).coalesce(1).write.mode("append").parquet(inbox)
    live = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 2).parquet(inbox)
    stream.write_latest(live, str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination(120)
    got = sorted(map(tuple, stream.current(spark.read.parquet(str(tmp_path / "out"))).collect()))
    assert got == sorted(map(tuple, stream.latest(df).collect())) and dict((r[0], r[1]) for r in got) == {"ALTD": "Active", "BLTD": "Suspended"}
