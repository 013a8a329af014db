"""Documents, sections, walks, releases and entities over the test tables, and the same in DuckDB SQL.

Pages are written out of table rows by Spark; what comes back is compared with what they were written from.
"""

from __future__ import annotations

import datetime
import uuid

from pyspark.sql import functions as F

from ..functions import clean, documents, names as N, tabular
from ..operators import columns, entities, ingest, paging, releases, reports, resolve, scans, sections, status
from ..operators.components import durable, shared_dir
from ..sources import catalog, staged
from ..streaming import status as stream
from . import registered, registers, run
from .registers import BASE, DELTAS, _sql

WORD = "translate(s_name, '#0123456789', 'NABCDEFGHIJ')"
SUPPLIERS = f"select s_nationkey as nation, {WORD} as w, s_suppkey as k, row_number() over (partition by s_nationkey order by s_suppkey) as n, count(*) over (partition by s_nationkey) as total from supplier"


def _lines(spark, sf_dir, *exprs: str, least: int = 1):
    """A row per nation: for each SQL expression over a supplier's row the ordered array of its values; nations of `least` suppliers or more."""
    d = _sql(spark, sf_dir, SUPPLIERS, "supplier").filter(f"total >= {least}")
    row = F.struct("n", *[F.expr(e).alias(f"e{i}") for i, e in enumerate(exprs)])
    g = d.groupBy("nation").agg(F.array_sort(F.collect_list(row)).alias("rows"), F.first("total").alias("total"))
    return g.select("nation", "total", *[F.col(f"rows.e{i}").alias(f"a{i}") for i in range(len(exprs))])


def _join(name: str, by: str = ""):
    return F.array_join(F.col(name), by)


# names

VARIANTS = f"""select c_custkey as id, {BASE} as b, case c_custkey % 8 when 0 then concat({BASE}, ' Ltd formerly known as Old', {BASE}, ' Ltd') when 1 then concat({BASE}, ' Limited (Name as per MCA - New', {BASE}, ' Limited)')
 when 2 then concat({BASE}, ' Ltd merged with Zed Ltd') when 3 then concat({BASE}, ' Limitd') when 4 then concat('जीवन बीमा ', {BASE}, ' Ltd / बीमा') when 5 then concat('भारत (', {BASE}, ' Privat Ltd)') when 6 then concat({BASE}, ' (India) Ltd') else '१२ ab' end as name,
 case when c_custkey % 2 = 0 then 'rbi_nbfc' else 'other' end as source_key, case c_custkey % 3 when 0 then 'Standard Chartered Investments & Loans (India) Limited' when 1 then 'STANDARD CHARTERED INVESTMENTS AND LOANS (INDIA) LTD.' else {BASE} end as published,
 case c_custkey % 4 when 0 then concat('list?a=1&intmId=', cast(c_custkey as varchar(9))) when 1 then concat('list?intmId=', cast(c_custkey as varchar(9)), '&x=2') when 2 then 'list?aintmId=7' else 'list?intmId=7a' end as href from customer"""


def entity_names(spark, sf_dir):
    n = N.entity_names(F.col("name"))
    return _sql(spark, sf_dir, VARIANTS, "customer").filter("id % 8 < 3 or id % 8 = 6").select("id", n["primary"].alias("primary_name"), F.array_join(n["aliases"], "|").alias("aliases"))


def repair_legal_form(spark, sf_dir):
    return _sql(spark, sf_dir, VARIANTS, "customer").filter("id % 8 in (2, 3, 5)").select("id", N.repair_legal_form(clean.strip_devanagari(F.col("name"))).alias("repaired"))


def english_only(spark, sf_dir):
    s = clean.strip_devanagari(F.col("name"))
    return _sql(spark, sf_dir, VARIANTS, "customer").select("id", s.alias("latin"), N.is_english_name(s).alias("english"), N.is_english_name(F.col("name")).alias("raw_english"))


def name_overrides(spark, sf_dir):
    return _sql(spark, sf_dir, VARIANTS, "customer").select("id", clean.override_name(F.col("source_key"), F.col("published"), clean.OVERRIDES).alias("name"), clean.link_id(F.col("href")).alias("link_id"))


MATCH_MASTER = f"""select c_custkey as ord, concat({BASE}, ' Private Limited', case when c_custkey % 6 = 3 then concat(' (Formerly known as Old ', {BASE}, ' Ltd)') else '' end) as name, 'Active' as status from customer"""
MENTIONS = f"""select c_custkey as ord, case c_custkey % 6 when 0 then concat(upper({BASE}), ' PVT. LTD.') when 1 then concat('M/s ', {BASE}, ' (P) Ltd') when 2 then concat('Xeta', {BASE}, ' Ltd (Formerly known as ', {BASE}, ' Private Limited)')
 when 3 then concat('Old ', {BASE}, ' Ltd') when 4 then concat(replace({BASE}, 'Customer', 'Customar'), ' Private Limited') else concat('Zeta', {BASE}, ' Ltd') end as entity_name from customer"""


def match_cascade(spark, sf_dir):
    master = _sql(spark, sf_dir, MATCH_MASTER, "customer").withColumn("master_key", N.normalize_name(F.col("name")))
    return status.match(master, _sql(spark, sf_dir, MENTIONS, "customer")).select(F.col("delta_ord").alias("ord"), "master_key", F.col("tier").cast("long").alias("tier"))


CHAINS = """select c_custkey as id, concat(c_name, ' Ltd', case when c_custkey % 5 <> 4 then concat(' (formerly ', replace(c_name, lpad(cast(c_custkey as varchar(9)), 9, '0'), lpad(cast(c_custkey + 1 as varchar(9)), 9, '0')), ' Ltd)') else '' end) as name from customer
 union all select c_custkey, concat(replace(c_name, 'Customer', 'Customar'), ' Limited') from customer where c_custkey % 10 = 0"""


def entity_components(spark, sf_dir):
    """Five customers in a row are one entity by former names; every tenth has a slip of one letter."""
    c = _sql(spark, sf_dir, CHAINS, "customer")
    return c.join(entities.entity_keys(c), "name").select("id", "name", "entity_key")


# documents


def table_columns(spark, sf_dir):
    """Tables as steps over cells: a title row, a header, a Devanagari column in front of the Latin one, a serial label."""
    row = "concat('<tr><td>', n, '</td><td>', case when nation % 2 = 0 then 'बीमा कंपनी' else concat(w, ' Ltd') end, '</td><td>', w, ' Agency Ltd</td><td>Jan 5, 2024</td></tr>')"
    p = _lines(spark, sf_dir, row)
    html = F.concat(F.lit("<table><tr><td>Register</td></tr><tr><th>Sl. No</th><th>Name</th><th>Agent of the insurer</th><th>Date</th></tr>"), _join("a0"), F.lit("<tr><td></td><td>Sl. No.</td><td>Sl. No.</td></tr></table>"))
    rows = p.select(F.col("nation").alias("doc_id"), F.explode(documents.html_tables(html)).alias("t")).select("doc_id", "t.*")
    return columns.table_names(rows).select(F.col("doc_id").alias("nation"), "name")


def column_scores(spark, sf_dir):
    """Shares and lengths of the columns of release tables, and the column their names are read from."""
    row = "concat('<tr><td>', n, '</td><td>', 1000 + n, '</td><td>', w, ' Finance Limited</td><td>', w, '</td></tr>')"
    p = _lines(spark, sf_dir, row)
    html = F.concat(F.lit("<table><tr><th>Sr</th><th>Name of the company</th><th>Holder</th><th>Code</th></tr>"), _join("a0"), F.lit("</table>"))
    rows = p.select(F.col("nation").alias("doc_id"), F.explode(documents.html_tables(html)).alias("t")).select("doc_id", "t.*")
    s = columns.column_scores(rows).join(columns.release_columns(rows).withColumnRenamed("col", "chosen"), columns.TABLE)
    return s.select(F.col("doc_id").alias("nation"), F.col("col").cast("long").alias("col"), "label", "filled", "text_share", "number_share", "mean_length", F.col("chosen").cast("long").alias("chosen"))


def html_to_text(spark, sf_dir):
    p = spark.read.parquet(f"{sf_dir}/supplier.parquet").select("s_suppkey", F.concat(F.lit("<div>A  <b>"), "s_name", F.lit("</b>\n &amp; Co.<script>x()</script></div><table><tr><td>B</td><td> C </td></tr></table>")).alias("html"))
    return p.select("s_suppkey", documents.html_text(F.col("html")).alias("flat"), documents.html_lines(F.col("html")).alias("lines"), clean.structured_text(F.concat(F.lit(" a \t b\r\n\n"), documents.html_lines(F.col("html")))).alias("kept"))


def intermediary_pages(spark, sf_dir):
    """Registers as tables and, for odd nations, as label and value pairs."""
    p = _lines(spark, sf_dir, "concat('<tr><td>', w, ' Broking Ltd</td><td>INZ', k, '</td></tr>')", "concat('<p>Name</p><p>', w, ' Broking Ltd</p><p>Registration No. INZ', k, '</p>')")
    html = F.when(F.col("nation") % 2 == 0, F.concat(F.lit("<table><tr><th>Name</th><th>Registration No.</th></tr>"), _join("a0"), F.lit("</table>"))).otherwise(_join("a1"))
    return p.select("nation", F.explode(documents.intermediary_names(html)).alias("name"))


def member_pages(spark, sf_dir):
    p = spark.read.parquet(f"{sf_dir}/supplier.parquet").select("s_suppkey", F.concat(F.lit("<h1>Fund</h1><p>Name of Assest Management Co. : "), "s_name", F.lit(" AMC Ltd</p><p>Address</p>")).alias("html"))
    return p.select("s_suppkey", clean.manager_name(documents.html_lines(F.col("html"))).alias("name"))


def list_lines(spark, sf_dir):
    """Fund names among the 40 lines below the last heading that has any; shorter and longer spellings of one name once."""
    p = _lines(spark, sf_dir, "concat('• ', w, ' Pension Fund Limited')", least=3)
    text = F.concat_ws("\n", F.lit("About pension funds"), F.lit("List of Pension Funds"), _join("a0", "\n"), F.concat(F.get("a0", F.lit(0)), F.lit(".")), F.lit("Charges of 5 % pension limited"), F.lit("Note"), F.lit("Other Pension Fund Limited"))
    x = catalog.PENSION
    return p.select("nation", F.explode(documents.list_line_names(text, x["heading"], x["keyword"], x["stop"])).alias("name"))


def staged_texts(spark, sf_dir):
    """CSV rows, text lines and kinds of content."""
    p = _lines(spark, sf_dir, "concat(n, ',\"', w, ', ', 'The \"\"Best\"\" Ltd\"')", "concat('  ', w, '  Ltd')")
    csv, text = F.concat(F.lit("Sr,Full Name,Company\n"), _join("a0", "\n")), F.concat(F.lit("Page 1\nSr. No\n12\nabc\n"), _join("a1", "\n"))
    kinds = [(csv, "x.bin"), (F.concat(F.lit("\n <TABLE>"), csv), "x.xls"), (F.concat(F.lit(" " * 600 + "<p>"), F.lit("<table>")), "y.bin"), (F.lit("%PDF-1.4"), "z"), (F.lit("PK\u0003\u0004"), "w.xls"), (text, "v.txt")]
    kind = F.array_join(F.array(*[staged.kind_of(F.encode(c, "UTF-8"), F.lit(path)) for c, path in kinds]), ",")
    told = p.select("nation", kind.alias("kinds"), F.arrays_zip(staged.csv_names(csv).alias("c"), staged.text_line_names(text).alias("t")).alias("z"))  # beside an explode, kinds would be told once a line
    return told.select("nation", "kinds", F.explode("z").alias("x")).select("nation", "kinds", F.col("x.c").alias("csv_name"), F.col("x.t").alias("line"))


def feed_listing(spark, sf_dir):
    """Releases of a feed and of a month's listing, dated and undated."""
    item = "concat('<item><title>RBI cancels ', w, ' &amp; Co</title><link>x?prid=', k, '</link>', case when n % 3 = 0 then '' else concat('<pubDate>Mon, ', lpad(cast(n % 28 + 1 as string), 2, '0'), ' Feb 2024 10:00:00</pubDate>') end, '</item>')"
    row = "concat('<tr><td>', case when n % 3 = 0 then '' else concat('Date : Feb ', n % 28 + 1, ', 2024') end, '</td><td><a href=\"x.aspx?prid=', k, '\">RBI cancels ', w, ' &amp; Co</a><a href=\"x.aspx?prid=0\">short</a></td></tr>')"
    p = _lines(spark, sf_dir, item, row)
    f = staged.feed_items(p.select(F.col("nation").alias("feed"), _join("a0").alias("xml"))).select(F.lit("feed").alias("of"), F.col("feed").alias("nation"), "title", "link", F.col("pub_date").alias("day"))
    pages = p.select(F.col("nation"), F.to_date(F.lit("2024-02-01")).alias("month"), F.concat(F.lit("https://r.in/"), F.col("nation").cast("string"), F.lit("/l.aspx")).alias("base"), F.concat(F.lit("<table>"), _join("a1"), F.lit("</table>")).alias("html"))
    e = staged.listing_entries(pages)
    return f.unionByName(e.select(F.lit("listing").alias("of"), F.regexp_extract("link", r"r\.in/(\d+)/", 1).cast(f.schema["nation"].dataType).alias("nation"), "title", F.regexp_extract("link", r"([^/]*)$", 1).alias("link"), F.col("effective_date").alias("day")))


def sql_table_functions(spark, sf_dir):
    """Table functions in SQL: links of pages, entries of a numbered list, cells of a table."""
    tabular.register(spark)
    spark.read.parquet(f"{sf_dir}/pages.parquet").createOrReplaceTempView("pages")
    _sql(spark, sf_dir, f"select k, concat('1. ', w, ' Ltd 2. Second ', w) as list, concat('<table><tr><td>a</td></tr><tr><td>', w, '</td></tr></table>') as html from ({SUPPLIERS})", "supplier").createOrReplaceTempView("lists")
    return spark.sql("""select 'links' as of, page_id as id, count(*) as n, max(href) as last from pages, lateral html_links(html) group by page_id
        union all select 'entries', k, count(*), max(trim(entry)) from lists, lateral numbered_entries(list) group by k
        union all select 'rows', k, max(row_ix) + 1L, max(element_at(cells, 1)) from lists, lateral html_tables(html) where row_ix = 1 group by k""")


def _book(rows: list) -> bytes:
    """A workbook of one sheet whose cells are inline strings."""
    import io
    import zipfile

    cells = lambda i, r: "".join(f'<c r="{chr(65 + j)}{i}" t="inlineStr"><is><t>{v}</t></is></c>' for j, v in enumerate(r))
    space, out = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"', io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook {space} xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets><sheet name="S" r:id="a"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="a" Target="worksheets/s.xml"/></Relationships>')
        z.writestr("xl/worksheets/s.xml", f"<worksheet {space}><sheetData>{''.join(f'<row>{cells(i, r)}</row>' for i, r in enumerate(rows, 1))}</sheetData></worksheet>")
    return out.getvalue()


def workbook_roundtrip(spark, sf_dir):
    """Workbooks with a title row, a header, serial labels and a classification; what is no workbook gives an error and no names."""
    p = _lines(spark, sf_dir, "concat(w, ' Ltd')").withColumn("ok", F.col("nation") % 5 != 4)

    @F.udf("binary")
    def book(names, ok):
        title, head = ["List as on March 5, 2024"], ["Sl. No.", "NBFC Name", "Classification"]
        return _book([title, head, *([str(i), n, "HFC" if i % 2 else ""] for i, n in enumerate(names)), ["", "Sl. No.", ""]]) if ok else b"PK damaged"

    b = p.select("nation", documents.workbook_names(book("a0", "ok")).alias("b"))
    return b.select("nation", N.master_list_date(F.col("b.title")).alias("day"), F.col("b.error").isNotNull().alias("failed"), F.explode_outer("b.names").alias("x")).select("nation", "day", "failed", "x.name", "x.classification")


def hub_counts_page(spark, sf_dir):
    """Counts of a hub page by id: linked rows with a plain number, under a header that says count."""
    p = _lines(spark, sf_dir, "concat('<tr><td>', n, '</td><td><a href=\"l?intmId=', k, '&amp;x=1\">', w, '</a></td><td>', case when n % 4 = 0 then 'n/a' else cast(n * 7 as string) end, '</td></tr>')")
    html = F.concat(F.lit("<table><tr><td>Sr</td><td>Category</td><td>Count</td></tr>"), _join("a0"), F.lit("</table>"))
    return p.select("nation", F.explode(documents.hub_counts(html)).alias("h")).select("nation", "h.*")


def pension_tables(spark, sf_dir):
    """Only tables whose header fits, two companies of a cell apart, names with the keyword, none over 180 characters."""
    p = _lines(spark, sf_dir, "concat('<tr><td>', n, '</td><td>', w, ' Pension Fund Limited New', w, ' Pension Management Ltd</td></tr><tr><td></td><td>', w, ' Other Ltd</td></tr><tr><td></td><td>', repeat('pension ', 30), '</td></tr>')")
    html = F.concat(F.lit("<table><tr><td>No</td><td>Name</td></tr><tr><td>1</td><td>Stray Pension Ltd</td></tr></table><table><tr><th>No</th><th>Name of the Pension Fund</th></tr>"), _join("a0"), F.lit("</table>"))
    x = catalog.PENSION
    return p.select("nation", F.explode(documents.table_names(html, x["tables"], True, x["keyword"])).alias("name"))


def release_sequel(spark, sf_dir):
    """A release's second table without a header goes on where the first one ended, if it counts and is as wide."""
    p = _lines(spark, sf_dir, "concat('<tr><td>', n, '</td><td>', w, ' Leasing Limited</td></tr>')", least=2)
    head = F.slice("a0", F.lit(1), F.floor(F.col("total") / 2).cast("int"))
    tail = F.slice("a0", F.floor(F.col("total") / 2).cast("int") + 1, F.col("total").cast("int"))
    table = lambda h, a: F.concat(F.lit("<table>" + h), F.array_join(a, ""), F.lit("</table>"))
    html = F.concat(table("<tr><th>Sr. No</th><th>Name of the company</th></tr>", head), F.lit("<p>and</p>"), table("", tail), F.lit("<table><tr><td>x</td><td>not a name</td></tr></table>"))
    return p.select("nation", F.explode(documents.release_table_names(html)).alias("name"))


def newest_files(spark, sf_dir):
    f = _sql(spark, sf_dir, "select event_type as source_key, concat('in/', event_type, '/', cast(event_id % 50 as varchar(9)), '-', cast(event_id as varchar(9)), '.html') as path, ts as modified from events", "events")
    got = scans.numbered(staged.newest(f))
    return got.select("source_key", "path", F.col("url_ix").cast("long").alias("url_ix"), F.col("page_ix").cast("long").alias("page_ix"))


def published_sheets(spark, sf_dir):
    """The membership relation written as a sheet, and read again as the previous run's rows."""
    base = f"{shared_dir(spark)}/published-sheets-{uuid.uuid4().hex}"
    staged.write_sheets({"combine_list": reports.membership_rows(*registers._hits(spark, sf_dir))}, base)
    return staged.previous_snapshot(spark, base)


# sections


def bank_sections(spark, sf_dir):
    """All lists of the banks' page: plain, foreign with addresses, local area banks, state co-operative ones split by keywords."""
    p = _lines(spark, sf_dir, "concat(n, '. ', w, ' Bank PLC 41 Liberty Building, No. 99. Sector')", "concat(n, '. ', w, ' Gramin Bank')", "concat(w, ' Local Area Bank Ltd')", "concat(n, '. ', w, ' State Co-op Bank Ltd. Plot 5')")
    part = lambda head, name: F.concat(F.lit(head + "\n"), _join(name, "\n"))
    text = F.concat_ws("\n", part("Foreign banks in India\nSr.No", "a0"), part("Regional Rural Banks Sr.No", "a1"), part("State Co-operative Banks", "a3"), _join("a2", "\n"))
    pages = p.select(F.col("nation").alias("doc_id"), text.alias("text"))
    out = None
    for s in ("foreign", "lab", "none"):
        got = sections.bank_section(pages, s).select(F.col("doc_id").alias("nation"), F.lit(s).alias("section"), F.explode("names").alias("name"))
        out = got if out is None else out.union(got)
    rural = sections.bank_section(pages.withColumn("text", F.concat(F.lit("Regional Rural Banks Sr.No "), F.regexp_extract("text", r"(?s)Regional Rural Banks Sr\.No\n(.*?)\nState", 1))), "rrb").select(F.col("doc_id").alias("nation"), F.lit("rrb").alias("section"), F.explode("names").alias("name"))
    coop = sections.state_coop_banks(pages, ["AAAAB", "nowhere"])
    split = [coop.select(F.col("doc_id").alias("nation"), F.lit(c).alias("section"), F.explode(c).alias("name")) for c in ("scheduled", "non_scheduled", "unmatched")]
    return out.union(rural).union(split[0]).union(split[1]).union(split[2].filter("name = 'nowhere'"))


def payment_sections(spark, sf_dir):
    """A lettered section whose list starts anew: of two spellings of one entity the longer, at the first one's place."""
    p = _lines(spark, sf_dir, "concat(n, '.\\t', w, ' Software Pvt Ltd\\tPrepaid')", "concat(n, '.\\t', w, ' Software Private Limited (formerly ', w, ' Soft)\\tPrepaid')", least=2)
    text = F.concat_ws("\n", F.lit("A. Certificates of Authorisation issued by the bank to set up and operate payment systems in India"), _join("a0", "\n"), F.get("a1", F.lit(0)), F.lit("B. Certificates of Authorisation Revoked\n1. Foo Ltd"))
    got = sections.payment_entities(p.select(F.col("nation").alias("doc_id"), text.alias("text")), "operating")
    return got.select(F.col("doc_id").alias("nation"), F.col("pos").cast("long").alias("pos"), "name")


# walks


def walk_stops(spark, sf_dir):
    """Walks of eight pages that end by the target, by a page seen before, by three pages without a new name, or not at all."""
    n = spark.read.parquet(f"{sf_dir}/nation.parquet").select("n_nationkey", "n_name", F.explode(F.sequence(F.lit(1), F.lit(8))).alias("page_ix"))
    kind = F.col("n_nationkey") % 4
    name = lambda i: F.concat("n_name", F.lit(" "), i.cast("string"), F.lit(" Ltd"))
    fresh = F.transform(F.sequence(F.col("page_ix") * 10 - 9, F.col("page_ix") * 10), name)
    old = F.transform(F.sequence(F.lit(1), 11 - F.col("page_ix")), name)
    first = F.transform(F.sequence(F.lit(1), F.lit(10)), name)
    pages = n.select(F.col("n_name").alias("source_key"), "page_ix", F.when((kind == 1) & (F.col("page_ix") == 4), first).when((kind == 2) & (F.col("page_ix") > 2), old).otherwise(fresh).alias("names"), F.when(kind == 0, 25).cast("int").alias("target"))
    return paging.walked_pages(pages).select("source_key", F.col("page_ix").cast("long").alias("page_ix"), "n_new", "reason")


def page_names(spark, sf_dir):
    """Of each key the first spelling; a download's names, topped up from pages where it lacks them."""
    s = _sql(spark, sf_dir, SUPPLIERS, "supplier")
    pages = s.select(F.concat(F.lit("s"), "nation").alias("source_key"), F.lit(1).alias("page_ix"), F.array(F.concat("w", F.lit(" Limited"))).alias("names")).union(s.select(F.concat(F.lit("s"), "nation"), F.lit(2), F.array(F.concat("w", F.lit(" Ltd.")), F.concat("w", F.lit(" Two Ltd")))))
    files = s.filter("n % 2 = 0").select(F.concat(F.lit("s"), "nation").alias("source_key"), F.concat(F.upper("w"), F.lit(" LTD")).alias("name"))
    return paging.topped_up(files, pages, True).select("source_key", "key", "name")


def table_page_stop(spark, sf_dir):
    """A paged table ends in front of the first page that adds no name, though later ones would."""
    n = spark.read.parquet(f"{sf_dir}/nation.parquet").select("n_nationkey", "n_name", F.explode(F.sequence(F.lit(1), F.lit(8))).alias("page_ix"))
    stale = (F.col("n_nationkey") % 2 == 0) & (F.col("page_ix") == 2 + F.col("n_nationkey") % 5)
    names = F.transform(F.sequence(F.col("page_ix") * 5 - 4, F.col("page_ix") * 5), lambda i: F.concat("n_name", F.lit(" "), i.cast("string")))
    first = F.transform(F.sequence(F.lit(1), F.lit(5)), lambda i: F.concat("n_name", F.lit(" "), i.cast("string")))
    pages = n.select(F.col("n_name").alias("source_key"), "page_ix", F.when(stale, first).otherwise(names).alias("names"))
    return paging.table_pages(pages).select("source_key", F.col("page_ix").cast("long").alias("page_ix"), "n_new")


def _table(column: str):
    return F.concat(F.lit("<html><table><tr><th>No</th><th>Name of the Company</th></tr>"), _join(column), F.lit("</table>"))


def alternative_addresses(spark, sf_dir):
    """The first address that gives names counts; a paged list goes on at that address until a page adds none."""
    p = _lines(spark, sf_dir, "concat('<tr><td>', n, '</td><td>', w, ' One</td></tr>')", "concat('<tr><td>', n, '</td><td>', w, ' Two</td></tr>')", "concat('<tr><td>', n, '</td><td>', w, ' Three</td></tr>')")
    moved, paged = F.col("nation") % 3 == 0, F.col("nation") % 3 == 2
    page = lambda url, no, html: F.struct(F.lit(url).alias("url_ix"), F.lit(no).alias("page_ix"), F.encode(html, "UTF-8").alias("content"))
    rows = [page(0, 0, F.when(moved, F.lit("<html>moved</html>")).otherwise(_table("a0"))), page(0, 1, _table("a1")), page(0, 2, _table("a0")), page(0, 3, _table("a2")), page(1, 0, _table("a2"))]
    f = p.select(F.concat(F.lit("s"), "nation").alias("source_key"), paged.alias("paginate"), F.lit(False).alias("split"), F.inline(F.array(*rows)))
    return scans.table_scan(f).select("source_key", "name")


def link_choice(spark, sf_dir):
    """Of a page's links the first whose address or text names a document."""
    p = spark.read.parquet(f"{sf_dir}/supplier.parquet").withColumn("k", F.col("s_suppkey") % 3)
    links = F.when(F.col("k") == 0, F.concat(F.lit('<a href="/about">About</a><a href="f/'), "s_suppkey", F.lit('.PDF">List</a><a href="g.pdf">x</a>'))).when(F.col("k") == 1, F.concat(F.lit('<a href="get?id='), "s_suppkey", F.lit('">list.xlsx</a>'))).otherwise("<a href='/about'>About</a>")
    return staged.linked_file(p.select(F.concat(F.lit("s"), "s_suppkey").alias("source_key"), F.lit("https://r.in/a/b.aspx").alias("base"), links.alias("html")))


def scanned_registers(spark, sf_dir):
    """Registers of several types from one staged folder: an address that moved, texts, shared bank and payment pages, members, intermediaries, funds."""
    p = _lines(
        spark, sf_dir, "concat('<tr><td>', n, '</td><td>', w, ' Life Ltd</td></tr>')", "concat(w, ' Housing Ltd')", "concat(w, ' Local Area Bank Ltd')", "concat(n, '. ', w, ' Bank PLC 41 Liberty Building')",
        "concat(n, '.\t', w, ' Wallet Pvt Ltd\tPrepaid')", "concat('<tr><td>', n, '</td><td>', w, ' Pension Fund Limited</td></tr>')", "concat(n, '. ', w, ' State Co-op Bank Ltd. Plot 5')", least=2,
    )
    text = F.concat_ws("\n", F.lit("Foreign banks in India\nSr.No"), _join("a3", "\n"), F.lit("State Co-operative Banks"), _join("a6", "\n"), _join("a2", "\n"))
    pay = F.concat_ws("\n", F.lit("A. Certificates of Authorisation issued by the bank to set up and operate payment systems in India"), _join("a4", "\n"), F.lit("B. Certificates of Authorisation Revoked\n1. Foo Ltd"))
    funds = F.concat(F.lit("<html><table><tr><th>No</th><th>Name of the Pension Fund</th></tr>"), _join("a5"), F.lit("</table>"))
    files = [(0, "irdai_life/0-0.html", F.lit("<html>moved</html>")), (0, "irdai_life/1-0.html", _table("a0")), (1, "nhb_hfc/list.txt", _join("a1", "\n")), (2, "rbi_banks/page.txt", text), (3, "rbi_pss/page.txt", pay),
             (4, "amfi_amc/1.html", F.concat(F.lit("<html><p>Name of Assest Management Co. : Nation "), F.col("nation").cast("string"), F.lit(" AMC</p>"))), (5, "sebi_credit_rating/0-0.html", _table("a0")), (6, "pfrda_pension_fund/0-0.html", funds)]
    cell = lambda n, path, c: F.when(F.col("nation") == n, F.struct(F.lit(path.split("/")[0]).alias("source_key"), F.lit("in/" + path).alias("path"), F.encode(c, "UTF-8").alias("content")))
    f = p.select(F.inline(F.filter(F.array(*[cell(*x) for x in files]), lambda x: x.isNotNull())))
    f = durable(f.withColumn("modified", F.lit("2024-01-01").cast("timestamp")).withColumn("kind", staged.kind_of(F.col("content"), F.col("path"))).coalesce(1))
    got = scans.scan(f, catalog.sources(spark))
    return got.runs.join(got.names, "source_key", "left").select("source_key", F.col("status").alias("run"), "error", "name")


def catch_up_changes(spark, sf_dir):
    """Only listings from the master list's month on are walked, and only releases from its day on; pages give the names, the feed adds to them."""
    row = "concat('<tr><td>Date : Feb ', n * 7 % 28 + 1, ', 2024</td><td><a href=\"x.aspx?prid=', k, '\">RBI cancels CoR of one NBFC</a></td></tr>')"
    item = "concat('<item><title>RBI cancels CoR of one NBFC</title><link>https://r.in/x.aspx?prid=', k, '</link><pubDate>Mon, ', lpad(cast(n * 7 % 28 + 1 as string), 2, '0'), ' Feb 2024 10:00:00</pubDate></item>')"
    p = _lines(spark, sf_dir, row, item)
    months = F.explode(F.array(F.lit("2024-01"), F.lit("2024-02"), F.lit("2024-03"))).alias("m")
    utf8 = lambda c: F.encode(c, "UTF-8").alias("content")
    lists = p.select("nation", "a0", months).filter("m <> '2024-03' and nation < 3").select(F.lit("rbi_releases").alias("source_key"), F.concat(F.lit("in/rbi_releases/"), "m", F.lit(".html")).alias("path"), utf8(F.concat(F.lit("<html><table>"), _join("a0"), F.lit("</table>"))))
    pages = _sql(spark, sf_dir, SUPPLIERS, "supplier").select(F.lit("rbi_release_pages"), F.concat(F.lit("in/rbi_release_pages/prid-"), "k", F.lit(".html")), utf8(F.concat(F.lit("<html><table><tr><td>Sr</td><td>Name of the company</td></tr><tr><td>1</td><td>"), "w", F.lit(" Finance Limited</td></tr></table>"))))
    feed = p.filter("nation < 5").select(F.lit("rbi_feed"), F.concat(F.lit("in/rbi_feed/"), F.col("nation").cast("string"), F.lit(".xml")), utf8(_join("a1")))
    d, _ = run.changes(lists.union(pages).union(feed), datetime.date(2024, 2, 10), datetime.date(2024, 2, 29), "https://r.in/")
    return d.select("entity_name", "action", "effective_date", "pr_link", "expected_count")


def hub_id_resolution(spark, sf_dir):
    """Configured ids whose label does not fit their hint give way to the only row that fits, or carry a warning."""
    n = spark.read.parquet(f"{sf_dir}/nation.parquet").select(F.col("n_nationkey").cast("int").alias("k"), F.col("n_name").alias("name"))
    kind = F.col("k") % 4
    sources = n.select(F.concat(F.lit("s"), "k").alias("source_key"), F.col("k").cast("string").alias("intm_id"), F.when(kind != 3, F.concat(F.lower("name"), F.lit(r"\s+funds?$"))).alias("label_hint"))
    hub = n.select(F.col("k").cast("string").alias("intm_id"), F.when(kind.isin(0, 3), F.concat("name", F.lit(" Funds"))).otherwise("Other").alias("label"), (F.col("k") * 3).alias("expected_count"))
    hub = hub.union(n.filter(kind == 1).select((F.col("k") + 100).cast("string"), F.concat("name", F.lit(" Fund")), F.col("k") * 5))
    return ingest.hub_ids(sources, hub)


# releases and status

RELEASES = """select event_id as ord, case event_type when 'error' then 'RBI cancels CoR of one NBFC' when 'signup' then 'RBI restores CoR of two NBFCs' when 'purchase' then 'Application form to surrender CoR' else 'Daily bulletin' end as title,
 case when event_id % 7 = 0 then null else date_add(date'2024-01-01', cast(event_id % 60 as int)) end as effective_date from events"""


def release_window(spark, sf_dir):
    """An archive counts its first day in and keeps undated releases; a feed does neither."""
    spark.read.parquet(f"{sf_dir}/events.parquet").createOrReplaceTempView("events")
    r = spark.sql(RELEASES)
    out = [releases.relevant(r, F.to_date(F.lit("2024-01-20")), inclusive).select(F.lit(name).alias("of"), "ord", "action", "effective_date") for name, inclusive in (("archive", True), ("feed", False))]
    return out[0].union(out[1])


def release_changes(spark, sf_dir):
    """Changes of releases as tables, prose, tables topped up from prose, and without names; notes where the title's count differs."""
    p = _lines(spark, sf_dir, "concat('<tr><td>', n, '</td><td>', w, ' Finance Limited</td></tr>')", "concat(n, '. ', w, ' Finance Limited')", least=2)
    table = lambda a: F.concat(F.lit("<table><tr><th>Sr. No</th><th>Name of the company</th></tr>"), F.array_join(a, ""), F.lit("</table>"))
    kind = F.col("nation") % 4
    half = F.slice("a0", F.lit(1), F.floor(F.col("total") / 2).cast("int"))
    html = F.when(kind == 0, table(F.col("a0"))).when(kind == 1, F.concat(F.lit("<p>"), _join("a1", " "), F.lit("</p>"))).when(kind == 2, F.concat(table(half), F.lit("<p>"), _join("a1", " "), F.lit("</p>"))).otherwise("<p>none</p>")
    title = F.concat(F.lit("RBI cancels CoR of "), (F.col("total") + F.when(kind == 1, 1).otherwise(0)).cast("string"), F.lit(" NBFCs"))
    r = p.select(F.col("nation").cast("long").alias("ord"), title.alias("title"), F.concat(F.lit("l"), "nation").alias("link"), F.lit("Cancelled").alias("action"), F.to_date(F.lit("2024-01-05")).alias("effective_date"), html.alias("html"))
    d = releases.deltas(r)
    odd = releases.incomplete(r, d).select("link", F.lit(True).alias("kept"))
    return d.join(odd, d.pr_link == odd.link, "left").select("pr_link", "entity_name", "expected_count", "note", F.coalesce("kept", F.lit(False)).alias("kept_raw"))


def _feeds(spark, sf_dir):
    d = _sql(spark, sf_dir, DELTAS, "customer", "events").drop("user_id").withColumn("entity_name", F.expr("case when ord % 7 = 0 then null else entity_name end")).withColumn("pr_link", F.concat("pr_link", F.lit("/"), F.col("ord").cast("string")))
    return d.filter("ord % 3 < 2"), d.filter("ord % 3 > 0")


def feed_union_dedupe(spark, sf_dir):
    return releases.with_feed(*_feeds(spark, sf_dir)).select("ord", "entity_name", "pr_link")


def unattributed(spark, sf_dir):
    """Changes whose release gave no name stay out of the merge and in the log."""
    master = _sql(spark, sf_dir, MATCH_MASTER, "customer")
    return status.change_log(master, _feeds(spark, sf_dir)[0]).filter("name = '(no name extracted)'").select("action", "effective_date", "pr_title", "pr_link", "flag")


def final_hits(spark, sf_dir):
    """Hits of the master registers take their entity's final status, others keep theirs."""
    h = _sql(spark, sf_dir, f"select c_custkey as ord, concat({BASE}, ' Ltd') as name, case when c_custkey % 2 = 0 then 'rbi_nbfc' else 'other' end as source_key, 'Active' as status from customer", "customer")
    final = _sql(spark, sf_dir, f"select concat(upper({BASE}), ' LIMITED') as name, 'Cancelled' as final_status from customer where c_custkey % 3 = 0", "customer")
    keys = lambda d: d.select("name", N.canonical_key(F.col("name")).alias("entity_key")).distinct()
    return reports.with_final_status(h, keys(h), final, keys(final)).select("ord", "name", "source_key", "status")


def run_totals(spark, sf_dir):
    log = _sql(spark, sf_dir, "select c_custkey as source_key, case c_custkey % 5 when 0 then 'ok' when 1 then 'error' when 2 then 'empty' when 3 then 'stale_previous_run' else 'skipped_manual' end as status, c_nationkey as count from customer", "customer")
    return reports.run_totals(log)


def master_entries(spark, sf_dir):
    """Only master registers that were read without fault make the master list."""
    names = _sql(spark, sf_dir, f"select c_custkey as ord, case c_custkey % 3 when 0 then 'rbi_nbfc' when 1 then 'rbi_nbfc_cancelled' else 'irdai_brokers' end as source_key, concat({BASE}, ' Ltd') as name, cast(null as varchar(9)) as classification from customer", "customer")
    runs = spark.createDataFrame([("rbi_nbfc", "ok", None, None), ("rbi_nbfc_cancelled", "error", None, "HTTP 403"), ("irdai_brokers", "ok", None, None)], "source_key string, status string, expected_count int, note string")
    return ingest.ingest(names, runs, catalog.sources(spark), catalog.seeds(spark).limit(0), spark.createDataFrame([], "source_key string, name string, category string, status string")).master.select("name", "status")


def streaming_status(spark, sf_dir):
    """The changes as a stream over the events' files, merged micro-batch by micro-batch; equal to the batch result."""
    spark.read.parquet(f"{sf_dir}/customer.parquet").createOrReplaceTempView("customer")
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parque[t]").createOrReplaceTempView("events")
    base = f"{shared_dir(spark)}/streaming-status-{uuid.uuid4().hex}"
    stream.write_latest(spark.sql(DELTAS), f"{base}/out", f"{base}/state").awaitTermination()
    return stream.current(spark.read.parquet(f"{base}/out")).select("entity_key", "status", "effective_date", "n_changes")


def registry_members(spark, sf_dir):
    """Entities by former names, as the resolved registry sees them: members, and those of several categories."""
    h = registered._hits(spark, sf_dir)
    r = resolve.resolve(h, entities.entity_keys(h))
    return r.select("entity_key", F.size("memberships").cast("long").alias("members"), "category", F.col("final_rank").cast("long").alias("final_rank"))


QUERIES = {f.__name__: f for f in (
    entity_names, repair_legal_form, english_only, name_overrides, match_cascade, entity_components, table_columns, column_scores, html_to_text, intermediary_pages, member_pages, list_lines, staged_texts, feed_listing,
    sql_table_functions, workbook_roundtrip, hub_counts_page, pension_tables, release_sequel, newest_files, published_sheets,
    table_page_stop, alternative_addresses, link_choice, scanned_registers, catch_up_changes,
    bank_sections, payment_sections, walk_stops, page_names, hub_id_resolution, release_window, release_changes, feed_union_dedupe, unattributed, final_hits, run_totals, master_entries, streaming_status, registry_members,
)}

_NATION_PAGES = "select n_name as source_key, n_nationkey % 4 as kind, p as page_ix from nation, generate_series(1, 8) t(p)"
_CANON = registered._CANON

ORACLE = {
    "entity_names": f"""select id, case id % 8 when 1 then b || ' Limited' when 6 then b || ' (India) Ltd' else b || ' Ltd' end as primary_name, case id % 8 when 0 then 'Old' || b || ' Ltd' when 1 then 'New' || b || ' Limited' else '' end as aliases from ({VARIANTS}) where id % 8 < 3 or id % 8 = 6""",
    "repair_legal_form": f"select id, case id % 8 when 2 then b || ' Ltd merged with Zed Ltd' when 3 then b || ' LIMITED' else b || ' PRIVATE Ltd' end as repaired from ({VARIANTS}) where id % 8 in (2, 3, 5)",
    "english_only": f"select id, case id % 8 when 4 then b || ' Ltd' when 5 then b || ' Privat Ltd' when 7 then 'ab' else name end as latin, id % 8 <> 7 as english, id % 8 not in (4, 5, 7) as raw_english from ({VARIANTS})",
    "name_overrides": f"""select id, case when id % 2 = 0 and id % 3 < 2 then 'Standard Chartered Capital Limited (Formerly: ' || published || ')' else published end as name, case when id % 4 < 2 then cast(id as varchar) end as link_id from ({VARIANTS})""",
    "match_cascade": f"""select c_custkey as ord, upper({BASE}) || ' PVT LTD' || case when c_custkey % 6 = 3 then ' FORMERLY KNOWN AS OLD ' || upper({BASE}) || ' LTD' else '' end as master_key, cast(case c_custkey % 6 when 4 then 5 else c_custkey % 6 + 1 end as bigint) as tier from customer where c_custkey % 6 < 5""",
    "entity_components": f"""with r as (select *, id // 5 * 5 as f from ({CHAINS}))
        select id, name, case when f % 10 = 0 then 'CUSTOMAR' else 'CUSTOMER' end || lpad(cast(f as varchar), 9, '0') || 'LTD' as entity_key from r""",
    "table_columns": f"select nation, case when nation % 2 = 0 then w || ' Agency Ltd' else w || ' Ltd' end as name from ({SUPPLIERS})",
    "column_scores": f"""select nation, cast(col as bigint) as col, ['Sr', 'Name of the company', 'Holder', 'Code'][col + 1] as label, count(*) as filled, case when col > 1 then 1.0::double else 0.0::double end as text_share, case when col < 2 then 1.0::double else 0.0::double end as number_share,
        avg(case col when 0 then length(cast(n as varchar)) when 1 then length(cast(1000 + n as varchar)) when 2 then length(w) + 16 else length(w) end) as mean_length, cast(3 as bigint) as chosen from ({SUPPLIERS}), generate_series(0, 3) t(col) group by nation, col""",
    "html_to_text": r"""select s_suppkey, 'A ' || s_name || ' & Co. B C' as flat, 'A ' || s_name || ' & Co.' || chr(10) || 'B' || chr(9) || 'C' as lines, 'a' || chr(9) || 'b' || chr(10) || 'A ' || s_name || ' & Co.' || chr(10) || 'B' || chr(9) || 'C' as kept from supplier""",
    "intermediary_pages": f"select nation, w || ' Broking Ltd' as name from ({SUPPLIERS})",
    "member_pages": "select s_suppkey, s_name || ' AMC Ltd' as name from supplier",
    "list_lines": f"select nation, w || ' Pension Fund Limited' as name from ({SUPPLIERS}) where total >= 3 and n <= 40",
    "staged_texts": f"""select nation, 'csv,html,html,pdf,xlsx,text' as kinds, w || ', The "Best" Ltd' as csv_name, w || ' Ltd' as line from ({SUPPLIERS})""",
    "feed_listing": f"""select 'feed' as of, nation, 'RBI cancels ' || w || ' & Co' as title, 'x?prid=' || k as link, case when n % 3 > 0 then date '2024-02-01' + cast(n % 28 as int) end as day from ({SUPPLIERS})
        union all select 'listing', nation, 'RBI cancels ' || w || ' & Co', 'x.aspx?prid=' || k, case when n % 3 > 0 then date '2024-02-01' + cast(n % 28 as int) else date '2024-02-01' end from ({SUPPLIERS})""",
    "sql_table_functions": f"""select 'links' as of, page_id as id, cast(len(regexp_extract_all(html, '<a href="([^"]*)"', 1)) as bigint) as n, list_max(regexp_extract_all(html, '<a href="([^"]*)"', 1)) as last from pages where html like '%<a href="%'
        union all select 'entries', k, 2, w || ' Ltd' from ({SUPPLIERS}) union all select 'rows', k, 2, w from ({SUPPLIERS})""",
    "workbook_roundtrip": f"""select nation, date '2024-03-05' as day, false as failed, w || ' Ltd' as name, case when n % 2 = 0 then 'HFC' end as classification from ({SUPPLIERS}) where nation % 5 <> 4
        union all select distinct nation, cast(null as date), true, null, null from ({SUPPLIERS}) where nation % 5 = 4""",
    "hub_counts_page": f"select nation, cast(k as varchar) as intm_id, w as label, cast(n * 7 as int) as expected_count from ({SUPPLIERS}) where n % 4 <> 0",
    "pension_tables": f"select nation, w || ' Pension Fund Limited' as name from ({SUPPLIERS}) union all select nation, 'New' || w || ' Pension Management Ltd' from ({SUPPLIERS})",
    "release_sequel": f"select nation, w || ' Leasing Limited' as name from ({SUPPLIERS}) where total >= 2",
    "newest_files": """with f as (select event_type as source_key, 'in/' || event_type || '/' || (event_id % 50) || '-' || event_id || '.html' as path, ts, event_id from events),
        b as (select source_key, arg_max(path, (ts, path)) as path, arg_max(event_id, (ts, path)) as id from f group by source_key) select source_key, path, cast(id % 50 as bigint) as url_ix, cast(id as bigint) as page_ix from b""",
    "table_page_stop": """select n_name as source_key, p as page_ix, cast(5 as bigint) as n_new from nation, generate_series(1, 8) t(p) where n_nationkey % 2 = 1 or p < 2 + n_nationkey % 5""",
    "alternative_addresses": f"""select 's' || nation as source_key, w || case nation % 3 when 0 then ' Three' else ' One' end as name from ({SUPPLIERS}) union all select 's' || nation, w || ' Two' from ({SUPPLIERS}) where nation % 3 = 2""",
    "link_choice": "select 's' || s_suppkey as source_key, 'https://r.in/a/' || case s_suppkey % 3 when 0 then 'f/' || s_suppkey || '.PDF' else 'get?id=' || s_suppkey end as url from supplier where s_suppkey % 3 < 2",
    "scanned_registers": f"""with s as (select * from ({SUPPLIERS}) where total >= 2),
        n as (select 'irdai_life' as k, w || ' Life Ltd' as name from s where nation = 0 union all select 'nhb_hfc', w || ' Housing Ltd' from s where nation = 1 union all select 'rbi_bank_lab', w || ' Local Area Bank Ltd' from s where nation = 2
          union all select 'rbi_bank_foreign', w || ' Bank PLC' from s where nation = 2 union all select 'rbi_bank_state_coop', w || ' State Co-op Bank Ltd.' from s where nation = 2 union all select 'rbi_pss_operating', w || ' Wallet Pvt Ltd' from s where nation = 3 union all select distinct 'rbi_pss_revoked', 'Foo Ltd' from s where nation = 3
          union all select distinct 'amfi_amc', 'Nation 4 AMC' from s where nation = 4 union all select 'sebi_credit_rating', w || ' Life Ltd' from s where nation = 5 union all select 'pfrda_pension_fund', w || ' Pension Fund Limited' from s where nation = 6),
        c as (select unnest([{", ".join(f"{{k: '{r['source_key']}', t: '{r['type']}', p: '{r['page']}'}}" for r in catalog.CATALOG)}], recursive := true)),
        f as (select distinct case nation when 0 then 'irdai_life' when 1 then 'nhb_hfc' when 2 then 'rbi_banks' when 3 then 'rbi_pss' when 4 then 'amfi_amc' when 5 then 'sebi_credit_rating' when 6 then 'pfrda_pension_fund' end as p from s)
        select c.k as source_key, case when t = 'manual' then 'skipped_manual' when f.p is null then 'error' else 'ok' end as run, case when t <> 'manual' and f.p is null then 'no staged file' end as error, name from c left join f on f.p = c.p left join n on n.k = c.k""",
    "catch_up_changes": f"""with s as (select *, date '2024-02-01' + cast(n * 7 % 28 as int) as day from ({SUPPLIERS}))
        select w || ' Finance Limited' as entity_name, 'Cancelled' as action, day as effective_date, 'https://r.in/x.aspx?prid=' || k as pr_link, cast(case when nation < 3 then 1 end as int) as expected_count from s where (nation < 3 and day >= date '2024-02-10') or (nation between 3 and 4 and day > date '2024-02-10')""",
    "bank_sections": f"""select nation, 'foreign' as section, w || ' Bank PLC' as name from ({SUPPLIERS}) union all select nation, 'lab', w || ' Local Area Bank Ltd' from ({SUPPLIERS}) union all select nation, 'rrb', w || ' Gramin Bank' from ({SUPPLIERS})
        union all select nation, case when w like '%AAAAB%' then 'non_scheduled' else 'scheduled' end, w || ' State Co-op Bank Ltd.' from ({SUPPLIERS}) union all select distinct nation, 'unmatched', 'nowhere' from ({SUPPLIERS})""",
    "payment_sections": f"select nation, n - 1 as pos, w || case when n = 1 then ' Software Private Limited (formerly ' || w || ' Soft)' else ' Software Pvt Ltd' end as name from ({SUPPLIERS}) where total >= 2",
    "walk_stops": f"""select source_key, page_ix, case when kind = 2 and page_ix > 2 then 0 else 10 end as n_new, case when kind = 0 and page_ix = 3 then 'target' when kind = 1 and page_ix = 3 then 'repeated page' when kind = 2 and page_ix = 5 then 'no new names' end as reason
        from ({_NATION_PAGES}) where kind = 3 or (kind = 0 and page_ix <= 3) or (kind = 1 and page_ix <= 3) or (kind = 2 and page_ix <= 5)""",
    "page_names": f"""select 's' || nation as source_key, upper(w) || 'LTD' as key, case when n % 2 = 0 then upper(w) || ' LTD' else w || ' Limited' end as name from ({SUPPLIERS}) union all select 's' || nation, upper(w) || 'TWOLTD', w || ' Two Ltd' from ({SUPPLIERS})""",
    "hub_id_resolution": """with n as (select cast(n_nationkey as int) as k, n_name from nation)
        select 's' || k as source_key, case when k % 4 = 1 then cast(k + 100 as varchar) else cast(k as varchar) end as intm_id, case k % 4 when 1 then n_name || ' Fund' when 2 then 'Other' else n_name || ' Funds' end as hub_label, case when k % 4 = 1 then k * 5 else k * 3 end as expected_count,
        case when k % 4 = 1 then cast(k as varchar) end as changed_from, case k % 4 when 1 then 'id replaced' when 2 then 'no hub row matches' end as warning from n""",
    "release_window": """with r as (select event_id as ord, case event_type when 'error' then 'Cancelled' when 'signup' then 'Restored' end as action, case when event_id % 7 = 0 then null else date '2024-01-01' + cast(event_id % 60 as int) end as effective_date from events where event_type in ('error', 'signup'))
        select 'archive' as of, * from r where effective_date is null or effective_date >= date '2024-01-20' union all select 'feed', * from r where effective_date > date '2024-01-20'""",
    "release_changes": f"""select 'l' || nation as pr_link, w || ' Finance Limited' as entity_name, cast(total + case when nation % 4 = 1 then 1 else 0 end as int) as expected_count, case when nation % 4 = 1 then 'title states ' || (total + 1) || ', ' || total || ' extracted' end as note, nation % 4 = 1 as kept_raw
        from ({SUPPLIERS}) where total >= 2 and nation % 4 < 3 union all select 'l' || nation, null, cast(any_value(total) as int), 'names not extracted', true from ({SUPPLIERS}) where total >= 2 and nation % 4 = 3 group by nation""",
    "feed_union_dedupe": f"select ord, case when ord % 7 = 0 then null else entity_name end as entity_name, pr_link || '/' || ord as pr_link from ({DELTAS})",
    "unattributed": f"select action, effective_date, pr_title, pr_link || '/' || ord as pr_link, 'names not extracted automatically' as flag from ({DELTAS}) where ord % 7 = 0 and ord % 3 < 2",
    "final_hits": f"select c_custkey as ord, {BASE} || ' Ltd' as name, case when c_custkey % 2 = 0 then 'rbi_nbfc' else 'other' end as source_key, case when c_custkey % 6 = 0 then 'Cancelled' else 'Active' end as status from customer",
    "run_totals": """select count(*) as sources, cast(count_if(c_custkey % 5 = 0) as bigint) as ok, cast(count_if(c_custkey % 5 = 1) as bigint) as failed, cast(count_if(c_custkey % 5 = 2) as bigint) as empty, cast(count_if(c_custkey % 5 = 3) as bigint) as stale, cast(count_if(c_custkey % 5 = 4) as bigint) as manual, cast(sum(c_nationkey) as bigint) as names from customer""",
    "master_entries": f"select {BASE} || ' Ltd' as name, 'Active' as status from customer where c_custkey % 3 = 0",
    "registry_members": f"select {_CANON.replace('upper(name)', 'upper(p)', 1)} as entity_key, 1::bigint as members, category, cast({registered._RANK} as bigint) as final_rank from (select *, regexp_replace(name, ' \\(Formerly.*', '') as p from ({registered.RAW}))",
}
ORACLE["streaming_status"] = registers.ORACLE["latest_status"]
ORACLE["published_sheets"] = f"select source_key, name, category, status from ({registers.ORACLE['membership_rows']})"
