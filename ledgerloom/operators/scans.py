"""Names of all registers out of staged files, each register by its type.

Files lie in a folder per page: a register's own, or one that several registers share. A file called <n>-<m>.<ending> is page m of the
n-th address of its register; the first address that gives names counts. Other files are downloads, of which the newest counts.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import cells, clean, documents
from ..sources import catalog, parsed, staged
from . import ingest, paging, sections
from .components import durable

NAMES = "source_key string, ord long, name string, classification string"
NOTES = "source_key string, error string, note string, title string"
SPENT = "source_key string, files long, bytes long, parsed_files long, ms double"


class Scanned(NamedTuple):
    names: DataFrame  # source_key, ord, name, classification
    runs: DataFrame  # source_key, url, status, expected_count, error, note, title, files, bytes, parsed_files, ms


def _text() -> Column:
    return F.decode("content", "UTF-8")


def _parsed(pages: DataFrame) -> DataFrame:
    """Pages with their parse as `doc`: as it came out of the store, else made of their content now."""
    return pages if "doc" in pages.columns else pages.withColumn("doc", parsed.PAGE.on(F.col("content"))["out"])


def _tables() -> Column:
    return F.transform("doc.tables", lambda t: F.transform(t, lambda r: r["cells"]))


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def numbered(files: DataFrame) -> DataFrame:
    """files with url_ix and page_ix of their name; null for downloads."""
    part = lambda i: F.regexp_extract("path", r"(\d+)-(\d+)\.[^./]*$", i).try_cast("int")
    return files.withColumn("url_ix", part(1)).withColumn("page_ix", part(2))


def first_address(pages: DataFrame) -> DataFrame:
    """Of each source the pages (source_key, url_ix, names) of the first address that gave any name."""
    best = pages.filter(F.size("names") > 0).groupBy("source_key").agg(F.min("url_ix").alias("url_ix"))
    return pages.join(best, ["source_key", "url_ix"], "left_semi")


def _spread(pages: DataFrame) -> DataFrame:
    """Pages (source_key, page_ix, names) as rows in order."""
    n = pages.select("source_key", "page_ix", F.posexplode("names").alias("pos", "name"))
    return n.select("source_key", (F.col("page_ix").cast("long") * (1 << 32) + F.col("pos")).alias("ord"), "name", F.lit(None).cast("string").alias("classification"))


def table_scan(pages: DataFrame) -> DataFrame:
    """Names of table pages (source_key, url_ix, page_ix, content or doc, paginate, split): paged lists up to the page that adds none.

    Registers that are split read the fund tables alone, cut cells that hold two companies and keep names with the keyword.
    """
    rows = _parsed(pages).select("source_key", "url_ix", "page_ix", "paginate", "split", _tables().alias("tables"))
    read = lambda part, names: part.select("source_key", "url_ix", "page_ix", "paginate", names.alias("names"))
    p = read(rows.filter("not split"), documents.names_of(F.col("tables")))
    p = p.union(read(rows.filter("split"), documents.names_of(F.col("tables"), catalog.PENSION["tables"], True, catalog.PENSION["keyword"])))
    p = durable(p)  # the walk and the choice of an address read it again and again
    by_address = F.concat_ws("/", "source_key", F.col("url_ix").cast("string"))
    walked = paging.table_pages(p.filter("paginate").withColumn("own", F.col("source_key")).withColumn("source_key", by_address).withColumn("page_ix", F.col("page_ix") + 1))
    walked = walked.select(F.col("own").alias("source_key"), "url_ix", "page_ix", "names")
    return _spread(first_address(p.filter("not paginate and page_ix = 0").select("source_key", "url_ix", "page_ix", "names").union(walked)))


def rendered_scan(pages: DataFrame, texts: DataFrame) -> DataFrame:
    """Names of rendered pages: their tables, else names among their lines, else those of the linked file, staged as text."""
    tables = durable(table_scan(pages))  # read four times below
    rest = _parsed(pages).join(tables.select("source_key").distinct(), "source_key", "left_anti").filter("split")
    lines = documents.list_line_names(F.col("doc.rendered"), catalog.PENSION["heading"], catalog.PENSION["keyword"], catalog.PENSION["stop"])
    lines = _spread(first_address(rest.select("source_key", "url_ix", "page_ix", lines.alias("names"))))
    linked = text_scan(texts).join(tables.select("source_key").union(lines.select("source_key")).distinct(), "source_key", "left_anti")
    return _union([tables, lines, linked])


def text_scan(texts: DataFrame) -> DataFrame:
    """Lines of the newest text of each source that may be names."""
    t = staged.newest(texts).select("source_key", F.lit(0).alias("page_ix"), F.array_distinct(staged.text_line_names(_text())).alias("names"))
    return _spread(t)


def workbook_scan(files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Names and notes of the newest download of each source. A page in place of a workbook is a refusal."""
    new = staged.newest(files)
    told = new if "book" in new.columns else new.withColumn("book", documents.workbook_names(F.col("content")))
    book = durable(told.filter("kind = 'xlsx'").select("source_key", "book.*"))
    names = book.select("source_key", F.posexplode("names").alias("pos", "x")).select("source_key", F.col("pos").cast("long").alias("ord"), "x.name", "x.classification")
    blank = F.lit(None).cast("string")
    refused = new.filter("kind <> 'xlsx'").select("source_key", F.concat(F.lit("CAPTCHA_OR_BLOCK: no workbook but "), "kind").alias("error"), blank.alias("note"), blank.alias("title"))
    return names, book.select("source_key", "error", blank.alias("note"), "title").unionByName(refused)


def bank_scan(pages: DataFrame, sources: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Names and notes of the registers on shared pages (doc_id, text), by section. A page is parsed once, whatever registers it feeds."""
    blank, found = F.lit(None).cast("string"), []
    of = lambda kind, good=lambda section: True: {r["section"]: r["source_key"] for r in catalog.CATALOG if r["type"] == kind and good(r["section"])}
    page = lambda kind: pages.filter(F.col("doc_id") == catalog.PAGES[kind])
    key = lambda by_section: F.create_map(*[F.lit(x) for pair in by_section.items() for x in pair])[F.col("section")].alias("source_key")
    plain = of("rbi_banks_custom", lambda x: x in sections.BANKS and x != "foreign")
    found.append(sections.plain_lists(page("rbi_banks_custom"), list(plain)).select(key(plain), "names", blank.alias("note")))
    for section, source_key in of("rbi_banks_custom", lambda x: x not in plain).items():
        found.append(sections.bank_section(page("rbi_banks_custom"), section).select(F.lit(source_key).alias("source_key"), "names", "note"))
    coop = sections.state_coop_banks(page("rbi_state_coop_custom"), catalog.NON_SCHEDULED)
    note = F.when(F.size("unmatched") > 0, F.concat(F.lit("keywords without a bank: "), F.array_join("unmatched", ", ")))
    lists = F.array(*[F.struct(F.lit(k).alias("source_key"), F.col(x).alias("names")) for x, k in of("rbi_state_coop_custom").items()])
    found.append(coop.select(F.inline(lists), note.alias("note")))
    pay = of("rbi_pss_custom")
    e = sections.payment_lists(page("rbi_pss_custom"), list(pay)).groupBy("doc_id", "section")
    found.append(e.agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "name"))), lambda x: x["name"]).alias("names")).select(key(pay), "names", blank.alias("note")))
    got = durable(_union(found).withColumn("page_ix", F.lit(0)).join(F.broadcast(sources.select("source_key")), "source_key", "left_semi"))
    return _spread(got), got.filter("note is not null").select("source_key", blank.alias("error"), "note", blank.alias("title"))


def member_scan(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The management company of each member page, and a note on pages that name none."""
    p = _parsed(pages).select("source_key", "path", clean.manager_name(F.col("doc.rendered")).alias("name"))
    names = p.filter("name is not null").groupBy("source_key", "name").agg(F.min("path").alias("path"))
    names = names.select("source_key", F.xxhash64("path").alias("ord"), "name", F.lit(None).cast("string").alias("classification"))
    bad = F.array_sort(F.collect_list(F.when(F.col("name").isNull(), F.regexp_extract("path", "([^/]*)$", 1))))
    n = p.groupBy("source_key").agg(F.count("name").alias("n"), bad.alias("bad"))
    blank = F.lit(None).cast("string")
    note = F.concat(F.format_string("%d of %d pages name a company", "n", F.col("n") + F.size("bad")), F.when(F.size("bad") > 0, F.concat(F.lit("; not: "), clean.first_few(F.col("bad"), 8))).otherwise(""))
    return names, n.select("source_key", blank.alias("error"), note.alias("note"), blank.alias("title"))


def intermediary_scan(files: DataFrame, targets: DataFrame, top_up: bool = False) -> DataFrame:
    """Names of the newest download of each source; where there is none (or with `top_up` beside it), of its pages up to the walk's end.
    targets: (source_key, target)."""
    pages = files.filter("page_ix is not null and kind = 'html'")
    p = _parsed(pages).select("source_key", (F.col("page_ix") + 1).alias("page_ix"), cells.intermediary_names(_tables(), F.col("doc.lines")).alias("names")).join(F.broadcast(targets), "source_key", "left")
    loads = staged.staged_names(staged.newest(files.filter("page_ix is null"))).select("source_key", "name")
    n = paging.topped_up(loads, paging.walked_pages(p), top_up)
    return n.select("source_key", F.xxhash64("key").alias("ord"), "name", F.lit(None).cast("string").alias("classification"))


def read_all(files: DataFrame, store: str) -> tuple[DataFrame, DataFrame]:
    """files with what their parsers make of them (doc of pages, book of workbooks), out of the store or parsed now; and the effort per folder.

    Pages lose their bytes, as their parse goes on alone.
    """
    pages, books, texts = (parsed.parse(files.filter(F.col("kind") == kind), store, parser) for kind, parser in (("html", parsed.PAGE), ("xlsx", parsed.BOOK), ("text", parsed.TEXT)))
    out = files.join(pages.files.select("path", F.col("out").alias("doc")), "path", "left").join(books.files.select("path", F.col("out").alias("book")), "path", "left")
    spent = _union([parsed.effort(p.files, files) for p in (pages, books, texts)])
    spent = spent.groupBy("source_key").agg(*[F.sum(c).alias(c) for c in ("files", "bytes", "parsed_files", "ms")])
    bare = F.when((F.col("kind") != "html") | (F.col("source_key") == "sebi_hub"), F.col("content"))
    return durable(out.withColumn("content", bare)), spent  # every register type reads from here


def parsed_now(files: DataFrame) -> DataFrame:
    """files with the parse of each page as `doc`, made in one pass for all registers that read it. Pages lose their bytes, as in read_all."""
    page = F.col("kind") == "html"
    doc = F.when(page, parsed.PAGE.on(F.when(page, F.col("content")))["out"])
    return durable(files.withColumn("doc", doc).withColumn("content", F.when(~page, F.col("content"))))


def scan(files: DataFrame, sources: DataFrame, top_up: bool = False, store: str | None = None) -> Scanned:
    """All registers of `sources` (catalog.sources) from staged files (staged.read_staged). Registers without a file have failed.

    `top_up`: pages add what an intermediary's download lacks. `store`: folder of parse results, which spares contents that an earlier run
    has parsed; with it the runs state files, bytes and the milliseconds of new parses per source (sources that share a page each state that
    page's), without it these are null.
    """
    if store:
        read, spent = read_all(files, store)
        spent = durable(spent)
    else:
        folders = sources.select(F.col("page").alias("source_key")).distinct()
        read, spent = parsed_now(files.join(F.broadcast(folders), "source_key", "left_semi")), files.sparkSession.createDataFrame([], SPENT)
    f = numbered(read).withColumnRenamed("source_key", "page")
    own = f.join(F.broadcast(sources.select("source_key", "type", "page", "paginate", "split")), "page")
    of = lambda *types: own.filter(F.col("type").isin(*types)).drop("page", "type")
    html = lambda d: d.filter("kind = 'html'").withColumn("url_ix", F.coalesce("url_ix", F.lit(0))).withColumn("page_ix", F.coalesce("page_ix", F.lit(0)))
    books, book_notes = workbook_scan(of("xlsx_direct"))
    shared = f.filter(F.col("page").isin(*set(catalog.PAGES.values()))).withColumnRenamed("page", "source_key")
    shared = shared.filter("kind in ('html', 'text')").withColumn("kind", F.when(F.col("kind") == "text", "a text").otherwise("html"))
    best = shared.groupBy("source_key").agg(F.min_by("path", F.struct("kind", -F.unix_timestamp("modified"))).alias("path"))
    shared = shared.join(best, ["source_key", "path"], "left_semi")  # a row per shared page
    pages = _parsed(shared.filter("kind = 'html'")).select("source_key", F.col("doc.rendered").alias("text")).union(shared.filter("kind <> 'html'").select("source_key", _text()))
    banks, bank_notes = bank_scan(durable(pages.select(F.col("source_key").alias("doc_id"), clean.structured_text(F.col("text")).alias("text")).coalesce(1)), sources)
    members, member_notes = member_scan(of("amfi_members").filter("kind = 'html'"))
    hub = files.filter("source_key = 'sebi_hub' and kind = 'html'").select(F.explode(documents.hub_counts(_text())).alias("h")).select("h.*")
    ids = durable(ingest.hub_ids(sources.filter("intm_id is not null").select("source_key", "intm_id", "label_hint"), hub))
    names = _union([
        table_scan(html(of("html_table"))), rendered_scan(html(of("aspx_dynamic")), of("aspx_dynamic").filter("kind = 'text'")), books, text_scan(of("pdf_link").filter("kind = 'text'")), banks, members,
        intermediary_scan(of("sebi_intermediary_custom"), ids.select("source_key", F.col("expected_count").alias("target")), top_up),
    ])
    names = names.groupBy("source_key", "name").agg(F.min("ord").alias("ord"), F.max("classification").alias("classification")).select("source_key", "ord", "name", "classification")
    blank = F.lit(None).cast("string")
    hub_notes = ids.select("source_key", blank.alias("error"), F.concat_ws("; ", F.concat(F.lit("hub label: "), "hub_label"), F.concat(F.lit("id used: "), "intm_id"), "warning").alias("note"), blank.alias("title"))
    notes = _union([book_notes, bank_notes, member_notes, hub_notes]).groupBy("source_key").agg(F.max("error").alias("error"), F.array_join(F.array_sort(F.collect_set("note")), "; ").alias("note"), F.max("title").alias("title"))
    seen = own.groupBy("source_key").agg(F.min("path").alias("url"))
    r = sources.select("source_key", "type", "page").join(spent.withColumnRenamed("source_key", "page"), "page", "left").join(seen, "source_key", "left").join(notes, "source_key", "left").join(ids.select("source_key", "expected_count"), "source_key", "left")
    known = ["html_table", "aspx_dynamic", "xlsx_direct", "pdf_link", "rbi_banks_custom", "rbi_state_coop_custom", "rbi_pss_custom", "sebi_intermediary_custom", "amfi_members"]
    error = F.when(F.col("type").isin(*known), F.coalesce("error", F.when(F.col("url").isNull(), "no staged file")))
    state = F.when(F.col("type") == "manual", "skipped_manual").when(~F.col("type").isin(*known), "unknown_type").when(error.isNotNull(), "error").otherwise("ok")
    return Scanned(names, r.select("source_key", "url", state.alias("status"), "expected_count", error.alias("error"), F.nullif("note", F.lit("")).alias("note"), "title", "files", "bytes", "parsed_files", "ms"))
