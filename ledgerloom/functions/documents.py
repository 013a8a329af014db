"""Arrow-batched functions over documents; a document's parse is the only work that leaves the JVM."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from ..sources import markup
from . import cells, clean

LISTS = "array<string>"


def _per_document(schema: str, parse, c) -> Column:
    """parse(document) for every document, in Arrow batches. The function is made at call time, as its type needs a session."""

    if schema.startswith("struct"):

        @pandas_udf(schema)
        def rows(documents: pd.Series) -> pd.DataFrame:
            return pd.DataFrame([parse(d) for d in documents])

        return rows(c)

    @pandas_udf(schema)
    def run(documents: pd.Series) -> pd.Series:
        return documents.map(parse)

    return run(c)


BOOK = "struct<names:array<struct<name:string,classification:string>>,title:string,error:string>"


def book_names(content: bytes) -> dict:
    try:
        names, title = markup.workbook_names(content)
    except Exception as e:  # a damaged upload must not stop the other sources
        return {"names": [], "title": None, "error": f"{type(e).__name__}: {e}"}
    return {"names": [{"name": n, "classification": c} for n, c in names], "title": title, "error": None}


def _fields(*names: str):
    return lambda rows: [dict(zip(names, r)) for r in rows]


def _tables_and_lines(html: str | None) -> dict:
    page = markup.Page(html)
    return {"tables": [[r for r in t if any(r)] for t in page.tables], "lines": page.lines}


def html_tables(html) -> Column:
    """Rows of every table with two rows or more."""
    row = _fields("table_ix", "row_ix", "cells")
    return _per_document("array<struct<table_ix:int,row_ix:int,cells:array<string>>>", lambda h: row((t, i, r) for t, rows in enumerate(markup.tables(h)) for i, r in enumerate(rows)), html)


def html_links(html) -> Column:
    """Links with their text and the text of their row."""
    row = _fields("href", "text", "around")
    return _per_document("array<struct<href:string,text:string,around:string>>", lambda h: row(markup.Page(h).links), html)


def html_text(html) -> Column:
    return _per_document("string", lambda h: markup.Page(h).text, html)


def html_lines(html) -> Column:
    """Text with a line per block and a tab per cell."""
    return _per_document("string", lambda h: markup.Page(h).rendered, html)


def hub_counts(html) -> Column:
    row = _fields("intm_id", "label", "expected_count")
    return _per_document("array<struct<intm_id:string,label:string,expected_count:int>>", lambda h: row(markup.hub_counts(h)), html)


def intermediary_names(html) -> Column:
    """Names of a register's page: under a name header, else between labels."""
    page = _per_document("struct<tables:array<array<array<string>>>,lines:string>", _tables_and_lines, html)
    return cells.let(page, lambda p: cells.intermediary_names(p["tables"], p["lines"]))


def html_cells(html) -> Column:
    """All tables as arrays of their rows that hold anything."""
    return _per_document("array<array<array<string>>>", lambda h: [[r for r in t if any(r)] for t in markup.Page(h).tables], html)


def release_table_names(html) -> Column:
    """Names in the tables of a release, each once; without a table that fits: none."""
    return cells.release_names(html_cells(html))


def table_names(html, header_pattern: str | None = None, split: bool = False, keyword: str | None = None) -> Column:
    """Names of a page's tables, by names_of."""
    return names_of(html_cells(html), header_pattern, split, keyword)


def names_of(tables, header_pattern: str | None = None, split: bool = False, keyword: str | None = None) -> Column:
    """Names of tables (arrays of rows): Devanagari stripped, 180 characters at most, each once.

    `header_pattern`: only tables whose first rows match, where any does. `split`: two companies in one cell become two. `keyword`: only
    names that match.
    """
    names = F.array_distinct(F.filter(F.transform(cells.page_names(tables, header_pattern), clean.strip_devanagari), lambda n: (n != "") & (F.length(n) <= markup.WIDE)))
    names = split_companies(names) if split else names
    return F.filter(names, lambda n: n.rlike(f"(?i){keyword}")) if keyword else names


def split_companies(names) -> Column:
    """Two companies in one cell become two, at the legal form of the first."""
    parts = F.flatten(F.transform(names, lambda n: F.split(n, r"(?<=\b(?:Limited|Ltd\.|Ltd))\s+(?=[A-Z][A-Za-z])")))
    return F.array_distinct(F.filter(F.transform(parts, lambda n: F.trim(n)), lambda n: n != ""))


def numbered_entries(text, restart: bool = False, reject: str | None = None) -> Column:
    return _per_document(LISTS, lambda t: markup.numbered_entries(t, restart, reject), text)


def plain_entries(text) -> Column:
    return _per_document(LISTS, markup.plain_entries, text)


def list_line_names(text, heading: str, keyword: str, stop: str | None = None) -> Column:
    return _per_document(LISTS, lambda t: markup.list_line_names(t, heading, keyword, stop), text)


def workbook_rows(content) -> Column:
    row = _fields("sheet", "row_ix", "cells")
    return _per_document("array<struct<sheet:string,row_ix:int,cells:array<string>>>", lambda c: row(markup.workbook(c)), content)


def workbook_names(content) -> Column:
    """struct(names: array of (name, classification), title, error). What is no readable workbook gives no names and an error."""
    return _per_document(BOOK, book_names, content)


def prose_names(text: Column) -> Column:
    """Names in a numbered list of running text, each cut after its legal form."""
    cut = r"\s{2,}|(?<=Limited|Ltd|Ltd\.|Pvt|Pvt\.|LLP|LLC|Inc|Inc\.|Corp|Corp\.|Corporation|Co\.|PLC|GmbH|N\.V\.),?\s+(?=[A-Z])"
    one = lambda p: F.regexp_replace(F.trim(F.get(F.split(p, cut), F.lit(0))), "[,;:]$", "")
    return F.array_distinct(F.filter(F.transform(_per_document(LISTS, markup.prose_entries, text), one), clean.looks_like_entity))


def with_release_names(releases: DataFrame) -> DataFrame:
    """releases (html, expected_count, ...) with `names` a press release covers: its tables, else its prose; a table short of the
    title's count is topped up from prose with names that end in a legal form."""
    key = lambda n: F.regexp_replace(F.upper(n), "[^A-Z0-9]", "")
    r = releases.withColumn("_table", release_table_names("html")).withColumn("_text", html_text("html"))
    r = r.withColumn("_table", F.filter("_table", clean.acceptable_company)).withColumn("_prose", prose_names(F.col("_text"))).withColumn("_keys", F.transform("_table", key))
    extra = cells.let(F.col("_keys"), lambda known: F.filter("_prose", lambda n: n.rlike(clean.LEGAL_END) & clean.acceptable_company(n) & ~F.array_contains(known, key(n))))
    short = F.coalesce((F.col("expected_count") > 0) & (F.size("_table") < F.col("expected_count")), F.lit(False))
    names = F.when(F.size("_table") == 0, F.col("_prose")).when(short, F.concat("_table", extra)).otherwise(F.col("_table"))
    return r.withColumn("names", names).drop("_table", "_text", "_prose", "_keys")
