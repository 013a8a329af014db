"""Readers of staged files: their kind is told from their content, and each kind has its reader. Sinks for the report relations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import cells, clean, documents, names
from .versions import Versions


def kind_of(content: Column, path: Column) -> Column:
    """html, xlsx, xls, text, csv, pdf or unknown, by the leading 1024 bytes, then by the path's ending."""
    head = F.decode(F.substring(content, 1, 1024), "ISO-8859-1")
    low = F.lower(F.regexp_replace(head, r"^[\sï»¿]+", ""))
    return (
        F.when(F.hex(F.substring(content, 1, 4)) == "504B0304", "xlsx")
        .when(F.hex(F.substring(content, 1, 4)) == "D0CF11E0", "xls")
        .when(low.rlike(r"^<(?:!doctype|html|table|head|body|\?xml|div|meta)") | low.contains("<table"), "html")
        .when(F.lower(path).endswith(".txt"), "text")
        .when(low.startswith("%pdf") | F.lower(path).endswith(".pdf"), "pdf")
        .when((head != "") & ~F.substring(head, 1, 200).rlike(r"[^\x09\x0A\x0D\x20-\x7E]"), "csv")
        .otherwise("unknown")
    )


def read_staged(spark: SparkSession, folder: str) -> DataFrame:
    """(source_key, path, modified, kind, content) of files under folder/<source_key>/."""
    f = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    return f.select(F.element_at(F.split("path", "/"), -2).alias("source_key"), "path", F.col("modificationTime").alias("modified"), kind_of(F.col("content"), F.col("path")).alias("kind"), "content")


def newest(files: DataFrame) -> DataFrame:
    """Of each source its newest file. Paths compete, contents follow by a join, so the aggregate carries no bytes."""
    best = files.groupBy("source_key").agg(F.max_by("path", F.struct("modified", "path")).alias("path"))
    return files.join(best, ["source_key", "path"], "left_semi")


def csv_names(text: Column) -> Column:
    """Values of the first header cell that is, or else holds, 'name'; quoted fields may hold commas and doubled quotes."""
    cell = lambda x: F.replace(F.regexp_replace(F.trim(F.regexp_replace(x, "^,", "")), '^"(.*)"$', "$1"), F.lit('""'), F.lit('"'))
    fields = lambda line: F.transform(F.regexp_extract_all(F.concat(F.lit(","), line), F.lit(r',(?:\s*"(?:[^"]|"")*"\s*|[^,]*)'), F.lit(0)), cell)

    def column(head: Column) -> Column:
        at, exact = F.array_position(F.transform(head, lambda h: h.contains("name")), True), F.array_position(head, F.lit("name"))
        return F.when((exact > 0) & (exact < at), exact).otherwise(at).cast("int")

    def values(lines: Column, col: Column) -> Column:
        v = F.transform(F.slice(lines, F.lit(2), F.greatest(F.size(lines) - 1, F.lit(0))), lambda x: F.trim(F.coalesce(F.get(fields(x), col - 1), F.lit(""))))
        return F.when(col > 0, F.array_distinct(F.filter(v, lambda n: n != ""))).otherwise(F.array().cast("array<string>"))

    # lines and column are worked out once a text, not once a line
    one = lambda lines: cells.let(column(F.transform(fields(F.get(lines, F.lit(0))), F.lower)), lambda col: values(lines, col))
    return cells.let(F.filter(F.split(text, r"\r?\n"), lambda x: x != ""), one)


def text_line_names(text: Column) -> Column:
    """Lines of a document's text that may be names: over three characters, no page numbers, serial labels or plain digits."""
    lines = F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), clean.squash)
    return F.filter(lines, lambda x: (F.length(x) > 3) & ~x.rlike(r"(?i)^page\s*\d+") & ~x.rlike(r"(?i)^(?:s\.?\s*no|sl\.?\s*no|sr\.?\s*no|name of the)") & ~x.rlike(r"^\d+$"))


def staged_names(files: DataFrame) -> DataFrame:
    """(source_key, path, pos, name, classification) of staged files, by their kind. PDF files are staged as text; other kinds give no names.

    Files that come with their parse (doc of pages, book of workbooks) are not parsed again.
    """
    text = F.decode("content", "UTF-8")
    book = F.col("book.names") if "book" in files.columns else documents.workbook_names(F.col("content"))["names"]
    page = documents.names_of(F.transform("doc.tables", lambda t: F.transform(t, lambda r: r["cells"]))) if "doc" in files.columns else documents.table_names(text)
    plain = lambda c: F.transform(c, lambda n: F.struct(n.alias("name"), F.lit(None).cast("string").alias("classification")))
    only = lambda kind, c: files.filter(F.col("kind") == kind).select("source_key", "path", F.posexplode(c).alias("pos", "x"))
    u = only("xlsx", book).union(only("html", plain(page))).union(only("csv", plain(csv_names(text)))).union(only("text", plain(F.array_distinct(text_line_names(text)))))
    return u.select("source_key", "path", "pos", "x.name", "x.classification")


def linked_file(pages: DataFrame, pattern: str = r"\.(pdf|xlsx?|csv)$") -> DataFrame:
    """(source_key, url) of the first link of each page (source_key, base, html) whose address or text matches."""
    links = pages.select("source_key", "base", F.posexplode(documents.html_links(F.col("html"))).alias("pos", "l"))
    links = links.select("source_key", "pos", clean.absolute_url(F.col("l.href"), F.col("base")).alias("url"), F.col("l.text").alias("text"))
    fits = links.filter(F.col("url").isNotNull() & (F.col("url").rlike(f"(?i){pattern}") | F.col("text").rlike(f"(?i){pattern}")))
    return fits.groupBy("source_key").agg(F.min_by("url", "pos").alias("url"))


def feed_items(feeds: DataFrame) -> DataFrame:
    """Items of RSS texts (feed, xml): pos, title, description, link, pub_date. Undated items have a null date."""
    item = F.posexplode(F.regexp_extract_all("xml", F.lit(r"(?s)<item\b[^>]*>(.*?)</item>"), F.lit(1))).alias("pos", "item")

    def field(name: str) -> Column:
        raw = F.regexp_extract("item", rf"(?s)<{name}\b[^>]*>\s*(?:<!\[CDATA\[)?(.*?)(?:\]\]>)?\s*</{name}>", 1)
        for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&amp;", "&")):
            raw = F.replace(raw, F.lit(entity), F.lit(char))
        return F.trim(raw)

    day = F.regexp_extract(field("pubDate"), r"(\d{1,2} [A-Za-z]{3} \d{4})", 1)
    return feeds.select("feed", item).select("feed", "pos", field("title").alias("title"), field("description").alias("description"), field("link").alias("link"), F.try_to_timestamp(day, F.lit("d MMM yyyy")).cast("date").alias("pub_date"))


def listing_entries(pages: DataFrame) -> DataFrame:
    """Release links of listing pages (month, base, html): title of eight characters or more, absolute link, date near it or the month's first."""
    x = pages.select("month", "base", F.posexplode(documents.html_links(F.col("html"))).alias("pos", "l")).filter(F.col("l.href").contains("prid=") & (F.length("l.text") >= 8))
    stated = names.long_date(F.regexp_extract("l.around", r"(?i)Date\s*:\s*([A-Za-z]+\s+\d{1,2},?\s+\d{4})", 1))
    return x.select("month", "pos", F.col("l.text").alias("title"), clean.absolute_url(F.col("l.href"), F.col("base")).alias("link"), stated.alias("stated_date"), F.coalesce(stated, "month").alias("effective_date"))


def write_sheets(sheets: dict[str, DataFrame], folder: str, format: str = "parquet") -> None:
    """One folder per report relation; formats: parquet, csv (with header), json. Nested columns need parquet or json."""
    for name, df in sheets.items():
        w = df.write.mode("overwrite")
        (w.option("header", True).csv if format == "csv" else getattr(w, format))(f"{folder}/{name}")


def write_raw(files: DataFrame, folder: str) -> None:
    """Downloads as they came, beside the reports: (source_key, path, modified, kind, content)."""
    files.write.mode("overwrite").partitionBy("source_key").parquet(folder)


RAW = "path string, modified timestamp, kind string, content binary, source_key string, month string"


def stage(files: DataFrame, folder: str) -> None:
    """Adds files (source_key, month as yyyy-MM, path, modified, kind, content) to the raw store, partitioned by source and month."""
    files.write.mode("append").partitionBy("source_key", "month").parquet(folder)


def read_raw(spark: SparkSession, folder: str) -> DataFrame:
    """The raw store. A filter on source_key or month leaves other partitions unread, and contents that are not asked for stay on disk."""
    return spark.read.schema(RAW).parquet(folder)


def has_raw(spark: SparkSession, folder: str, source_key: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/source_key={source_key}")
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def previous_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of the last published membership relation, for stale fallback: of each source those of its last good run, where runs are versions."""
    v = Versions(spark, folder)
    last = spark.read.parquet(f"{folder}/combine_list") if v.latest() is None else v.read("combine_list")
    return last.select("source_key", "name", "category", "status")
