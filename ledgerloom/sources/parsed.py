"""Parse results that outlive a run: a document is parsed once per content and parser version.

folder/<parser>-v<version>/ holds (hash, bytes, ms, run, out) per parsed content, appended. What it holds is found by the hash of a file's bytes, so
an unchanged folder parses nothing, a copied page is parsed once, and a parser that changed takes a new version and starts anew.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterator
from typing import Any, NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from ..functions import documents
from ..operators.components import durable
from . import markup

#: Documents whose results a worker makes before it hands them on.
AT_ONCE = 64


class Parser(NamedTuple):
    name: str
    version: int
    schema: str  # the type of what it makes of a document
    parse: Callable[[bytes], Any]

    def on(self, content: Column) -> Column:
        """struct(out, ms): the parse of each document, and the time it took. A worker holds the results of AT_ONCE documents, whatever an Arrow batch holds."""
        parse = self.parse

        @pandas_udf(f"struct<out:{self.schema},ms:double>")
        def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                for i in range(0, len(batch), AT_ONCE):
                    rows = []
                    for c in batch[i : i + AT_ONCE]:
                        began = time.perf_counter()
                        rows.append((parse(c), (time.perf_counter() - began) * 1000))
                    yield pd.DataFrame(rows, columns=["out", "ms"])

        return run(content)


def _page(content: bytes | None) -> dict[str, Any]:
    page = markup.Page((content or b"").decode("utf-8", "replace"))
    tables = [[{"cells": r, "id": page.row_ids.get(id(r))} for r in t if any(r)] for t in page.tables]
    return {"tables": tables, "links": [dict(zip(("href", "text", "around"), x)) for x in page.links], "text": page.text, "lines": page.lines, "rendered": page.rendered}


#: Tables (rows that hold anything, with the register id among their links), links, and three forms of the text.
PAGE = Parser("page", 1, "struct<tables:array<array<struct<cells:array<string>,id:string>>>,links:array<struct<href:string,text:string,around:string>>,text:string,lines:string,rendered:string>", _page)


#: Text files, decoded.
TEXT = Parser("text", 1, "string", lambda content: (content or b"").decode("utf-8", "replace"))
#: Names of workbooks with their classes, the title, and why a file is none.
BOOK = Parser("workbook", 1, documents.BOOK, documents.book_names)


class Parsed(NamedTuple):
    files: DataFrame  # path, hash, bytes, ms, now (parsed in this run), out
    n_parsed: int


def _kept(folder: str, parser: Parser) -> str:
    return f"{folder.rstrip('/')}/{parser.name}-v{parser.version}"


def _read(files: DataFrame, folder: str, parser: Parser) -> DataFrame:
    spark, at = files.sparkSession, _kept(folder, parser)
    path = spark._jvm.org.apache.hadoop.fs.Path(at)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(path)
    return spark.read.schema(f"hash string, bytes long, ms double, run string, out {parser.schema}").parquet(at)


def parse(files: DataFrame, folder: str, parser: Parser = PAGE) -> Parsed:
    """What the parser makes of files (path, content), out of the store below `folder` or parsed now and kept there.

    Contents are hashed where they are read; of contents without a result one file each is parsed, so a row that moves holds no bytes but
    theirs. A run that breaks off leaves its finished results; two runs at once may both keep one, of which one counts. A null content is
    an empty document. No files: no rows.
    """
    run = uuid.uuid4().hex
    named = durable(files.select("path", F.sha2(F.coalesce("content", F.lit(b"")), 256).alias("hash"), F.coalesce(F.octet_length("content"), F.lit(0)).cast("long").alias("bytes")))
    lacking = named.join(_read(files, folder, parser).select("hash").distinct(), "hash", "left_anti").groupBy("hash").agg(F.min("path").alias("path"))
    seen = Observation()
    new = files.select("path", "content").join(lacking, "path").withColumn("p", parser.on(F.col("content")))
    new = new.select("hash", F.coalesce(F.octet_length("content"), F.lit(0)).cast("long").alias("bytes"), "p.ms", F.lit(run).alias("run"), "p.out")
    new.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("append").parquet(_kept(folder, parser))
    out = _read(files, folder, parser).dropDuplicates(["hash"]).withColumn("now", F.col("run") == run).select("hash", "ms", "now", "out")
    return Parsed(named.join(out, "hash").select("path", "hash", "bytes", "ms", "now", "out"), int(seen.get["n"]))


def effort(parsed: DataFrame, files: DataFrame) -> DataFrame:
    """(source_key, files, bytes, parsed_files, ms) of the run: what each source held, and what its new contents took to parse.

    files: (source_key, path). A content that several files share counts for the first of them.
    """
    p = parsed.join(files.select("path", "source_key"), "path")
    first = p.filter("now").groupBy("hash").agg(F.min("path").alias("path"), F.first("ms").alias("took")).select("path", "took")
    g = p.join(first, "path", "left").groupBy("source_key")
    return g.agg(F.count("*").alias("files"), F.sum("bytes").alias("bytes"), F.count("took").alias("parsed_files"), F.coalesce(F.sum("took"), F.lit(0.0)).alias("ms"))
