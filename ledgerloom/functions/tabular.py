"""Table functions for SQL: register(spark), then `from pages, lateral html_links(html)`, or `from walk_pages(table(pages), most => 260)`."""

from __future__ import annotations

from pyspark.sql import Row, SparkSession
from pyspark.sql.functions import AnalyzeArgument, AnalyzeResult, OrderingColumn, PartitioningColumn, SkipRestOfInputTableException, udtf
from pyspark.sql.types import LongType, StringType, StructType

from ..sources import markup


class HtmlTables:
    """Rows of every table of a page."""

    def eval(self, html: str):
        for t, rows in enumerate(markup.tables(html)):
            for r, cells in enumerate(rows):
                yield t, r, cells


class HtmlLinks:
    """Links of a page with their text and the text of their row."""

    def eval(self, html: str):
        yield from markup.Page(html).links


class NumberedEntries:
    """Bodies of the entries of a numbered list, in order."""

    def eval(self, text: str):
        yield from enumerate(markup.numbered_entries(text))


def _walk(table: AnalyzeArgument, needs: tuple[str, ...], by: str, order: str, adds: StructType, drops: tuple[str, ...] = ()) -> AnalyzeResult:
    """A walk over the rows of each `by` in `order`: the table's columns, without `drops`, and what the walk adds."""
    if not table.isTable:
        raise ValueError("the first argument is a table")
    names = [f.name for f in table.dataType.fields]
    if lacking := [n for n in needs if n not in names]:
        raise ValueError(f"the table lacks {', '.join(lacking)}")
    kept = StructType([f for f in table.dataType.fields if f.name not in drops])
    return AnalyzeResult(StructType(kept.fields + adds.fields), partitionBy=[PartitioningColumn(by)], orderBy=[OrderingColumn(order)])


class WalkPages:
    """The pages of a pager that are kept, from row to row: what is known so far decides where the walk of a register ends.

    pages: (source_key, page_ix from 1, keys: of its names, sig, target, others). A page seen before ends the walk in front of it; the target,
    `streak` pages without a new key, and page `most` end it behind. Adds n_new and, on a walk's last page, reason.
    """

    def __init__(self):
        self.seen, self.sigs, self.total, self.dry, self.held = set(), set(), 0, 0, None

    @staticmethod
    def analyze(pages: AnalyzeArgument, most: AnalyzeArgument, streak: AnalyzeArgument) -> AnalyzeResult:
        adds = StructType().add("n_new", LongType()).add("reason", StringType())
        return _walk(pages, ("source_key", "page_ix", "keys", "sig", "target"), "source_key", "page_ix", adds, ("keys", "sig", "target"))

    def eval(self, pages: Row, most: int, streak: int):
        page = pages.asDict()
        keys, sig, target = (page.pop(c) for c in ("keys", "sig", "target"))
        if sig in self.sigs:
            yield self._row("repeated page")
            raise SkipRestOfInputTableException("the walk is over")
        if self.held:
            yield self._row(None)
        new = {k for k in keys or [] if k} - self.seen
        self.seen |= new
        self.sigs.add(sig)
        self.total += len(new)
        self.dry = 0 if new else self.dry + 1
        self.held = (*page.values(), len(new))
        reason = None
        if target is not None and self.total >= target:
            reason = "target"
        elif self.dry >= streak and page["page_ix"] >= streak:
            reason = "no new names"
        elif page["page_ix"] >= most:
            reason = "cap"
        if reason:
            yield self._row(reason)
            raise SkipRestOfInputTableException("the walk is over")

    def _row(self, reason):
        row, self.held = (*self.held, reason), None
        return row

    def terminate(self):
        if self.held:
            yield self._row(None)


class Sequence:
    """The numbered rows of a document that carry its sequence on: the first is 3 at most, a later one follows the last by one or two.

    marks: (doc_id, pos, number, others); with `restart` a 1 begins anew. State is the last number alone.
    """

    def __init__(self):
        self.last = None

    @staticmethod
    def analyze(marks: AnalyzeArgument, restart: AnalyzeArgument) -> AnalyzeResult:
        return _walk(marks, ("doc_id", "pos", "number"), "doc_id", "pos", StructType())

    def eval(self, marks: Row, restart: bool):
        n = marks["number"]
        if n is not None and (n <= 3 if self.last is None else self.last < n <= self.last + 2 or (restart and n == 1 and self.last > 1)):
            self.last = n
            yield tuple(marks)


#: Functions over tables: their handlers say their schema.
WALKS = {"walk_pages": WalkPages, "in_sequence": Sequence}

FUNCTIONS = {
    "html_tables": (HtmlTables, "table_ix int, row_ix int, cells array<string>"),
    "html_links": (HtmlLinks, "href string, text string, around string"),
    "numbered_entries": (NumberedEntries, "pos int, entry string"),
}


def register(spark: SparkSession) -> None:
    """The table functions under their names, for SQL of this session."""
    for name, (handler, schema) in FUNCTIONS.items():
        spark.udtf.register(name, udtf(handler, returnType=schema))
    for name, handler in WALKS.items():
        spark.udtf.register(name, udtf(handler))
