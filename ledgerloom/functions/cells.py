"""Header rows, name columns and names of tables, as expressions over their cells: arrays of rows, in order, none empty.

A table stays in its row from the parse to its names, so nothing is shuffled and all judgement is done in the JVM.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Header words by priority, words of any name-like header, labels of header rows, serial labels, headers and labels of releases.
PRIORITY = ["name", "company", "entity", "institution"]
NAME_LIKE = r"(?i)name|company|entity|institution|insurer|agent"
LABELS = r"(?i)name|company|entity|institution|sl\.?\s*no"
SERIAL = r"(?i)^(sl\.?\s*no\.?|s\.?\s*no\.?)$"
RELEASE_HEADER = r"(?i)name of the compan|name of company|\bname\b"
RELEASE_LABEL = r"(?i)^(sl\.?\s*no\.?|s\.?\s*no\.?|sr\.?\s*no\.?|name(\s+of\s+the\s+compan(y|ies))?)$"
DATE = r"^[A-Za-z]+\s+\d{1,2},?\s+\d{4}$"
DEVANAGARI = "[ऀ-ॿ]"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with the value worked out once: inside lambdas nothing is shared otherwise."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def header_at(rows: Column, within: int = 15) -> Column:
    """Place of the header: of the first rows with two filled cells the first that holds a label, else the first; null for none."""
    filled = lambda r: F.size(F.filter(r, lambda c: c != ""))
    ranked = F.transform(F.slice(rows, 1, within), lambda r, i: F.when(filled(r) >= 2, F.struct((~F.exists(r, lambda c: c.rlike(LABELS))).alias("plain"), i.alias("at"))))
    return F.array_min(F.filter(ranked, lambda x: x.isNotNull()))["at"]


def below(rows: Column, at: Column) -> Column:
    return F.slice(rows, at + 2, F.greatest(F.size(rows), F.lit(1)))


def values(data: Column, col: Column) -> Column:
    """A column's values; rows that are too short have the empty one."""
    return F.transform(data, lambda r: F.coalesce(F.get(r, col), F.lit("")))


def share(of: Column, test: Callable[[Column], Column]) -> Column:
    """Share of the filled values that pass; 0 where none is filled."""
    return let(F.filter(of, lambda v: v != ""), lambda v: F.when(F.size(v) > 0, F.size(F.filter(v, test)) / F.size(v)).otherwise(0.0))


def is_latin(v: Column) -> Column:
    return F.regexp_replace(v, DEVANAGARI, "").rlike("[A-Za-z]{3}")


def is_text(v: Column) -> Column:
    """Like a name: four characters, three letters in a row, no date."""
    t = F.trim(v)
    return (F.length(t) >= 4) & t.rlike("[A-Za-z]{3}") & ~t.rlike(DATE)


def mean_length(of: Column) -> Column:
    lengths = F.transform(F.filter(of, lambda v: F.trim(v) != ""), lambda v: F.length(F.trim(v)).cast("double"))
    return let(lengths, lambda x: F.when(F.size(x) > 0, F.aggregate(x, F.lit(0.0), lambda a, b: a + b) / F.size(x)))


def guessed_column(header: Column) -> Column:
    """The first column of the first header word by priority, else the first."""
    at = lambda w: F.array_position(F.transform(header, lambda c: F.contains(F.lower(c), F.lit(w))), True)
    return F.coalesce(*[F.nullif(at(w), F.lit(0)) for w in PRIORITY], F.lit(1)).cast("int") - 1


def name_column(header: Column, data: Column) -> Column:
    """The guessed column; where that holds Devanagari, the name-like one with the largest share of Latin text, if that is half or more."""
    rated = F.transform(header, lambda h, i: F.when(h.rlike(NAME_LIKE), F.struct(share(values(data, i), is_latin).alias("share"), (-i).alias("first"), i.alias("col"))))
    best = F.array_max(F.filter(rated, lambda x: x.isNotNull()))
    choose = lambda at: F.when(F.exists(values(data, at), lambda v: v.rlike(DEVANAGARI)), let(best, lambda b: F.when(b["share"] >= 0.5, b["col"]).otherwise(at))).otherwise(at)
    return let(guessed_column(header), choose)


def table_names(rows: Column) -> Column:
    """Values of a table's name column below its header; blanks and serial labels left out."""
    kept = lambda v: F.filter(F.transform(v, F.trim), lambda n: (n != "") & ~n.rlike(SERIAL))
    of = lambda h: let(F.get(rows, h), lambda header: let(below(rows, h), lambda data: let(name_column(header, data), lambda col: kept(values(data, col)))))
    return F.coalesce(let(header_at(rows), of), F.array().cast("array<string>"))


def page_names(tables: Column, header_pattern: str | None = None) -> Column:
    """Names of all tables of two rows or more, or of those alone whose first three rows match, where any does."""
    two = F.filter(tables, lambda t: F.size(t) >= 2)
    names = lambda some: F.flatten(F.transform(some, table_names))
    if header_pattern is None:
        return names(two)
    fits = lambda t: F.exists(F.slice(t, 1, 3), lambda r: F.exists(r, lambda c: c.rlike(f"(?i){header_pattern}")))
    both = F.struct(F.filter(two, fits).alias("fit"), two.alias("all"))  # a Python parse may stand in front of a lambda, not in it
    return let(both, lambda x: names(F.when(F.size(x["fit"]) > 0, x["fit"]).otherwise(x["all"])))


def release_column(header: Column, data: Column, least: float = 0.85) -> Column:
    """The column under a name header if enough of it is text, else the text column of the shortest values; null where there is neither."""
    own = F.array_position(F.transform(header, lambda c: c.rlike(RELEASE_HEADER)), True).cast("int") - 1
    wide = F.coalesce(F.array_max(F.transform(data, F.size)), F.lit(0))
    rated = lambda c: let(values(data, c), lambda v: F.when(share(v, is_text) >= least, F.struct(mean_length(v).alias("length"), c.alias("col"))))
    columns = F.when(wide > 0, F.sequence(F.lit(0), wide - 1)).otherwise(F.array().cast("array<int>"))
    other = F.array_min(F.filter(F.transform(columns, rated), lambda x: x.isNotNull()))["col"]
    return let(own, lambda at: F.when(share(values(data, at), is_text) >= least, at).otherwise(other))


def release_names(tables: Column) -> Column:
    """Names in a release's tables. Each follows its own header; one without is read as the sequel of the one before if all its rows are as wide
    and count. A table that no column fits is left out, and the next sequel goes on from the table in front of it."""
    none = F.lit(None).cast("int")
    shape = lambda names, col, width: F.struct(names.alias("names"), col.alias("col"), width.alias("width"))
    found = lambda data, col: F.filter(values(data, col), lambda n: (n != "") & ~n.rlike(RELEASE_LABEL))

    def headed(so_far, t, at):
        def with_column(header, data, col):
            return F.when(col.isNull(), so_far).otherwise(shape(F.concat(so_far["names"], found(data, col)), col, F.size(header)))

        return let(F.get(t, at), lambda header: let(below(t, at), lambda data: let(release_column(header, data), lambda col: with_column(header, data, col))))

    def step(so_far, t):
        at = F.array_position(F.transform(t, lambda r: F.exists(r, lambda c: c.rlike(RELEASE_HEADER))), True).cast("int") - 1
        sequel = so_far["col"].isNotNull() & F.forall(t, lambda r: (F.size(r) == so_far["width"]) & F.get(r, F.lit(0)).rlike(r"^\d{1,4}$"))
        more = shape(F.concat(so_far["names"], found(t, so_far["col"])), so_far["col"], so_far["width"])
        return let(at, lambda i: F.when(i >= 0, headed(so_far, t, i)).when(F.coalesce(sequel, F.lit(False)), more).otherwise(so_far))

    start = shape(F.array().cast("array<string>"), none, none)
    return F.array_distinct(F.aggregate(F.filter(tables, lambda t: F.size(t) >= 1), start, step, lambda s: s["names"]))


def intermediary_names(tables: Column, lines: Column) -> Column:
    """Names under a table header that begins with 'name'; without such a table, the values between Name and Registration No. in the text's lines."""
    named = lambda r: F.transform(r, lambda c: c.rlike(r"(?i)^name\b"))
    none = F.array().cast("array<string>")
    kept = lambda v: F.filter(v, lambda n: (n != "") & (F.length(n) <= 150) & ~n.rlike(SERIAL))
    under = lambda t, h: let(F.array_position(named(F.get(t, h)), True).cast("int") - 1, lambda col: kept(values(below(t, h), col)))
    of = lambda t: let(F.array_position(F.transform(t, lambda r: F.exists(r, lambda c: c.rlike(r"(?i)^name\b"))), True).cast("int") - 1, lambda h: F.when((F.size(t) >= 2) & (h >= 0), under(t, h)).otherwise(none))
    pairs = F.transform(F.regexp_extract_all(lines, F.lit(r"\bName\s*\n?\s*(.+?)\s*\n?\s*Registration No\."), F.lit(1)), F.trim)
    pairs = F.filter(pairs, lambda n: F.length(n).between(3, 150) & ~n.rlike(r"^\d+$"))
    return let(F.struct(F.flatten(F.transform(tables, of)).alias("table"), pairs.alias("text")), lambda x: F.array_distinct(F.when(F.size(x["table"]) > 0, x["table"]).otherwise(x["text"])))
