"""Fill-in-middle: texts cut at whole units and put in another order, by joins of cut requests with units."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import row_keys

LINES = r"[^\n]*\n|[^\n]+"


class Marks(NamedTuple):
    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"


def _after(text: Column, mark: str) -> Column:
    """What follows the first `mark`, which is there."""
    return F.substr(text, F.locate(mark, text) + len(mark))


def restore(output: Column, form: Column, marks: Marks = Marks()) -> Column:
    """The text out of an output and its form. No mark occurs in a text that was cut, so the first one of each kind is the seam."""
    psm = _after(output, marks.prefix)
    rest = _after(psm, marks.suffix)
    spm = _after(output, marks.suffix)
    tail = _after(spm, marks.prefix)
    until = lambda text, mark: F.substring_index(text, mark, 1)
    return (
        F.when(form == "psm", F.concat(until(psm, marks.suffix), _after(rest, marks.middle), until(rest, marks.middle)))
        .when(form == "spm", F.concat(until(tail, marks.middle), _after(tail, marks.middle), until(spm, marks.prefix)))
        .otherwise(output)
    )


def offsets(docs: DataFrame, unit: str = LINES) -> DataFrame:
    """(k1, k2, prefix_chars, cut_chars) for rows (k1, k2, text, low, high): code points of the first `low` and the first `high` units.

    Units of a text are rows, a running sum over their lengths says where each ends, and both requests of a text meet it by unit number.
    Rows of equal keys are one. A request for no unit meets none: null.
    """
    units = docs.select("k1", "k2", F.posexplode(F.regexp_extract_all("text", F.lit(unit), F.lit(0))).alias("pos", "unit"))
    units = units.select("k1", "k2", (F.col("pos") + 1).alias("ordinal"), F.length("unit").alias("chars")).groupBy("k1", "k2", "ordinal").agg(F.max("chars").alias("chars"))
    so_far = Window.partitionBy("k1", "k2").orderBy("ordinal").rowsBetween(Window.unboundedPreceding, 0)
    ends = units.select("k1", "k2", "ordinal", F.sum("chars").over(so_far).alias("end"))
    asked = docs.select("k1", "k2", "low", "high").filter("high > 0").distinct()
    met = asked.join(ends, [asked.k1 == ends.k1, asked.k2 == ends.k2, F.col("ordinal").isin(F.col("low"), F.col("high"))])
    end_of = lambda cut: F.max(F.when(F.col("ordinal") == F.col(cut), F.col("end")))
    return met.groupBy(asked.k1, asked.k2).agg(end_of("low").alias("prefix_chars"), end_of("high").alias("cut_chars"))


def fill_in_middle(docs: DataFrame, unit: str = LINES, seed: str = "7", rate: int = 100, spm: int = 50, marks: Marks = Marks()) -> DataFrame:
    """doc_id, text, n (units), form, prefix_chars, middle_chars, output for each row of docs (doc_id, text).

    A hash of seed and doc_id draws two cuts at whole units, whether the text is cut (`rate` of 100) and which order it gets (`spm` of 100).
    Texts that are empty (null: empty) or hold a mark stay plain, with null lengths. Null doc_ids are hashed as the empty string. Repeated
    rows each return, cut alike. A text of one unit has its cuts before or behind it. Texts of any length are whole: units move as numbers,
    each text once. Empty table: no rows. Other columns of docs are not read, whatever their names.
    """
    d = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    d = d.withColumn("n", F.regexp_count("text", F.lit(unit)).cast("long")).withColumn("digest", digest)
    h = lambda i: F.conv(F.substring("digest", 8 * i - 7, 8), 16, 10).cast("long")
    first, second = h(1) % (F.col("n") + 1), h(2) % (F.col("n") + 1)
    marked = F.col("text").contains(marks.prefix) | F.col("text").contains(marks.suffix) | F.col("text").contains(marks.middle)
    plain = (F.col("text") == "") | marked | (h(3) % 100 >= rate)
    form = F.when(plain, "plain").when(h(4) % 100 < spm, "spm").otherwise("psm")
    d = d.select("doc_id", "text", "n", F.least(first, second).alias("low"), F.greatest(first, second).alias("high"), form.alias("form"))
    k1, k2 = row_keys("doc_id", "text")
    at = offsets(d.filter("form <> 'plain'").select(k1, k2, "text", "low", "high"), unit)
    # plain texts ask for no cut: their keys match none and spread
    is_cut = F.col("form") != "plain"
    d = d.select("doc_id", "text", "n", "form", F.when(is_cut, k1).otherwise(F.monotonically_increasing_id()).alias("k1"), F.when(is_cut, k2).alias("k2"))
    d = d.join(at, ["k1", "k2"], "left")
    low, high = (F.when(is_cut, F.coalesce(F.col(c), F.lit(0))).cast("int") for c in ("prefix_chars", "cut_chars"))
    d = d.select("doc_id", "text", "n", "form", low.alias("low"), high.alias("high"))
    prefix, middle, suffix = F.substr("text", F.lit(1), F.col("low")), F.substr("text", F.col("low") + 1, F.col("high") - F.col("low")), F.substr("text", F.col("high") + 1)
    p, s, m = (F.lit(x) for x in marks)
    output = F.when(F.col("form") == "psm", F.concat(p, prefix, s, suffix, m, middle)).when(F.col("form") == "spm", F.concat(s, suffix, p, prefix, m, middle)).otherwise(F.col("text"))
    return d.select("doc_id", "text", "n", "form", F.col("low").cast("long").alias("prefix_chars"), (F.col("high") - F.col("low")).cast("long").alias("middle_chars"), output.alias("output"))
