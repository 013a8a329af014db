"""Line dedup: lines that many documents share go, the others stay in their order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import durable, row_keys, small

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_key(line: Column) -> Column:
    """The line without white space at its ends, A-Z in lower case. Only lines with other than ASCII characters take the slow way."""
    low = F.when(F.octet_length(line) == F.length(line), F.lower(line)).otherwise(F.translate(line, UPPER, LOWER))
    return F.btrim(low, F.lit(" \t\n\x0b\x0c\r"))


def _named(key: str = "key") -> list[Column]:
    """128 bits for a key, so that unlike lines of a large corpus do not meet."""
    return [F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(1), key).alias("h2")]


def common_lines(docs: DataFrame, documents: int = 10, chars: int = 1) -> DataFrame:
    """(h1, h2, n): keys of `chars` code points or more that stand in `documents` rows of docs (text) or more, n: in how many.

    A row's repeats of a key are one before anything moves, and counts are combined before the shuffle.
    """
    lines = F.split(F.coalesce("text", F.lit("")), "\n")
    keys = docs.select(F.explode(F.array_distinct(F.transform(lines, line_key))).alias("key")).filter(F.length("key") >= chars)
    return keys.select(*_named()).groupBy("h1", "h2").agg(F.count("*").alias("n")).filter(F.col("n") >= documents)


def drop_common_lines(docs: DataFrame, documents: int = 10, chars: int = 1) -> DataFrame:
    """doc_id, n_lines, n_dropped and kept (the text without common lines) for each row of docs (doc_id, text).

    Keys in more than a thousandth of the rows are at most a thousand times the mean number of lines; they are matched by broadcast if they are
    small as counted, so no line that all documents share meets in one task. The other keys meet their lines by shuffle. Only hashes,
    places and, once, the texts move. A row is a document: repeated rows and rows of one doc_id count each. Null and empty texts have one
    empty line, which stays. All lines dropped: the empty text. Null doc_ids are kept. Texts of any length are whole. Empty table: no rows.
    Other columns of docs are not read, whatever their names.
    """
    d = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    common = durable(common_lines(d, documents, chars))
    often = F.col("n") > docs.count() / 1000
    lines = d.filter("text <> ''").select(*row_keys("doc_id", "text"), F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    lines = lines.select("k1", "k2", "pos", line_key(F.col("line")).alias("key")).filter(F.length("key") >= chars).select("k1", "k2", "pos", *_named())
    hot, rest = small(common.filter(often).select("h1", "h2")), common.filter(~often).select("h1", "h2")
    gone = lines.join(hot, ["h1", "h2"], "left_semi").union(lines.join(hot, ["h1", "h2"], "left_anti").join(rest, ["h1", "h2"], "left_semi"))
    gone = gone.groupBy("k1", "k2").agg(F.collect_set("pos").alias("gone"))
    # empty texts drop nothing: their keys match none and spread
    some = F.col("text") != ""
    k1, k2 = row_keys("doc_id", "text")
    split = d.select("doc_id", F.split("text", "\n").alias("lines"), F.when(some, k1).otherwise(F.monotonically_increasing_id()).alias("k1"), F.when(some, k2).alias("k2"))
    met = split.join(gone, ["k1", "k2"], "left").withColumn("gone", F.coalesce("gone", F.array().cast("array<int>")))
    left = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "gone")
    kept = F.array_join(F.transform(left, lambda i: F.get(F.col("lines"), i)), "\n")
    return met.select("doc_id", F.size("lines").cast("long").alias("n_lines"), F.size("gone").cast("long").alias("n_dropped"), kept.alias("kept"))
