"""Homomorphic multiset hash of a text's paragraph pieces, by DataFrame functions only.

A text is cut at sentence and line ends (and after 200 characters) into pieces. Two 64-bit hashes of a piece give a wide vector of 128
lanes of 0 or 1; a text's fingerprint is the sum of its pieces' vectors and their number, each modulo 2**30, more than the pieces any text can have. So the order of pieces does
not matter, and inserting or deleting pieces adds or subtracts their vectors. Two lanes share a long, 32 bits apart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import durable

PIECE = r"[^.!?\n]{1,200}[.!?\n]*|[.!?\n]+"
FIELD = 0x3FFFFFFF
ONES = 0x0000000100000001
FIELDS = FIELD * ONES
KEY = ("has", "kd", "h")  # of a row: is there a doc_id, the doc_id, the text's hash


def pieces(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(PIECE), F.lit(0))


def with_vector(df: DataFrame, text: str, name: str) -> DataFrame:
    """df with `name`: array of 65 longs, 64 of packed lane sums and one of the number of pieces. Null or empty text: zeros."""
    h = df.withColumn("_p", pieces(F.col(text))).withColumn("_h", F.transform("_p", lambda p: F.struct(F.xxhash64(p).alias("a"), F.xxhash64(p, F.lit(1)).alias("b"))))

    def lanes(side: str, shift: int) -> Column:
        return F.aggregate("_h", F.lit(0).cast("long"), lambda acc, x: (acc + F.shiftrightunsigned(x[side], shift).bitwiseAND(F.lit(ONES))).bitwiseAND(F.lit(FIELDS)))

    sums = [lanes(side, shift) for side in ("a", "b") for shift in range(32)]
    return h.withColumn(name, F.array(*sums, (F.size("_p") % (FIELD + 1)).cast("long"))).drop("_p", "_h")


def combine(a: Column, b: Column, sign: int = 1) -> Column:
    """Fingerprint of both multisets together (sign 1), or of a without b's pieces (sign -1)."""
    return F.zip_with(a, b, lambda x, y: (x + y).bitwiseAND(F.lit(FIELDS)) if sign > 0 else (x + F.lit(FIELDS) - y + F.lit(ONES)).bitwiseAND(F.lit(FIELDS)))


def text_form(v: Column) -> Column:
    return F.array_join(F.transform(v, lambda x: F.lower(F.lpad(F.hex(x), 16, "0"))), "")


def _signed(v: Column) -> Column:
    """Lane sums as differences of ones and zeros, around nought."""
    n = F.element_at(v, 65)
    lanes = F.flatten(F.transform(F.slice(v, 1, 64), lambda x: F.array(*[F.shiftrightunsigned(x, 32 * i).bitwiseAND(F.lit(FIELD)) for i in range(2)])))
    return F.transform(lanes, lambda c: ((F.pmod(2 * c - n + (1 << 29), F.lit(1 << 30)) - (1 << 29))).cast("double"))


def with_likeness(df: DataFrame, a: str, b: str, name: str) -> DataFrame:
    """df with the cosine of two fingerprints' signed lanes (an estimate of the multisets' cosine), from 0 to 1; equal ones: 1."""
    d = df.withColumn("_x", _signed(F.col(a))).withColumn("_y", _signed(F.col(b)))
    dot = lambda p, q: F.aggregate(F.zip_with(p, q, lambda s, t: s * t), F.lit(0.0), lambda acc, s: acc + s)
    d = d.withColumn("_d", dot("_x", "_y")).withColumn("_n", F.sqrt(dot("_x", "_x") * dot("_y", "_y")))
    like = F.when(F.col(a) == F.col(b), 1.0).when(F.col("_n") == 0, 0.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("_d") / F.col("_n"))))
    return d.withColumn(name, like).drop("_x", "_y", "_d", "_n")


def followers(entries: DataFrame) -> DataFrame:
    """entries (has, kd, h, c, n_chars: one row per key, c copies) with what follows each in descending order: `copies`, and its key (nhas, nkd, nh).

    Keys are dealt out by ranges; a range's last key is followed by the first one of the range below, and the last of all by the first of
    all. Of c equal rows all but one are followed by their like. Only keys move.
    """
    r = durable(entries.repartitionByRange(*[F.desc(k) for k in KEY]).withColumn("part", F.spark_partition_id()))
    down = Window.orderBy("part")  # over a row per range
    first = r.groupBy("part").agg(F.max(F.struct(*KEY)).alias("first"))
    below = first.select("part", F.coalesce(F.lead("first").over(down), F.first("first").over(down)).alias("below"))
    inside = Window.partitionBy("part").orderBy(*[F.desc(k) for k in KEY])
    n = r.join(F.broadcast(below), "part").withColumn("then", F.coalesce(F.lead(F.struct(*KEY)).over(inside), F.col("below")))
    one = F.struct(F.lit(1).cast("long").alias("copies"), *[F.col(f"then.{k}").alias(f"n{k}") for k in KEY])
    same = F.struct((F.col("c") - 1).alias("copies"), *[F.col(k).alias(f"n{k}") for k in KEY])
    return n.select(*KEY, "n_chars", F.explode(F.filter(F.array(one, same), lambda x: x["copies"] > 0)).alias("x")).select(*KEY, "n_chars", "x.*")


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The next document is the one below in doc_id. What follows what is settled on keys alone (doc_id and the text's hash); then texts and
    fingerprints meet by key, so no task sorts or holds a range of texts, and of the next text only the part that is needed moves on.
    Null text: empty. Repeated doc_ids stand in the descending order of their texts' hashes, equal rows next to each other; null doc_ids
    come last. A single row is its own next. Very long texts: whole. Other columns of docs are not read. Empty table: no rows.
    """
    d = docs.select(F.col("doc_id").isNotNull().alias("has"), F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("kd"), F.coalesce("text", F.lit("")).alias("text")).withColumn("h", F.xxhash64("text"))
    nxt = followers(d.groupBy(*KEY).agg(F.count("*").alias("c"), F.first(F.length("text")).alias("n_chars")))
    texts = with_vector(d, "text", "v").groupBy(*KEY).agg(F.first("text").alias("text"), F.first("v").alias("v"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    other = texts.select(*[F.col(k).alias(f"n{k}") for k in KEY], F.col("text").alias("next"), F.col("v").alias("_c"))
    tails = nxt.join(other, [f"n{k}" for k in KEY]).select(*KEY, "copies", "n_chars", F.col("next").substr(F.lit(1), half).alias("tail"), "_c")
    e = texts.withColumnRenamed("v", "_a").join(tails, list(KEY))
    e = e.withColumn("edited", F.concat(F.col("text").substr(F.lit(1), F.col("n_chars") - half), "tail"))
    e = with_likeness(with_likeness(with_vector(e, "edited", "_b"), "_a", "_b", "near_edited"), "_a", "_c", "near_next")
    doc_id, n_chars = F.when(F.col("has"), F.col("kd")).alias("doc_id"), F.col("n_chars").cast("long").alias("n_chars")
    e = e.select(doc_id, n_chars, F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"), text_form(F.col("_a")).alias("fingerprint"), text_form(F.col("_b")).alias("edited_fingerprint"), "near_edited", "near_next", "copies")
    return e.withColumn("_n", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).drop("_n", "copies")
