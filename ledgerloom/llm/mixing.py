"""Mixing sources to target weights by repetition rates, by DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import durable, row_keys, small

WORD = r"[^\x20\x09-\x0D]+"


def targets(sizes: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """source, source_size, n_docs, target: `share` of all words dealt by weight, no source above `most` times its size.

    Sources fill in the order of cap over weight; the level is where the rest's weights take what the full ones leave.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(x) for x in weights]), (F.row_number().over(by_name) - 1) % len(weights) + 1)
    per = per.withColumn("weight", w).withColumn("cap", F.col("source_size") * most)
    by_fill = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before, after = by_fill.rowsBetween(Window.unboundedPreceding, -1), by_fill.rowsBetween(0, Window.unboundedFollowing)
    whole = Window.partitionBy(F.lit(1))
    level = (F.sum("source_size").over(whole) * share - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(after)
    per = per.withColumn("level", level)
    per = per.withColumn("fill_rank", F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.row_number().over(by_fill)))
    first = F.min_by("level", "fill_rank").over(whole)
    return per.select("source", "source_size", "n_docs", F.least(F.col("cap"), F.coalesce(first, F.lit(0.0)) * F.col("weight")).alias("target"))


def mix(docs: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0, seed: int = 11, size: str | None = None) -> DataFrame:
    """docs with size, source_size, target, copies: floor(rate) plus one hash-seeded Bernoulli copy at the rate's fraction.

    Each row draws from a hash of its own (seed, doc_id, text) and, among rows equal in all columns, its number: what it gets does not depend
    on other rows but through its source's rate, and only the rates (a row per source) move. A source's words deviate from its target by
    about sqrt(sum of size**2 * f * (1 - f)). Rows equal in all columns are found by 128-bit hashes and numbered as one row with a count, so that
    however many there are never meet in a task.
    Null text: size 0. Null source: a source of its own, last. Null doc_id: hashed as the empty string, so its text decides. Rows equal
    in doc_id and text alone draw alike. Sizes all zero: no copies. Empty table: no rows. Long texts count whole. Columns of these names in
    docs are replaced.
    """
    n = F.col(size) if size else F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    docs = docs.drop("source_size", "target", "copies", "n_docs", *([] if size else ["size"]))
    columns = docs.columns
    named = docs.select("*", *row_keys(*columns))
    repeated = durable(named.groupBy("k1", "k2").agg(F.count("*").alias("n")).filter("n > 1").select("k1", "k2"))
    if repeated.isEmpty():
        each = docs.withColumn("_j", F.lit(1).cast("long"))
    else:
        again = small(repeated)
        twins = named.join(again, ["k1", "k2"], "left_semi").groupBy(*columns).agg(F.count("*").alias("_n"))
        alone = named.join(again, ["k1", "k2"], "left_anti").select(*columns, F.lit(1).cast("long").alias("_j"))
        each = alone.union(twins.select(*columns, F.explode(F.sequence(F.lit(1).cast("long"), "_n")).alias("_j")))
    t = small(targets(docs.select("source", n.alias("size")), weights, share, most).drop("n_docs").withColumnRenamed("source", "_source"))
    d = each.withColumn("size", n).join(t, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    number = F.when(F.col("_j") > 1, F.concat(F.lit("|"), F.col("_j").cast("string"))).otherwise("")
    told = [F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), *([F.coalesce("text", F.lit(""))] if "text" in columns else [])]
    u = F.conv(F.substring(F.md5(F.concat(F.concat_ws("|", *told), number).cast("binary")), 1, 12), 16, 10).cast("long") / float(1 << 48)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    return d.withColumn("copies", (F.floor(rate) + F.when(u < rate - F.floor(rate), 1).otherwise(0)).cast("long")).drop("_j")
