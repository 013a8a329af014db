"""Stop rules of paged listings, over staged pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import clean, names as N, tabular


def _fresh(pages: DataFrame, key) -> DataFrame:
    """pages (source_key, page_ix, names) with n_new: names whose key no earlier page had."""
    first = pages.select("source_key", "page_ix", F.explode("names").alias("n")).select("source_key", "page_ix", key(F.col("n")).alias("k")).filter("k <> ''")
    first = first.groupBy("source_key", "k").agg(F.min("page_ix").alias("page_ix"))
    new = first.groupBy("source_key", "page_ix").agg(F.count("*").alias("n_new"))
    return pages.join(new, ["source_key", "page_ix"], "left").withColumn("n_new", F.coalesce("n_new", F.lit(0)))


def table_pages(pages: DataFrame, most: int = 80) -> DataFrame:
    """Pages up to the first that adds no unseen name, 80 at most."""
    p = _fresh(pages.filter(F.col("page_ix") <= most), lambda n: F.trim(n))
    stale = F.max(F.when((F.col("n_new") == 0) & (F.col("page_ix") > 1), True).otherwise(False)).over(Window.partitionBy("source_key").orderBy("page_ix"))
    return p.withColumn("_stop", stale).filter("not _stop").drop("_stop")


def walked_pages(pages: DataFrame, most: int = 260, streak: int = 3) -> DataFrame:
    """Pages a pager walk keeps, with reason on its last: target reached, cap, a page seen before, or three pages without a new name.

    pages: (source_key, page_ix from 1, names, target). Keys are canonical, so spellings of one name are not new.
    """
    keys = F.transform("names", N.canonical_key)
    p = pages.select("source_key", "page_ix", "names", keys.alias("keys"), clean.page_signature(F.col("names")).alias("sig"), "target")
    return F.udtf(tabular.WalkPages)(p.asTable(), F.lit(most), F.lit(streak))


def page_names(pages: DataFrame) -> DataFrame:
    """Names of kept pages, the first spelling of each key."""
    n = pages.select("source_key", "page_ix", F.posexplode("names").alias("pos", "name")).withColumn("key", N.canonical_key(F.col("name"))).filter("key <> ''")
    return n.groupBy("source_key", "key").agg(F.min_by("name", F.struct("page_ix", "pos")).alias("name"))


def topped_up(files: DataFrame, pages: DataFrame, top_up: bool = False) -> DataFrame:
    """Names of a downloaded file (source_key, name); pages' names count only where there is no file, or with `top_up` where the file lacks them."""
    f = files.withColumn("key", N.canonical_key(F.col("name"))).filter("key <> ''").groupBy("source_key", "key").agg(F.min("name").alias("name"))
    return f.unionByName(page_names(pages).join(f, ["source_key", "key"] if top_up else ["source_key"], "left_anti"))


def file_stats(rows: DataFrame) -> DataFrame:
    """Per file (file, name): rows, blank, serial labels, over 180 characters, distinct and repeated names."""
    n = F.trim(F.coalesce("name", F.lit("")))
    kind = F.when(n == "", "blank").when(n.rlike(r"(?i)^(?:sl\.?\s*no\.?|s\.?\s*no\.?)$"), "serial").when(F.length(n) > 180, "long").otherwise("name")
    r = rows.select("file", n.alias("n"), kind.alias("kind"))
    is_ = lambda k: F.count_if(F.col("kind") == k)
    g = r.groupBy("file").agg(F.count("*").alias("data_rows"), is_("blank").alias("blank"), is_("serial").alias("serial"), is_("long").alias("too_long"), is_("name").alias("_n"), F.count_distinct(F.when(F.col("kind") == "name", F.col("n"))).alias("unique_names"))
    return g.withColumn("repeated", F.col("_n") - F.col("unique_names")).drop("_n")
