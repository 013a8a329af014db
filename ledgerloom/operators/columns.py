"""Header rows, name columns and column scores of tables that come as rows: (doc_id, table_ix, row_ix, cells), none empty.

The rows of a table meet once; what is read from them are the expressions that read pages (functions.cells).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import cells, clean

TABLE = ["doc_id", "table_ix"]


def tables(rows: DataFrame) -> DataFrame:
    """(doc_id, table_ix, row_ixs, rows, at, header, data): a table a row; those without a header are left out."""
    g = rows.groupBy(*TABLE).agg(F.array_sort(F.collect_list(F.struct("row_ix", "cells"))).alias("r"))
    g = g.select(*TABLE, F.col("r.row_ix").alias("row_ixs"), F.col("r.cells").alias("rows")).withColumn("at", cells.header_at(F.col("rows"))).filter("at is not null")
    return g.withColumns({"header": F.get("rows", F.col("at")), "data": cells.below(F.col("rows"), F.col("at"))})


def column_scores(rows: DataFrame) -> DataFrame:
    """(doc_id, table_ix, col, label, filled, latin_share, text_share, number_share, mean_length, devanagari) per column of data."""
    t = tables(rows)
    wide = F.array_max(F.transform("data", F.size))
    c = t.filter(wide > 0).select(*TABLE, "header", "data", F.explode(F.sequence(F.lit(0), wide - 1)).alias("col"))
    c = c.select(*TABLE, "col", F.coalesce(F.get("header", F.col("col")), F.lit("")).alias("label"), cells.values(F.col("data"), F.col("col")).alias("v"))
    v, number = F.col("v"), lambda x: F.trim(x).rlike(r"^\d+$")
    return c.select(
        *TABLE, "col", "label", F.size(F.filter(v, lambda x: x != "")).cast("long").alias("filled"), cells.share(v, cells.is_latin).alias("latin_share"), cells.share(v, cells.is_text).alias("text_share"),
        cells.share(v, number).alias("number_share"), cells.mean_length(v).alias("mean_length"), F.exists(v, lambda x: x.rlike(cells.DEVANAGARI)).alias("devanagari"),
    )


def release_columns(rows: DataFrame) -> DataFrame:
    """(doc_id, table_ix, col) of a release's tables; those that no column fits are left out."""
    return tables(rows).select(*TABLE, cells.release_column(F.col("header"), F.col("data")).alias("col")).filter("col is not null")


def table_names(rows: DataFrame) -> DataFrame:
    """(doc_id, table_ix, row_ix, name): the name column's values below the header, Devanagari stripped; blanks and serial labels left out."""
    # the column is chosen once a table, not once a row
    t = tables(rows).withColumn("names", cells.let(cells.name_column(F.col("header"), F.col("data")), lambda col: cells.values(F.col("data"), col)))
    # numbers and names side by side in the array: a row that is exploded carries none of its table's arrays
    n = t.select(*TABLE, F.inline(F.arrays_zip(cells.below(F.col("row_ixs"), F.col("at")).alias("row_ix"), F.col("names").alias("name"))))
    n = n.select(*TABLE, "row_ix", clean.strip_devanagari(F.trim("name")).alias("name"))
    return n.filter((F.col("name") != "") & ~F.col("name").rlike(cells.SERIAL) & (F.length("name") <= 180))
