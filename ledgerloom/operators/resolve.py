"""Priority of categories, and one category per entity."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.names import category_key

# Rank and category, in order; a later row of one name holds its rank, the first its place.
PRIORITY = {
    1: ["Public Sector Bank"],
    2: ["Private Sector Banks"],
    3: ["foreign banks"],
    4: ["Local Area Banks", "Non-Scheduled State Co-operative Banks", "Non-Scheduled Urban Co-operative Banks", "Regional Rural Banks", "Scheduled Urban Co-operative Banks", "Small Finance Banks", "State Co-operative Banks"],
    5: ["Health insurer", "Life insurers", "Mutual Funds", "Non-Life (Ganeral) Insurance Companies", "Re insurers", "reinsurers"],
    6: ["Pension Fund"],
    7: ["HFCs"],
    8: ["NBFC"],
    9: ["Financial Institutions in India"],
    10: [
        "ARC", "Banker to an Issue", "CA-Insurer-List", "Credit Rating Agency", "Debentures Trustee", "Depository Participants - CDSL", "Depository Participants - NSDL", "Investment Adviser", "Merchant Banker",
        "Payments Banks", "PSS Operating", "PSS Revoked", "Registered Custodians", "Registered Foreign Venture Capital Investors", "Registered Portfolio Managers", "Share Transfer Agent",
        "Stock Brokers in Commodity Derivative", "Stock Brokers in Currency Derivative Segment", "Stock Brokers in Debt Segement", "Stock Brokers in Equity Derivative Segment", "Stock Brokers in equity segment",
        "Stock Brokers in Interest Rate Derivative", "Venture Capital Funds", "Foreign Reinsurance Branches", "Brokers", "Surveyors", "Web-aggregators", "Insurance-repository", "Imf", "Third-party-administrators",
    ],
}
SUBTYPE = r"(?i)^(ICC|CIC|IFC|MFI|P2P|Factor|ARC|AA|Account Aggregator|NOFHC|IDF|PD|Primary Dealer|Type-?I NBFC|MGC)\b"
UNRANKED = 999


def category_rank(category):
    """Rank by equal name, else the first listed name where one holds the other, else 8 for subtypes, else 999. A constant-size expression."""
    listed = F.array(*[F.struct(category_key(F.lit(c)).alias("k"), F.lit(r).alias("r")) for r, cs in PRIORITY.items() for c in cs])
    key = category_key(category)
    first = lambda test: F.get(F.filter(listed, test), F.lit(0))["r"]
    return F.coalesce(first(lambda x: x["k"] == key), first(lambda x: F.contains(key, x["k"]) | F.contains(x["k"], key)), F.when(category.rlike(SUBTYPE), F.lit(8)), F.lit(UNRANKED))


def resolve(hits: DataFrame, keys: DataFrame) -> DataFrame:
    """One row per entity of hits (ord, name, category_return, category_regulator, regulator, source_key, status); keys: (name, entity_key)."""
    ranks = hits.select("category_regulator").distinct().withColumn("rank", category_rank(F.col("category_regulator")))
    h = hits.join(keys, "name").join(ranks, hits.category_regulator.eqNullSafe(ranks.category_regulator)).drop(ranks.category_regulator)
    order = F.struct("rank", "ord")
    win = F.min_by(F.struct("category_regulator", "category_return", "regulator", "source_key", "status", "rank"), order)
    members = F.array_sort(F.collect_list(F.struct("ord", "category_regulator", "rank", "regulator", "source_key")))
    g = h.groupBy("entity_key").agg(F.min_by("name", "ord").alias("name"), win.alias("w"), members.alias("m"), F.count_distinct("category_regulator").alias("category_count"))
    return g.select(
        "entity_key", "name", F.col("w.category_regulator").alias("category"), F.col("w.category_return").alias("category_return"), F.col("w.regulator").alias("regulator"), F.col("w.source_key").alias("source_key"),
        F.col("w.status").alias("status"), F.col("w.rank").alias("final_rank"), F.array_join(F.transform("m", lambda x: x["category_regulator"]), " | ").alias("all_categories"), "category_count", F.col("m").alias("memberships"),
    )


def first_seen(df: DataFrame, key: str, order: str) -> DataFrame:
    """Ordered distinct: of each key the row that came first."""
    return df.withColumn("_r", F.row_number().over(Window.partitionBy(key).orderBy(order))).filter("_r = 1").drop("_r")
