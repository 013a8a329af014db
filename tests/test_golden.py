"""Golden cases of the registry's rules: sameness of names, categories, priorities, renames, releases, payment lists, hub ids, audit figures."""

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import clean, documents, names as N
from ledgerloom.operators import entities, ingest, resolve, sections


def keys(spark, *names):
    return {r.name: r.entity_key for r in entities.entity_keys(spark.createDataFrame([(n,) for n in names], "name string")).collect()}


SAME = [
    ("Sammaan Capital Limited (Formerly: Indiabulls Housing Finance Limited)", "Indiabulls Housing Finance Ltd."),
    ("Alpha Housing Finance Ltd formerly known as Beta Finance Pvt. Ltd.", "BETA FINANCE PRIVATE LIMITED"),
    ("Narven Finance & Investments Limited", "Narven Finance And Investments Ltd"),
    ("Tyger Capital Private Limied (Formerly: Adani Capital Private Limited)", "TYGER CAPITAL PRIVATE LIMITED"),
    ("Balasaria Holdings Private Limited (Name as per MCA - BRBS Holdings Private Limited)", "BRBS HOLDINGS PRIVATE LIMITED"),
    ("Standard Chartered Capital Limited (Formerly: Standard Chartered Investments & Loans (India) Limited)", "STANDARD CHARTERED CAPITAL LIMITED"),
]
OTHER = [("SBM Bank (India) Limited", "Other Co Ltd"), ("Tyger Home Finance Private Limited", "TYGER CAPITAL PRIVATE LIMITED"), ("ABC Finance 1 Private Limited Company X", "ABC Finance 2 Private Limited Company X")]


def test_sameness(spark):
    k = keys(spark, *{n for pair in SAME + OTHER for n in pair})
    assert [p for p in SAME if k[p[0]] != k[p[1]]] == [] and [p for p in OTHER if k[p[0]] == k[p[1]]] == []


def test_merged_names(spark):
    n = spark.createDataFrame([("Piramal Finance Ltd, (Formerly Known As Piramal Finance Pvt Ltd) Merged With Piramal Housing Finance Ltd.",)], "n string").select(N.entity_names(F.col("n")).alias("e")).first().e
    assert (n.primary, list(n.aliases)) == ("Piramal Finance Ltd", ["Piramal Finance Pvt Ltd"])


@pytest.mark.parametrize(
    ("source", "name", "classification", "want"),
    [
        ("rbi_nbfc", "X Housing Finance Ltd", "HFC", ("HFCs", "Housing Finance Companies")),
        ("rbi_nbfc", "Phoenix ARC Limited", None, ("ARC", "Other Financial Entities")),
        ("rbi_nbfc", "Edelweiss Asset Reconstruction Company Limited", None, ("ARC", "Other Financial Entities")),
        ("rbi_nbfc", "Northern Arc Capital Limited", "ICC*", ("ICC*", "Other NBFCs")),
        ("rbi_nbfc", "Assets Care & Reconstruction Enterprise Limited", "NBFC", ("ARC", "Other Financial Entities")),
        ("rbi_nbfc_cancelled", "Lone star India Asset Reconstruction Private Limited", None, ("ARC", "Other Financial Entities")),
        ("other", "Phoenix ARC Limited", None, ("NBFC", "Other NBFCs")),
    ],
)
def test_categories(spark, source, name, classification, want):
    c = clean.reporting_category(F.lit(source), F.lit("NBFC"), F.lit("Other NBFCs"), F.lit(name), F.lit(classification).cast("string"))
    assert tuple(spark.range(1).select(c.alias("c")).first().c) == want


def test_priority(spark):
    rows = [
        (1, "Niwas Housing Finance Private Limited", "HFCs", "Housing Finance Companies", "rbi_nbfc", "Active"),
        (2, "NIWAS HOUSING FINANCE PVT LTD", "CA-Insurer-List", "Other Financial Entities", "irdai_ca_insurer", "Active"),
        (3, "Supreme Securities Limited,", "NBFC", "Other NBFCs", "rbi_nbfc_cancelled", "Cancelled"),
        (4, "Supreme Securities Limited", "PSS Surrender/Cancelled", "Other Financial Entities", "rbi_pss_surrendered", "Surrendered"),
    ]
    h = spark.createDataFrame(rows, "ord long, name string, category_regulator string, category_return string, source_key string, status string").withColumn("regulator", F.lit("R"))
    got = {r.name[:5]: r for r in resolve.resolve(h, entities.entity_keys(h)).collect()}
    assert len(got) == 2 and (got["Niwas"].category, got["Niwas"].category_return, got["Supre"].status) == ("HFCs", "Housing Finance Companies", "Cancelled")


def test_renames(spark):
    one = lambda source, n: spark.range(1).select(clean.override_name(F.lit(source), F.lit(n), clean.OVERRIDES)).first()[0]
    old = "Standard Chartered Investments & Loans (India) Limited"
    assert one("rbi_nbfc", old) == f"Standard Chartered Capital Limited (Formerly: {old})" and one("sebi_broker_equity", old) == old and one("rbi_nbfc", "Other Co Limited") == "Other Co Limited"


def test_dates_and_headers_are_no_names(spark):
    html = "<table><tr><td>Sr. No.</td><td>Name of the Company</td><td>CoR No.</td><td>CoR restored on</td></tr><tr><td>1</td><td>Goli Finance Limited</td><td>B-13.01</td><td>31-Jul-26</td></tr></table><table><tr><td>July 09,1998</td></tr><tr><td>Express Fincap House Private Limited</td></tr><tr><td>31-Jul-26</td></tr><tr><td>CoR restored on</td></tr><tr><td>Cancellation Order Date</td></tr></table>"
    r = spark.createDataFrame([(html, 1)], "html string, expected_count int")
    assert documents.with_release_names(r).first().names == ["Goli Finance Limited"]


def test_payment_names_of_tabbed_rows(spark):
    text = """A. Certificates of Authorisation issued to Payment System Operators
1.\tBank of India\tBank of India, Star House, Mumbai
2.\tPunjab National Bank\tPunjab National Bank, 7 Bhikaji Cama Place
3.\tRazorpay Payments Private Limited (formerly Razorpay Software Private Limited)\tPA
4.\tRazorpay Payments Private Limited\tPPI
5.\tCSC e – Governance Services India Ltd
6.\tCSC e-Governance Services India Limited
B. Certificates of Authorisation Revoked"""
    got = [r.name for r in sections.payment_entities(spark.createDataFrame([("d", text)], "doc_id string, text string"), "operating").orderBy("pos").collect()]
    assert got[:3] == ["Bank of India", "Punjab National Bank", "Razorpay Payments Private Limited (formerly Razorpay Software Private Limited)"] and len(got) == 4


def test_hub_ids(spark):
    hub = [("2", "Stock Brokers - Commodity Derivative", 2018), ("21", "Venture Capital Funds", 149), ("33", "Portfolio Managers", 504), ("34", "Foreign Portfolio Investors", 9)]
    brokers = [("5", "Stock Brokers A", 1), ("6", "Stock Brokers B", 2), ("7", "Other", 3)]

    def one(id_, hint, rows):
        s = spark.createDataFrame([("s", id_, hint)], "source_key string, intm_id string, label_hint string")
        r = ingest.hub_ids(s, spark.createDataFrame(rows, "intm_id string, label string, expected_count int")).first()
        return r.intm_id, r.expected_count, r.changed_from, r.warning is not None

    assert one("33", r"portfolio\s+manager", hub) == ("33", 504, None, False)
    assert one("34", r"^portfolio\s+manager", hub) == ("33", 504, "34", True)
    assert one("34", None, hub)[::3] == ("34", False) and one("34", "portfolio", [])[::3] == ("34", False)
    assert one("7", "stock brokers", brokers)[::3] == ("7", True)
    ids = spark.createDataFrame([(h,) for h in ("a?intmId=2", "a?intmId=21", "a?intmId=9&x=1", "a?intmId=90", "a")], "h string").select(clean.link_id(F.col("h"))).collect()
    assert [r[0] for r in ids] == ["2", "21", "9", "90", None]
