"""Golden values of the name functions, entity links, and every registered query against its SQL."""

import glob
import os

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from ledgerloom.functions import names as N
from ledgerloom.operators import entities, resolve, status
from ledgerloom.plans import pages, registered, registers

SF = "/root/testdata/sf0.001"
QUERIES, ORACLE = {**registered.QUERIES, **registers.QUERIES, **pages.QUERIES}, {**registered.ORACLE, **registers.ORACLE, **pages.ORACLE}


def one(spark, f, *values):
    return [r[1] for r in spark.createDataFrame(list(enumerate(values)), "i int, v string").select("i", f(F.col("v"))).orderBy("i").collect()]


def test_keys(spark):
    got = one(spark, N.canonical_key, "ABC Finance (P) Ltd", "M/s The Mukesh Trade &Finance Pvt Ltd", "MeltronVincom Pvt Ltd", "Trafin’s C.G. Finance Limited", "SBM Bank (India) Limited", None)
    assert got == ["ABCFINANCEPVTLTD", "MUKESHTRADEANDFINANCEPVTLTD", "MELTRONVINCOMPVTLTD", "TRAFINSCGFINANCELTD", "SBMBANKINDIALTD", ""]
    assert one(spark, N.normalize_name, "ABC Finance Pvt.Ltd.") == ["ABC FINANCE PVTLTD"]
    assert one(spark, N.repair_legal_form, "A Limied", "B Limitd", "C Privat", "Unlimited", "Lttd") == ["A LIMITED", "B LIMITED", "C PRIVATE", "Unlimited", "Lttd"]


def test_annotations(spark):
    got = one(spark, N.split_annotations, "Balasaria Holdings Private Limited (Name as per MCA - BRBS Holdings Private Limited)", "Matrix X Limited (Name as per MCA - Matrix InfraPro Finance Limited", "ABC Limited (in liquidation)", "SBM Bank (India) Limited")
    assert [(r.primary, list(r.aliases)) for r in got] == [("Balasaria Holdings Private Limited", ["BRBS Holdings Private Limited"]), ("Matrix X Limited", ["Matrix InfraPro Finance Limited"]), ("ABC Limited", []), ("SBM Bank (India) Limited", [])]
    r = one(spark, N.entity_names, "New Co Ltd formerly known as Old Co Ltd")[0]
    assert (r.primary, list(r.aliases)) == ("New Co Ltd", ["Old Co Ltd"])


def test_dates(spark):
    assert [str(x) for x in one(spark, N.master_list_date, "List as on March 5, 2024", "as of 5 March 2024", "none")] == ["2024-03-05", "2024-03-05", "None"]


def test_entities(spark):
    names = ["Alpha Ltd (Formerly known as Beta Ltd)", "BETA LIMITED", "Gamma Ltd", "Kotak Mahindra Prime Finance Ltd", "Kotak Mahindra Prome Finance Ltd", "Kotak Mahindra 1 Prime Finance Ltd", "Kotak Mahindra 2 Prime Finance Ltd"]
    k = {r.name: r.entity_key for r in entities.entity_keys(spark.createDataFrame([(n,) for n in names], "name string")).collect()}
    assert k[names[0]] == k[names[1]] != k[names[2]] and k[names[3]] == k[names[4]] and len(set(k.values())) == 5


def test_ranks(spark):
    assert one(spark, resolve.category_rank, "Private Sector Banks in India", "ICC", "", "HFC", "NBFC-MFI", "Life Insurance Companies", None) == [2, 8, 1, 7, 8, 999, 1]


def test_cascade(spark):
    m = spark.createDataFrame([(1, "ABC Finance Private Limited", "Active"), (2, "New Name Ltd (formerly Old Name Ltd)", "Active"), (3, "Karnataka Finance Corporation Ltd", "Active")], "ord long, name string, status string")
    d = spark.createDataFrame([(1, "ABC FINANCE PVT LTD", "Cancelled", "2024-01-01"), (2, "Old Name Ltd", "Suspended", "2024-01-02"), (3, "Karnatika Finance Corporation Ltd", "Cancelled", "2024-01-01"), (4, "M/s ABC Finance (P) Ltd", "Restored", "2024-02-01"), (5, "Nobody", "Cancelled", "2024-01-01")], "ord long, entity_name string, action string, effective_date string").withColumn("effective_date", F.to_date("effective_date"))
    mk = m.withColumn("master_key", N.normalize_name(F.col("name")))
    assert {r.delta_ord: r.tier for r in status.match(mk, d).collect()} == {1: 1, 2: 4, 3: 5, 4: 2}
    assert {r.name[:3]: r.final_status for r in status.reconcile(m, d).collect()} == {"ABC": "Active", "New": "Suspended", "Kar": "Cancelled"} and [r.ord for r in status.unmatched(m, d).collect()] == [5]


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, name):
    folder = SF if name not in pages.QUERIES else "/root/testdata/sf0.01"  # of ten suppliers there are too few to a nation
    got = QUERIES[name](spark, folder).toPandas()
    assert len(got) and name in E.queries()
    if name in ORACLE:
        c = duckdb.connect()
        for f in glob.glob(f"{folder}/*.parquet"):
            c.sql(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
        want = c.sql(ORACLE[name]).df()
        assert set(want.columns) == set(got.columns)
        cols = list(want.columns)
        days = ("effective_date", "stated", "month", "day")
        text = lambda c, x: "" if pd.isna(x) else str(x)[:10] if c in days else str(int(x)) if isinstance(x, float) else str(x)
        norm = lambda d: sorted([text(c, x) for c, x in zip(cols, r)] for r in d[cols].astype(object).values.tolist())
        assert norm(want) == norm(got)
