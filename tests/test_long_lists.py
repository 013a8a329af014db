"""Lists of more entries than three digits count, and longer than any page was; the work on them grows with their length alone."""

import time

from pyspark.sql import functions as F

from ledgerloom.functions import documents
from ledgerloom.operators import columns, sections
from ledgerloom.sources import markup, staged


def _name(i: int) -> str:
    return "Bank" + "".join(chr(65 + int(d)) for d in f"{i:05d}")


def _one(spark, text: str):
    return spark.createDataFrame([(1, text)], "doc_id int, text string")


def test_numbers_of_four_digits():
    text = "\n".join(f"{i}. {_name(i)} Ltd. Plot 2024. Sector" for i in range(1, 1203))
    got = markup.numbered_entries(text)
    assert len(got) == 1202 and got[-1] == f"{_name(1202)} Ltd. Plot 2024. Sector"
    assert markup.numbered_entries("1. A 1001. B 2. C") == ["A 1001. B ", "C"]


def test_payment_section_of_four_digits(spark):
    text = "A. Certificates of Authorisation issued by the bank to set up and operate payment systems in India\n" + "\n".join(f"{i}.\t{_name(i)} Software Pvt Ltd\tPrepaid" for i in range(1, 1203)) + "\nB. Certificates of Authorisation Revoked\n1. Foo Ltd"
    got = sections.payment_entities(_one(spark, text), "operating").orderBy("pos").collect()
    assert [r["name"] for r in got] == [f"{_name(i)} Software Pvt Ltd" for i in range(1, 1203)]


def test_prose_of_four_digits(spark):
    text = "Since 2024. these: " + " ".join(f"{i}. {_name(i)} Finance Limited" for i in range(1, 1203))
    assert _one(spark, text).select(documents.prose_names(F.col("text")).alias("n")).first()["n"] == [f"{_name(i)} Finance Limited" for i in range(1, 1203)]


def test_bank_lists_beyond_a_page(spark):
    rural = "Regional Rural Banks Sr.No " + " ".join(f"{i}. {_name(i)} Gramin Bank" for i in range(1, 1203)) + " and 7. Far Bank"
    got = sections.bank_section(_one(spark, rural), "rrb").first()["names"]
    assert len(got) == 1202 and got[-1].startswith(f"{_name(1202)} Gramin Bank")
    foreign = "Foreign banks in India\nSr.No\n" + "\n".join(f"{i}. {_name(i)} Bank PLC 41 Liberty Building, No. 99. Sector" for i in range(1, 1203))
    assert sections.bank_section(_one(spark, foreign), "foreign").first()["names"] == [f"{_name(i)} Bank PLC" for i in range(1, 1203)]


def test_local_area_banks_once_each(spark):
    text = "\n".join(f"{_name(i % 3000)} Local Area Bank {'Ltd' if i < 3000 else 'Limited'}" for i in range(6000))
    began = time.time()
    assert _one(spark, text).select(sections.local_area_banks(F.col("text")).alias("n")).first()["n"] == [f"{_name(i)} Local Area Bank Ltd" for i in range(3000)]
    assert time.time() - began < 30


def test_long_table(spark):
    rows = [(1, 0, 0, ["Sl. No", "Name"])] + [(1, 0, i, [str(i), f"{_name(i)} Ltd"]) for i in range(1, 12001)]
    d = spark.createDataFrame(rows, "doc_id int, table_ix int, row_ix int, cells array<string>")
    began = time.time()
    assert columns.table_names(d).agg(F.count("*"), F.sum("row_ix")).first() == (12000, 12000 * 12001 // 2)
    assert time.time() - began < 30


def test_long_csv(spark):
    text = "Sr,Full Name\n" + "\n".join(f'{i},"{_name(i)}, Ltd"' for i in range(8000))
    began = time.time()
    assert _one(spark, text).select(staged.csv_names(F.col("text")).alias("n")).first()["n"] == [f"{_name(i)}, Ltd" for i in range(8000)]
    assert time.time() - began < 30


def test_state_coop_banks_of_four_digits(spark):
    text = "State Co-operative Banks\n" + "\n".join(f"{i}. {_name(i)} State Co-op Bank Ltd. Plot 5" for i in range(1, 1203))
    assert sections.state_coop_banks(_one(spark, text), ["nowhere"]).first()["scheduled"] == [f"{_name(i)} State Co-op Bank Ltd." for i in range(1, 1203)]
