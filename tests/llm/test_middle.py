"""Fill-in-middle against plain Python, and the exact way back."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import middle

ROWS = [
    *[(i, "\n".join(f"line {j} of {i} é😀" for j in range(i % 7)) + ("\n" if i % 2 else "")) for i in range(60)],
    (100, None), (101, ""), (102, "holds <S> a mark"), (103, "\n\n\n"), (104, "one < unit"), (105, "seam <\nS> and <P\n>M"), (None, "no id\nat all"), (None, None), (-5, "negative\nid"),
    (106, "x\n" * 20_000), *[(107, "same\nrow\nthrice")] * 3, (107, "same id\nother text"),
]


def _expected(doc_id, text, rate, spm):
    t = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", t)
    n = len(units)
    digest = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not t or any(m in t for m in middle.Marks()) or h[2] % 100 >= rate:
        return (str(doc_id), n, "plain", None, None, t)
    p, m, s = "".join(units[:low]), "".join(units[low:high]), "".join(units[high:])
    if h[3] % 100 < spm:
        return (str(doc_id), n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}")
    return (str(doc_id), n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}")


@pytest.mark.parametrize("rate,spm", [(100, 50), (60, 0), (90, 100), (0, 50)])
def test_middle(spark, rate, spm):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string").repartition(5).select("*", F.lit(1).alias("n"), F.lit("x").alias("form"), F.lit(0).alias("k1"))
    got = middle.fill_in_middle(docs, rate=rate, spm=spm).withColumn("back", middle.restore(F.col("output"), F.col("form"))).collect()
    assert sorted(map(str, ((str(r.doc_id), r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in got))) == sorted(map(str, (_expected(i, t, rate, spm) for i, t in ROWS)))
    assert all(r.back == r.text for r in got)
    assert rate == 0 or {r.form for r in got} >= {"plain", "spm" if spm else "psm"}


def test_other_units(spark):
    """Words as units: cuts lie between words, and the text comes back."""
    docs = spark.createDataFrame([(i, "a bc  def\n g " * (i + 1)) for i in range(40)], "doc_id long, text string")
    got = middle.fill_in_middle(docs, unit=r"\s*\S+|\s+").withColumn("back", middle.restore(F.col("output"), F.col("form"))).collect()
    assert all(r.back == r.text and r.n == len(re.findall(r"\s*\S+|\s+", r.text)) for r in got)
    ends = {r.doc_id: {0, *[m.end() for m in re.finditer(r"\s*\S+|\s+", r.text)]} for r in got}
    assert all(r.prefix_chars in ends[r.doc_id] and r.prefix_chars + r.middle_chars in ends[r.doc_id] for r in got)


def test_empty_table(spark):
    assert middle.fill_in_middle(spark.createDataFrame([], "doc_id long, text string")).collect() == []
