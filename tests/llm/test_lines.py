"""Line dedup against plain Python, on nulls, empties, repeats, clashing columns and a line that all documents share."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import lines

WHITE = " \t\n\x0b\x0c\r"


def _key(line):
    return line.encode().lower().decode().strip(WHITE)


def _expected(rows, least, chars):
    split = [(i, (t or "").split("\n")) for i, t in rows]
    seen = Counter(k for _, ls in split for k in {_key(x) for x in ls} if len(k) >= chars)
    gone = {k for k, n in seen.items() if n >= least}
    return sorted((str(i), len(ls), sum(_key(x) in gone for x in ls), "\n".join(x for x in ls if _key(x) not in gone)) for i, ls in split)


ROWS = [
    *[(i, f"Shared LINE \nown {i}\n\n  shared line\x0b\ntail É{i % 3}") for i in range(12)],
    *[(100 + i, f"É\nform feed\x0c{i}\r\nSHARED line") for i in range(12)],
    (200, None), (201, ""), (None, "shared line"), (None, "shared line"), (202, "shared line"), (202, "another"), (203, "\n\n"), (204, " \t \n é\n"),
    (205, "long " * 5000 + "\n" + "shared line\n" * 3000 + "end"), *[(300, "repeat me\nand me")] * 4,
]


@pytest.mark.parametrize("least,chars", [(10, 1), (2, 1), (3, 4), (1, 1)])
def test_lines(spark, least, chars):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string").repartition(5).select("*", F.lit(1).alias("lines"), F.lit(2).alias("k1"), F.lit("x").alias("key"))
    got = sorted((str(r.doc_id), r.n_lines, r.n_dropped, r.kept) for r in lines.drop_common_lines(docs, least, chars).collect())
    assert got == _expected(ROWS, least, chars)


def test_hot_keys_by_shuffle(spark, monkeypatch):
    """The same rows where no key is common enough for the broadcast, and where that is not taken."""
    docs = spark.createDataFrame(ROWS, "doc_id long, text string")
    monkeypatch.setattr(lines, "small", lambda df: df)
    got = sorted((str(r.doc_id), r.n_lines, r.n_dropped, r.kept) for r in lines.drop_common_lines(docs, 3).collect())
    assert got == _expected(ROWS, 3, 1)
    many = ROWS + [(1000 + i, f"plain {i}") for i in range(11_000)]
    docs = spark.createDataFrame(many, "doc_id long, text string")
    got = sorted((str(r.doc_id), r.n_lines, r.n_dropped, r.kept) for r in lines.drop_common_lines(docs, 3).collect())
    assert got == _expected(many, 3, 1)


def test_empty_table(spark):
    assert lines.drop_common_lines(spark.createDataFrame([], "doc_id long, text string")).collect() == []
