"""Rows equal in all columns draw on their own: a source of one row many times comes near its target, alike at every run."""

from pyspark.sql import functions as F

from ledgerloom.llm import mixing, sharding


def test_equal_rows_come_near_their_target(spark):
    rows = [(1, "a b c", "s1")] * 10_000 + [(i, f"w{i} x", "s2") for i in range(5000)] + [(None, None, None)] * 50
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(6)
    got = mixing.mix(docs)
    sums = got.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("taken"), F.max("target").alias("target")).collect()
    assert got.count() == len(rows) and all(abs(r.taken - r.target) <= 0.03 * r.target for r in sums)
    key = lambda d: sorted(map(str, d.collect()))
    assert key(got) == key(mixing.mix(docs.repartition(3)))


def test_null_ids_spread_over_shards(spark):
    docs = spark.createDataFrame([(None, f"text {i}") for i in range(400)] + [(None, None)], "doc_id long, text string")
    got = sharding.place(docs, [f"s{i}" for i in range(8)])
    assert got.count() == 401 and got.select("shard").distinct().count() == 8
