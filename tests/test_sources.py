"""The parse store, the data source over staged files, and the table functions."""

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import tabular
from ledgerloom.sources import parsed, registers

FILES = "source_key string, path string, content binary"
HTML = [("a", "a/1.html", b"<table><tr><td>No</td><td>Name</td></tr><tr><td>1</td><td>X Ltd</td></tr></table>"), ("a", "a/2.html", b"<p>two <a href='l'>link</a></p>"), ("b", "b/1.html", b"<p>two <a href='l'>link</a></p>"), ("b", "b/2.html", b""), ("c", "c/1.html", None)]


def test_parsed_once(spark, tmp_path):
    calls = spark.sparkContext.accumulator(0)

    def count(content):
        calls.add(1)
        return parsed.PAGE.parse(content)

    parser, store = parsed.PAGE._replace(parse=count), str(tmp_path / "store")
    files = spark.createDataFrame(HTML, FILES)
    got = parsed.parse(files, store, parser)
    rows = {r.path: r for r in got.files.collect()}
    assert got.n_parsed == calls.value == 3 and len(rows) == 5 and all(r.now for r in rows.values())
    assert [[c.cells for c in t] for t in rows["a/1.html"].out.tables] == [[["No", "Name"], ["1", "X Ltd"]]]
    assert rows["b/1.html"].out.links[0].href == "l" and rows["c/1.html"].out.text == "" and rows["a/2.html"].bytes == len(HTML[1][2])
    e = {r.source_key: r for r in parsed.effort(got.files, files).collect()}
    assert (e["a"].files, e["a"].parsed_files, e["b"].parsed_files, e["c"].parsed_files) == (2, 2, 1, 0) and e["a"].ms > 0
    again = parsed.parse(files, store, parser)
    assert again.n_parsed == 0 and calls.value == 3 and not any(r.now for r in again.files.collect())
    more = parsed.parse(files.union(spark.createDataFrame([("d", "d/1.html", b"<p>new</p>")], FILES)), store, parser)
    assert more.n_parsed == 1 and calls.value == 4 and more.files.count() == 6
    assert parsed.parse(files, store, parser._replace(version=2)).n_parsed == 3
    assert parsed.parse(files.limit(0), store, parser).files.collect() == []


def test_data_source(spark, tmp_path):
    folder = str(tmp_path / "raw")
    rows = [(f"s{k}", f"{u}-{p}.html", f"{k}{u}{p}".encode()) for k in range(3) for u in range(2) for p in range(5)] + [("s0", "list.pdf", b"%PDF")]
    registers.write_files(spark.createDataFrame(rows, "source_key string, file string, content binary"), folder)
    registers.register(spark)
    load = lambda **o: spark.read.format("registers").options(**o).load(folder)
    assert sorted((r.source_key, r.file, bytes(r.content)) for r in load().collect()) == sorted(rows)
    one = load(filesPerPartition=2).filter("source_key = 's1' and url_ix = 1 and page_ix < 4")
    assert sorted(bytes(r.content) for r in one.collect()) == [b"110", b"111", b"112", b"113"] and one.rdd.getNumPartitions() == 2
    assert load(contents="false").agg(F.sum("size"), F.count("content")).first()[:] == (30 * 3 + 4, 0)
    assert [r.file for r in load().filter("url_ix is null").collect()] == ["list.pdf"] and load().filter("source_key = 'none'").count() == 0
    (tmp_path / "raw" / "s2").chmod(0o700)
    reader = registers.RegisterReader({"path": folder})
    left = list(reader.pushFilters([registers.EqualTo(("source_key",), "s2"), registers.GreaterThan(("size",), 1)]))
    assert len(left) == 1 and {p.source_key for p in reader.partitions()} == {"s2"}


def _walk(spark, pages, **args):
    tabular.register(spark)
    spark.createDataFrame(pages, "source_key string, page_ix int, keys array<string>, sig string, target int").createOrReplaceTempView("walk")
    got = spark.sql(f"select source_key, page_ix, n_new, reason from walk_pages(table(walk), {args.get('most', 260)}, {args.get('streak', 3)})")
    return sorted(map(tuple, got.collect()), key=str)


def test_walk_from_sql(spark):
    page = lambda s, i, keys, target=None: (s, i, keys, ",".join(keys), target)
    pages = [page("t", 1, ["a", "b"], 3), page("t", 2, ["c"], 3), page("t", 3, ["d"], 3)]
    pages += [page("r", 1, ["a"]), page("r", 2, ["b"]), page("r", 3, ["a"]), page("r", 4, ["z"])]
    pages += [page("d", 1, ["a", "b", "c", "d"])] + [page("d", i, ["abcd"[i - 2]]) for i in (2, 3, 4, 5)]
    pages += [page("c", i, [f"k{i}"]) for i in range(1, 7)] + [page("e", 1, [])]
    assert _walk(spark, pages, most=5) == sorted(
        [("t", 1, 2, None), ("t", 2, 1, "target"), ("r", 1, 1, None), ("r", 2, 1, "repeated page"), ("d", 1, 4, None), ("d", 2, 0, None), ("d", 3, 0, None), ("d", 4, 0, "no new names"), *[("c", i, 1, "cap" if i == 5 else None) for i in range(1, 6)], ("e", 1, 0, None)], key=str
    )
    with pytest.raises(Exception, match="lacks sig"):
        spark.sql("select * from walk_pages(table(select 's' as source_key, 1 as page_ix, array('a') as keys, 1 as target), 5, 3)").collect()


@pytest.mark.parametrize("restart", [False, True])
def test_sequence(spark, restart):
    tabular.register(spark)
    numbers = [2, 7, 3, 5, 5, 1, 2, 6, None, 8]
    spark.createDataFrame([("d", i, n) for i, n in enumerate(numbers)] + [("e", 0, 9)], "doc_id string, pos int, number int").createOrReplaceTempView("marks")
    got = spark.sql(f"select number from in_sequence(table(marks), {str(restart).lower()}) order by pos").collect()
    assert [r.number for r in got] == ([2, 3, 5, 1, 2] if restart else [2, 3, 5, 6, 8])


def test_parse_holds_few_results(spark):
    class Counted(str):
        living = 0

        def __new__(cls, text):
            cls.living += 1
            return super().__new__(cls, text)

        def __del__(self):
            type(self).living -= 1

    few = parsed.Parser("few", 1, "string", lambda content: Counted(Counted.living))
    got = spark.range(0, 1000, 1, 1).select(few.on(F.concat(F.lit(b""), F.col("id").cast("string").cast("binary"))).alias("p")).select("p.out").collect()
    assert len(got) == 1000 and max(int(r["out"]) for r in got) < 3 * parsed.AT_ONCE
