"""Phrase collocation mining on vertical positional inverted lists.

Documents lie in blocks of one language. A block knows a word by its number and holds, in place of text, the positions of its words;
phrases are extended within their block, by joining where they end with the postings of the words behind. What leaves a block is the length
of its lists: the lengths' sum over all blocks is the phrase's exact frequency, and frequent phrases alone return to be extended.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import durable, shared_dir

BREAKS = ".,;:!?\n\x0b\x0c\r"
_TABLE = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t" + BREAKS.encode(), b"abcdefghijklmnopqrstuvwxyz " + b"\n" * len(BREAKS))
_BLOCK = pa.schema([("block", pa.int64()), ("lang", pa.string()), ("n_words", pa.int64()), ("words", pa.list_(pa.string())), ("counts", pa.list_(pa.int32())), ("places", pa.binary())])
#: Bits of a word's place: the partition's number takes what these leave of 63. Beyond them blocks fail aloud.
BLOCK_BITS, WORD_BITS = 14, 24


def _packed(codes: np.ndarray) -> bytes:
    return pa.compress(np.ascontiguousarray(codes.astype("<i4").view(np.uint8).reshape(-1, 4).T).tobytes(), codec="zstd", asbytes=True)


def _unpacked(data: bytes, n: int) -> np.ndarray:
    raw = np.frombuffer(pa.decompress(data, 4 * n, codec="zstd"), np.uint8)
    return np.ascontiguousarray(raw.reshape(4, n).T).view("<i4").ravel()


def block_of(texts: list[bytes]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Words in order, their counts, and the word at each position; -1 stands between pieces."""
    stream = b"\n".join(texts).replace(b"\n", b" \n ").decode()
    told = pc.split_pattern(pa.array([stream], pa.large_string()), " ").flatten().dictionary_encode()
    words = told.dictionary.cast(pa.string())
    order = pc.array_sort_indices(words).to_numpy()
    kept = order[~np.isin(order, [pc.index(words, "").as_py(), pc.index(words, "\n").as_py()])]
    new = np.full(len(words), -2, np.int32)
    new[kept] = np.arange(len(kept), dtype=np.int32)
    if (brk := pc.index(words, "\n").as_py()) >= 0:
        new[brk] = -1
    codes = new[told.indices.to_numpy()]
    codes = codes[codes != -2]
    codes = codes[(codes >= 0) | (np.r_[0, codes[:-1]] >= 0)]
    return words.take(pa.array(kept)), np.bincount(codes[codes >= 0], minlength=len(kept)).astype(np.int32), codes


def _blocks(block_bytes: int):
    def run(batches):
        held: dict[str, list[bytes]] = {}
        size: dict[str, int] = {}
        at = TaskContext.get().partitionId() << BLOCK_BITS
        end = at + (1 << BLOCK_BITS)

        def flush(lang):
            nonlocal at
            words, counts, codes = block_of(held.pop(lang))
            size.pop(lang)
            if at == end or len(words) >> WORD_BITS:
                raise ValueError("a partition of too many blocks, or a text of too many unlike words")
            row = (at, lang, int(counts.sum()), words, counts, len(codes).to_bytes(8, "little") + _packed(codes))
            at += 1
            return pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(row, _BLOCK)], schema=_BLOCK)

        for b in batches:
            for lang, text in zip(b.column(0).to_pylist(), b.column(1)):
                raw = text.as_py().encode().translate(_TABLE)
                held.setdefault(lang, []).append(raw)
                size[lang] = size.get(lang, 0) + len(raw)
                if sum(size.values()) >= block_bytes:
                    yield flush(max(size, key=size.get))
        for lang in list(held):
            yield flush(lang)

    return run


def extend(ends: np.ndarray, phrases: np.ndarray, postings: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Phrases, the word behind, and its position, where a phrase's end and a posting are neighbours. Both are in order of position."""
    if not len(postings):
        return phrases[:0], words[:0], postings[:0]
    at = np.minimum(np.searchsorted(postings, ends + 1), len(postings) - 1)
    met = postings[at] == ends + 1
    return phrases[met], words[at[met]], postings[at[met]]


class _Block:
    """Postings of a block's frequent words, by their place in the order of global ids; right rows of kind 0 are (number, id)."""

    def __init__(self, left: pa.Table, right: pa.Table):
        data = left.column("places")[0].as_py()
        codes = _unpacked(data[8:], int.from_bytes(data[:8], "little"))
        kind, a, b = (right.column(c).to_numpy() for c in ("kind", "a", "b"))
        number, ids = a[kind == 0], b[kind == 0]
        order = np.argsort(ids)
        self.ids = ids[order]
        known = np.full(max(int(codes.max(initial=-1)), int(number.max(initial=-1))) + 2, -1, np.int64)
        known[number[order]] = np.arange(len(order))
        words = np.where(codes >= 0, known[codes], -1)
        self.at = np.flatnonzero(words >= 0)
        self.words = words[self.at]
        first, second = a[kind == 1], b[kind == 1]
        self.pairs = np.sort(np.searchsorted(self.ids, first) * len(self.ids) + np.searchsorted(self.ids, second))

    def two(self) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of frequent words, each as one number, and where they end."""
        first, second, end = extend(self.at, self.words, self.at, self.words)
        return first * len(self.ids) + second, end


def _count_pairs(left: pa.Table, right: pa.Table) -> pa.Table:
    if not left.num_rows or not right.num_rows:
        return _PAIRS.empty_table()
    b = _Block(left, right)
    pairs, n = np.unique(b.two()[0], return_counts=True)
    m = max(1, len(b.ids))
    return pa.table([np.full(len(n), left.column("block")[0].as_py()), b.ids[pairs // m], b.ids[pairs % m], n], schema=_PAIRS)


def _count_triples(left: pa.Table, right: pa.Table) -> pa.Table:
    if not left.num_rows or not right.num_rows:
        return _TRIPLES.empty_table()
    b = _Block(left, right)
    pairs, ends = b.two()
    at = np.searchsorted(b.pairs, pairs)
    known = b.pairs[np.minimum(at, len(b.pairs) - 1)] == pairs if len(b.pairs) else np.zeros(len(pairs), bool)
    at, ends = at[known], ends[known]
    front, back, _ = extend(ends, at, ends, at)
    triples, n = np.unique(front * max(1, len(b.pairs)) + back, return_counts=True)
    m, k = max(1, len(b.ids)), max(1, len(b.pairs))
    head, tail = b.pairs[triples // k], b.pairs[triples % k]
    return pa.table([b.ids[head // m], b.ids[head % m], b.ids[tail % m], n], schema=_TRIPLES)


_PAIRS = pa.schema([(c, pa.int64()) for c in ("block", "a", "b", "n")])
_TRIPLES = pa.schema([(c, pa.int64()) for c in ("a", "b", "c", "n")])


def _ddl(schema: pa.Schema) -> str:
    return ", ".join(f"{c} long" for c in schema.names)


def _meet(blocks: DataFrame, told: DataFrame, count, schema: pa.Schema) -> DataFrame:
    """Each block with what is told to it, (block, kind, a, b)."""
    return blocks.select("block", "places").groupBy("block").cogroup(told.groupBy("block")).applyInArrow(count, _ddl(schema))


def _scored(cuts: list[tuple[str, str]]) -> F.Column:
    """The lowest-scoring cut of a phrase, ties to the first: floor(1000000 a a / (l r)) in 38 digits; a, l and r are below 10**15."""
    big = lambda c: f"cast({c} as decimal(15,0))"
    one = [f"named_struct('score', cast(cast(1000000 as decimal(7,0)) * ({big('a')} * {big('a')}) as decimal(38,0)) div ({big(l)} * {big(r)}), 'k', {k}, 'l', {l}, 'r', {r})" for k, (l, r) in enumerate(cuts, 1)]
    return F.array_min(F.expr(f"array({', '.join(one)})"))


def collocations(docs: DataFrame, least: int = 10, top: int = 2000, inside: int = 50, block_bytes: int = 4 << 20) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's best `top` phrases of two and three words that occur `least` times or more.

    A phrase within a longer one that holds `inside` % of its occurrences goes. A block holds `block_bytes` of text and one document
    more at most, whatever its language; a word or pair is one row a block, so the rows of a hot one grow with the blocks and not with its
    occurrences. Null text: no words. Null lang: und. Null or repeated doc_ids: each row counts. Ties: a descending, then the phrase in byte
    order, which is unlike for all. Long texts are whole. Empty table, or no phrase often enough: no rows. Other columns of docs are not read.
    """
    spark = docs.sparkSession
    base = f"{shared_dir(spark)}/phrases-{uuid.uuid4().hex}"

    def kept(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{base}/{name}")
        return spark.read.schema(df.schema).parquet(f"{base}/{name}")

    text = docs.filter("text <> ''").select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    blocks = kept(text.mapInArrow(_blocks(block_bytes), "block long, lang string, n_words long, words array<string>, counts array<int>, places binary"), "blocks")
    # words: one is named by its first place
    every = blocks.select("block", "lang", F.posexplode(F.arrays_zip("words", "counts")).alias("number", "w")).select("block", "lang", "number", F.col("w.words").alias("word"), F.col("w.counts").alias("n"))
    every = every.withColumn("place", F.shiftleft("block", WORD_BITS).bitwiseOR(F.col("number")))
    same = Window.partitionBy("lang", "word")
    every = every.select("block", "number", "place", "lang", "word", F.sum("n").over(same).alias("f"), F.min("place").over(same).alias("id")).filter(F.col("f") >= least)
    own = F.col("place") == F.col("id")
    known = kept(every.select("block", "number", "id", "f", F.when(own, F.col("lang")).alias("lang"), F.when(own, F.col("word")).alias("word")), "words")
    words = known.filter("word is not null").select("id", "lang", "word", "f")
    told = known.select("block", F.lit(0).alias("kind"), F.col("number").cast("long").alias("a"), F.col("id").alias("b"))
    # pairs
    same = Window.partitionBy("a", "b")
    pairs = _meet(blocks, told, _count_pairs, _PAIRS)
    pairs = kept(pairs.select("block", "a", "b", F.sum("n").over(same).alias("f"), F.min("block").over(same).alias("first")).filter(F.col("f") >= least), "pairs")
    # triples
    triples = _meet(blocks, told.union(pairs.select("block", F.lit(1), "a", "b")), _count_triples, _TRIPLES)
    triples = triples.groupBy("a", "b", "c").agg(F.sum("n").alias("f")).filter(F.col("f") >= least)
    # scores
    w = lambda i: words.select(F.col("id").alias(i), F.col("word").alias(f"w_{i}"), F.col("f").alias(f"f_{i}"))
    two = kept(pairs.filter("block = first").select("a", "b", F.col("f").alias("f_ab")).join(words.select(F.col("id").alias("a"), "lang", F.col("word").alias("w_a"), F.col("f").alias("f_a")), "a").join(w("b"), "b"), "two")
    back = two.select(F.col("a").alias("b"), F.col("b").alias("c"), F.col("f_ab").alias("f_bc"), F.col("w_b").alias("w_c"), F.col("f_b").alias("f_c"))
    three = kept(triples.join(two, ["a", "b"]).join(back, ["b", "c"]), "three")
    longer = three.select("a", "b", "f").union(three.select("b", "c", "f")).groupBy("a", "b").agg(F.max("f").alias("longer"))
    first = two.join(longer, ["a", "b"], "left").filter(f"longer is null or 100 * longer < {inside} * f_ab")
    first = first.select("lang", F.concat_ws(" ", "w_a", "w_b").alias("phrase"), F.col("f_ab").alias("a"), F.col("f_a").alias("l1"), F.col("f_b").alias("r1")).withColumn("cut", _scored([("l1", "r1")]))
    then = three.select("lang", F.concat_ws(" ", "w_a", "w_b", "w_c").alias("phrase"), F.col("f").alias("a"), F.col("f_a").alias("l1"), F.col("f_bc").alias("r1"), F.col("f_ab").alias("l2"), F.col("f_c").alias("r2"))
    then = then.withColumn("cut", _scored([("l1", "r1"), ("l2", "r2")]))
    found = first.select("lang", "phrase", "a", "cut").union(then.select("lang", "phrase", "a", "cut")).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    # the best of each of many parts of a language, then the best of these
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(64))
    found = found.withColumn("part", part).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).filter(F.col("rank") <= top)
    found = found.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).filter(F.col("rank") <= top)
    total = blocks.groupBy("lang").agg(F.sum("n_words").alias("n"))
    out = durable(found.join(total, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))
    store, path = fs.FileSystem.from_uri(base)
    store.delete_dir(path)
    return out
