"""Prediction by partial matching: scores of texts under a corpus's own statistics, and language identification.

Counts are gathered in Spark; one task lays out the tables of a trie of bounded size and writes them to the shared folder, where workers map
them into memory: no table passes through the driver, and a lost executor finds them again. What it does not hold is looked up in the whole table
of counts, by buckets.
"""

from __future__ import annotations

import io
import math
import uuid
from collections import Counter
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import trie
from .common import bounds, durable, packed, shared_dir, unpacked


def _batch(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))


def _tallies(order: int, most: int = 1_000_000):
    """A growing tally of grams: add(text) and flush() yield (codes, counts) when more than `most` codes are held."""
    held, size = [], 0
    codes, counts = np.empty(0, np.int64), np.empty(0, np.int64)

    def merge():
        nonlocal codes, counts, size
        c, n = trie.tally(np.concatenate(held)) if held else (codes[:0], counts[:0])
        codes, counts = trie.tally(np.concatenate([codes, c]), np.concatenate([counts, n]))
        held.clear()
        size = 0

    def add(text: bytes):
        nonlocal codes, counts, size
        for at in range(0, len(text) + 1, 1 << 20):
            held.append(trie.grams(text, order, at, 1 << 20))
            size += len(held[-1])
            if size > 1 << 21:
                merge()
                if len(codes) > most:
                    yield codes, counts
                    codes, counts = codes[:0], counts[:0]

    def flush():
        merge()
        yield codes, counts

    return add, flush


def _count(order: int):
    """Rows (word, code, n): words' counts (code -1), grams' counts (word null), and documents (both: null, -1)."""

    def rows(words, codes, counts):
        return _batch(word=pa.array(words, pa.string()), code=pa.array(codes, pa.int64()), n=pa.array(counts, pa.int64()))

    def run(batches):
        def flush():
            items = list(words.items())
            words.clear()
            for i in range(0, len(items), 50_000):
                part = items[i : i + 50_000]
                yield rows([w.decode() for w, _ in part], [-1] * len(part), [n for _, n in part])

        def grams(found):
            for codes, counts in found:
                for i in range(0, len(codes), 100_000):
                    yield rows([None] * len(codes[i : i + 100_000]), codes[i : i + 100_000], counts[i : i + 100_000])

        words, docs = Counter(), 0
        add, rest = _tallies(order)
        for b in batches:
            for t in b.column(0).to_pylist():
                data = (t or "").encode().lower()
                yield from grams(add(data))
                words.update(data.split())
                docs += 1
                if len(words) > 200_000:
                    yield from flush()
        yield from flush()
        yield from grams(rest())
        if docs:
            yield rows([None], [-1], [docs])

    return run


def _built(rows: DataFrame, build, empty) -> str:
    """Folder of the trie that `build` makes of all rows in one task; their number is bounded by the caller. `empty`: for no rows."""
    base = f"{shared_dir(rows.sparkSession)}/trie-{uuid.uuid4().hex}"

    def run(batches):
        parts = [[c.to_numpy() for c in b.columns] for b in batches if b.num_rows]
        if parts:
            arrays = [np.concatenate(c) for c in zip(*parts)]
            parts.clear()
            yield _batch(folder=pa.array([_saved(build(*arrays), f"{base}/{TaskContext.get().taskAttemptId()}")]))

    got = rows.repartition(1).mapInArrow(run, "folder string").collect()
    return got[0].folder if got else _saved(empty(), f"{base}/none")


def _saved(built, folder: str) -> str:
    """A trie, or a trie and its low orders' counts, below a folder; returns it."""
    model, low = built if isinstance(built, tuple) else (built, {})
    model.save(folder)
    _save_low(folder, low)
    return folder


def _least(sizes: list, most: int) -> int:
    """The smallest count that leaves at most `most` rows; sizes: (count from which, number of rows)."""
    least, kept = 1 << 62, 0
    for n, rows in sorted(sizes, reverse=True):
        kept += rows
        if kept > most:
            return least
        least = n
    return 1


def least_count(rows: DataFrame, count: str, most: int) -> int:
    """The smallest count that at most `most` rows have or exceed; counts from 64 on are taken by powers of two."""
    n = F.col(count)
    from_ = F.when(n < 64, n).otherwise(F.expr(f"shiftleft(1L, cast(floor(log2({count})) as int))"))
    return _least([(r.at, r["count"]) for r in rows.groupBy(from_.alias("at")).count().collect()], most)


#: Grams with this many context bytes or fewer are in every trie: 2**24 at most, far fewer in texts.
LOW = 2


def _bucket(code, buckets: int):
    """Of a gram, by the last LOW + 1 bytes of its context: with a gram go the grams of all its shorter contexts down to those. For numpy arrays and columns."""
    if isinstance(code, np.ndarray):
        return (((code >> 8 & trie.mask(LOW + 1)) * 2654435761 & 0xFFFFFFFF) >> 8) % buckets
    last = F.shiftright(code, 8).bitwiseAND(F.lit(trie.mask(LOW + 1)))
    return F.shiftright((last * 2654435761).bitwiseAND(F.lit(0xFFFFFFFF)), 8) % buckets


class Scores(NamedTuple):
    folder: str  # of the trie of the most met contexts, and below it the low orders' counts
    grams: DataFrame  # (o, code, n): all grams of more than LOW context bytes
    n_grams: int


def _arrays(o: np.ndarray, code: np.ndarray, n: np.ndarray, orders) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Each order's codes, sorted, and their counts, for Trie.build."""
    out = {}
    for i in orders:
        own = np.flatnonzero(o == i)
        own = own[np.argsort(code[own])]
        out[i] = code[own], n[own].astype(np.float64)[:, None]
    return out


def _save_low(folder: str, low: dict) -> None:
    store, path = fs.FileSystem.from_uri(folder)
    for i, (code, n) in low.items():
        with store.open_output_stream(f"{path}/low-{i}.npy") as f:
            np.lib.format.write_array(f, np.stack([code, n[:, 0].astype(np.int64)]), allow_pickle=False)


def _load_low(folder: str) -> dict:
    store, path = fs.FileSystem.from_uri(folder)
    out = {}
    for i in range(LOW + 1):
        with store.open_input_file(f"{path}/low-{i}.npy") as f:
            code, n = np.load(io.BytesIO(f.read()))
            out[i] = code, n.astype(np.float64)[:, None]
    return out


def fit_scores(counts: DataFrame, order: int, cached: int) -> Scores:
    """The whole model from the longest grams' counts (code, n): all grams of all orders stay in a table.

    Workers hold a trie of the contexts met most, whole ones, with `cached` grams at most beside the low orders; a context's suffixes are
    met as often, so what the trie knows of a context is all there is to know. Other contexts are looked up in the table, by its buckets.
    """
    levels = [counts]
    for o in range(order - 1, -1, -1):
        levels.append(levels[-1].groupBy(F.col("code").bitwiseAND(F.lit(trie.mask(o + 1))).alias("code")).agg(F.sum("n").alias("n")))
    rows = None
    for i, level in enumerate(levels):
        tagged = level.select(F.lit(order - i).alias("o"), "code", "n")
        rows = tagged if rows is None else rows.union(tagged)
    met = F.sum("n").over(Window.partitionBy("o", F.shiftright("code", 8)))  # a context has 256 symbols at most
    at = f"{shared_dir(counts.sparkSession)}/trie-{uuid.uuid4().hex}/grams"
    rows.withColumn("met", met).write.parquet(at)
    rows = counts.sparkSession.read.parquet(at)
    high = rows.filter(F.col("o") > LOW)
    least = least_count(high, "met", cached)

    def build(o, code, n):
        return trie.Trie.build(_arrays(o, code, n, range(order + 1)), order), _arrays(o, code, n, range(LOW + 1))

    nothing = np.empty(0, np.int64)
    folder = _built(rows.filter((F.col("o") <= LOW) | (F.col("met") >= least)).select("o", "code", "n"), build, lambda: build(nothing, nothing, nothing))
    return Scores(folder, high.select("o", "code", "n"), high.count())


def _asked(base: int, whose: np.ndarray, codes: np.ndarray, buckets: int):
    """(bucket, base, n, packed codes and rows) of places that the trie of a worker does not know."""
    b = _bucket(codes, buckets)
    by = np.lexsort((codes, b))
    b, codes, whose = b[by], codes[by], whose[by]
    for i, j in zip(*bounds(b)) if len(b) else ():
        yield int(b[i]), base, j - i, packed(codes[i:j], 8) + packed(whose[i:j], 4)


def _answered(folder: str, order: int):
    """Log10 sums (row, log) of the asked places of a bucket, under its grams and the low orders."""

    def run(grams: pa.Table, asked: pa.Table) -> pa.Table:
        if not asked.num_rows:
            return pa.table([pa.array([], pa.int64()), pa.array([], pa.float64())], ["row", "log"])
        high = _arrays(*(grams.column(c).to_numpy() for c in ("o", "code", "n")), range(LOW + 1, order + 1))
        model = trie.Trie.build({**_load_low(folder), **high}, order)
        rows, logs = [], []
        for base, n, data in zip(*(asked.column(c).to_pylist() for c in ("base", "places", "data"))):
            codes, rest = unpacked(data, n, 8)
            whose, _ = unpacked(rest, n, 4)
            each, at = np.unique(whose.astype(np.int64), return_inverse=True)
            rows.append(base + each)
            logs.append(np.bincount(at, model.logs(codes)[:, 0]))
        return pa.table([np.concatenate(rows), np.concatenate(logs)], ["row", "log"])

    return run


def score(docs: DataFrame, folds: int = 7, fold: int = 2, common_words: int = 200_000, order: int = 5, cached: int = 2_000_000) -> DataFrame:
    """Log10 probability of each text under a trie learned from all rows whose crc32(doc_id) mod `folds` is not `fold`,
    beside an add-one word model of the same rows.

    All grams of up to `order` context bytes are counted over the whole corpus, and all count: places in contexts that the trie of a worker
    (`cached` grams) does not hold go to the bucket of the gram table that does, so scores do not depend on `cached`. The most frequent words
    of up to 64 bytes, `common_words` at most, go to every task; all other words meet their counts in a join, so both tables may outgrow
    any machine. Null texts count as empty; rows with null doc_id are learned from. Repeated rows each count and each return. Words of
    one count are common or not together. Empty table: no rows. Long texts are learned from and scored whole. Other columns of docs are not
    read, whatever their names.
    """
    spark = docs.sparkSession
    d = docs.select(F.col("doc_id").cast("long"), "text", F.coalesce(F.crc32(F.col("doc_id").cast("string")) % folds == fold, F.lit(False)).alias("held_out"))
    raw = d.filter("not held_out").select("text").mapInArrow(_count(order), "word string, code long, n long")
    counts = durable(raw.groupBy("word", "code").agg(F.sum("n").alias("n")))
    words = counts.filter("word is not null").select("word", F.col("n").alias("c"))
    total = words.agg(F.count("*").alias("v"), F.sum("c").alias("n")).first()
    ends = counts.filter("word is null and code < 0").agg(F.sum("n")).first()[0] or 0
    folder, grams, n_grams = fit_scores(counts.filter("word is null and code >= 0").select("code", "n"), order, cached)
    n_all, v_all = int(total.n or 0) + ends, total.v + (ends > 0)
    buckets = 1 + max(n_grams // 250_000, n_all // 4_000_000)
    short = words.filter("octet_length(word) <= 64")
    top = short.filter(F.col("c") >= least_count(short, "c", common_words)).collect()
    sent = spark.sparkContext.broadcast({r.word.encode(): math.log10(r.c + 1) for r in top})

    def run(batches):
        (model,), common = trie.load(folder), sent.value
        row = TaskContext.get().partitionId() << 36
        for whole in batches:
            for i in range(0, whole.num_rows, 512):
                b = whole.slice(i, 512)
                texts = [(t or "").encode().lower() for t in b.column(1).to_pylist()]
                out, meta, unknown, base_row = [], [], [], row
                for doc, data, held, log in zip(b.column(0).to_pylist(), texts, b.column(2).to_pylist(), model.totals(texts, unknown=unknown)[:, 0].tolist()):
                    tokens = data.split()
                    base = known = 0
                    for w, tf in Counter(tokens).items():
                        if (lc := common.get(w)) is not None:
                            base += tf * lc
                            known += tf
                        else:
                            out.append((row, w.decode(), tf))
                            meta.append(None)
                    out.append((row, f" {row}", 0))  # no word holds a space: these rows spread evenly
                    meta.append({"doc_id": doc, "held_out": held, "n": len(tokens) + 1, "known": known, "base": float(base), "score": log})
                    row += 1
                    if len(out) > 50_000:
                        yield batch(out, meta)
                        out, meta = [], []
                yield batch(out, meta)
                if unknown:
                    yield asked(list(_asked(base_row, *(np.concatenate(x) for x in zip(*unknown)), buckets)))

    kind = pa.struct([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n", pa.int64()), ("known", pa.int64()), ("base", pa.float64()), ("score", pa.float64())])
    fields = {"row": pa.int64(), "word": pa.string(), "tf": pa.int32(), "meta": kind, "bucket": pa.int64(), "base": pa.int64(), "places": pa.int64(), "data": pa.binary()}

    def filled(n, **given):
        return pa.RecordBatch.from_arrays([pa.array(given[k], t) if k in given else pa.nulls(n, t) for k, t in fields.items()], list(fields))

    def batch(out, meta):
        cols = list(zip(*out)) or [(), (), ()]
        return filled(len(out), row=cols[0], word=cols[1], tf=cols[2], meta=meta)

    def asked(rows):
        cols = list(zip(*rows)) or [(), (), (), ()]
        return filled(len(rows), bucket=cols[0], base=cols[1], places=cols[2], data=cols[3])

    at = f"{shared_dir(spark)}/trie-{uuid.uuid4().hex}/parts"
    schema = "row long, word string, tf int, meta struct<doc_id:long,held_out:boolean,n:long,known:long,base:double,score:double>, bucket long, base long, places long, data binary"
    d.mapInArrow(run, schema).write.parquet(at)
    parts = spark.read.schema(schema).parquet(at)
    table = grams.withColumn("bucket", _bucket(F.col("code"), buckets)).groupBy("bucket")
    high = parts.filter("bucket is not null").select("bucket", "base", "places", "data").groupBy("bucket")
    logs = table.cogroup(high).applyInArrow(lambda left, right: _answered(folder, order)(left, right), "row long, log double")
    c = F.coalesce(F.col("c"), F.lit(0))
    told = parts.filter("bucket is null").select("row", "word", "tf", "meta").join(words, "word", "left")
    told = told.select("row", "meta", (F.col("tf") * F.log10(c + 1)).alias("rare"), F.when(c > 0, F.col("tf")).otherwise(0).alias("rare_known"), F.lit(0.0).alias("log"))
    told = told.union(logs.select("row", F.lit(None), F.lit(0.0), F.lit(0), "log"))
    sums = told.groupBy("row").agg(F.max("meta").alias("m"), F.sum("rare").alias("rare"), F.sum("rare_known").alias("rare_known"), F.sum("log").alias("log"))
    end_known, norm = int(ends > 0), math.log10(n_all + v_all + 1)
    return sums.select(
        "m.doc_id", "m.held_out", F.col("m.n").alias("n_tokens"), (F.col("m.known") + F.col("rare_known") + end_known).alias("n_known"), F.lit(n_all).cast("long").alias("train_tokens"),
        (F.col("m.base") + F.col("rare") + math.log10(ends + 1) - F.col("m.n") * norm).alias("base_score"), (F.col("m.score") + F.col("log")).alias("score"),
    )


class Languages(NamedTuple):
    folders: tuple[str, ...]  # a trie for each part of the languages
    names: tuple[str, ...]  # in descending order, as are the tries' classes one after the other


def fit_languages(docs: DataFrame, sample_bytes: int = 16 << 20, passage: int = 4096, together: int = 8, order: int = 4, folds: int = 4, fold: int = 2) -> Languages:
    """Tries of all lang values of labelled rows, `together` of them in one.

    They learn from a sample of `sample_bytes` in all, an equal share per language (all where there is less): whole texts are cut into
    passages, and each is drawn by a hash of its doc_id, text and number at its language's rate. So the sample is the same at every run,
    no text is preferred for where it stands, and null or repeated doc_ids do not matter. All grams of the sample count. Memory is that of
    the sample's grams times `together`, since a trie's languages share their rows; time grows with the number of languages.
    """
    d = docs.filter("lang is not null and text is not null").filter(F.coalesce(F.crc32(F.col("doc_id").cast("string")) % folds != fold, F.lit(True))).select("text", "lang", F.xxhash64("doc_id", "text").alias("h"))
    sizes = d.groupBy("lang").agg(F.sum(F.octet_length("text") + 1).alias("size")).collect()  # a row per language
    sizes = sorted(sizes, key=lambda r: r.lang, reverse=True)
    rate = {r.lang: (i, min(1.0, sample_bytes / len(sizes) / r["size"])) for i, r in enumerate(sizes)}

    def count(batches):
        for b in batches:
            found: dict[int, list[np.ndarray]] = {}
            for text, lang, h in zip(*(c.to_pylist() for c in b.columns)):
                which, share = rate[lang]
                data = text.encode().lower()
                drawn = [at for at in range(0, len(data) + 1, passage) if xxhash.xxh64_intdigest(at.to_bytes(8, "little"), h & (1 << 64) - 1) < share * 2**64]
                found.setdefault(which, []).extend(trie.grams(data, order, at, passage) for at in drawn)
            for which, parts in found.items():
                if parts:
                    codes, n = trie.tally(np.concatenate(parts))
                    yield _batch(which=pa.array(np.full(len(codes), which)), code=pa.array(codes), n=pa.array(n))

    counts = d.mapInArrow(count, "which long, code long, n long").groupBy("which", "code").agg(F.sum("n").alias("n"))
    counts = durable(counts) if len(sizes) > together else counts
    folders, nothing = [], np.empty(0, np.int64)
    for at in range(0, max(1, len(sizes)), together):
        classes = max(1, min(together, len(sizes) - at))
        build = lambda which, code, n, classes=classes: trie.Trie.build(trie.levels(code, which, n, classes, order), order)
        own = counts.filter(F.col("which").between(at, at + together - 1)).select((F.col("which") - at).alias("which"), "code", "n")
        folders.append(_built(own, build, lambda build=build: build(nothing, nothing, nothing)))
    return Languages(tuple(folders), tuple(r.lang for r in sizes))


def identify(docs: DataFrame, languages: Languages, columns: list[str]) -> DataFrame:
    """`columns` of docs with lang_pred and score, the winner's share of the languages' likelihoods.

    Null text, or text without a letter (empty included): lang_pred und, score 0; so for all texts if no language was learned. Ties: the
    greatest name. Every row returns once, repeats too. Long texts count whole. Clashing columns lang_pred or score of docs are
    replaced. Empty table: no rows.
    """
    columns = [c for c in columns if c not in ("lang_pred", "score", "_t")]
    src = docs.select(*columns, *([] if "text" in columns else [F.col("text").alias("_t")]))
    at, kept = src.columns.index("text" if "text" in columns else "_t"), len(columns)
    folders, names = languages

    def classify(texts: list) -> tuple[list[str], list[float]]:
        best, share = ["und"] * len(texts), [0.0] * len(texts)
        can = [i for i, t in enumerate(texts) if t and names and any(map(str.isalpha, t))]
        data = [texts[i].encode().lower() for i in can]
        logs = np.concatenate([t.totals(data) for t in trie.load(*folders)], axis=1)
        for i, x in zip(can, logs):
            k = int(x.argmax())
            best[i], share[i] = names[k], float(1 / (10.0 ** np.maximum(-300.0, x - x[k])).sum())
        return best, share

    def run(batches):
        for whole in batches:
            for i in range(0, whole.num_rows, 512):
                b = whole.slice(i, 512)
                best, share = classify(b.column(at).to_pylist())
                yield pa.RecordBatch.from_arrays([*b.columns[:kept], pa.array(best, pa.string()), pa.array(share, pa.float64())], [*columns, "lang_pred", "score"])

    schema = src.select(*columns).schema.add("lang_pred", "string").add("score", "double")
    return src.mapInArrow(run, schema)
