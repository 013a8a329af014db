"""Harmonic packing: pieces fall into classes of reciprocal capacity; a class-k bin takes k of them."""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tokens import load

SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, part long"
PACKED = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def cuts(total: int, capacity: int, slack: float = 1 / 32, least: int = 32) -> list[int]:
    """Piece lengths of one document: full sequences, then slots capacity // k, until the rest fits its slot within `slack`."""
    out = [capacity] * (total // capacity)
    rest = total % capacity
    while rest:
        k = capacity // rest
        slot = capacity // k
        if rest <= least or slot - rest <= slack * slot:
            out.append(rest)
            break
        out.append(capacity // (k + 1))
        rest -= capacity // (k + 1)
    return out


def fill(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each piece. Every class fills its own bins; what is left of all classes is mixed, largest first."""
    k = capacity // lengths
    where, offset = np.empty(len(k), np.int64), np.empty(len(k), np.int64)
    bins, rest = 0, []
    for c in np.unique(k):
        at = np.flatnonzero(k == c)
        whole = len(at) // c * c
        if whole:
            table = lengths[at[:whole]].reshape(-1, c)
            where[at[:whole]] = bins + np.repeat(np.arange(len(table)), c)
            offset[at[:whole]] = (np.cumsum(table, axis=1) - table).ravel()
            bins += len(table)
        rest.extend(at[whole:])
    rest.sort(key=lambda i: -lengths[i])
    room: list[tuple[int, int]] = []  # (free, bin); best fit, as only the few left-over pieces come here
    import bisect

    for i in rest:
        n = int(lengths[i])
        j = bisect.bisect_left(room, (n, -1))
        free, b = room.pop(j) if j < len(room) else (capacity, bins)
        bins = max(bins, b + 1)
        where[i], offset[i] = b, capacity - free
        if free > n:
            bisect.insort(room, (free - n, b))
    return where, offset


def pack(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 1, group: int = 4) -> DataFrame:
    """Pack docs (doc_id, text) into sequences of at most `capacity` ids.

    Tasks tokenise and cut their own documents; then `group` input partitions at a time fill bins on their own, so the one
    shuffle carries piece lengths only. Padding: under `slack` of a slot, and one open bin per group.
    Null or empty text: one piece that holds the end id alone. Repeated rows are packed once each; a null doc_id stays null.
    Empty table: no rows. Texts of any length are cut into full sequences. Other columns of docs are not read, whatever their names.
    """

    end = struct.pack("<I", end_id)

    def pieces(batches):
        encode, part = load(tokenizer), TaskContext.get().partitionId()
        for b in batches:
            docs, starts, lengths, crcs, totals = [], [], [], [], []
            for doc, ids in zip(b.column(0).to_pylist(), encode(b.column(1).to_pylist())):
                raw = memoryview(ids + end)
                total, start = len(raw) // 4, 0
                for n in cuts(total, capacity):
                    docs.append(doc)
                    starts.append(start)
                    lengths.append(n)
                    crcs.append(zlib.crc32(raw[4 * start : 4 * (start + n)]))
                    totals.append(total)
                    start += n
            columns = [pa.array(c, pa.int64()) for c in (docs, starts, lengths, crcs, totals, [part] * len(docs))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "part"])

    def bins(key, f):
        f = f.sort_values(["part", "doc_id", "doc_tokens", "start", "ids_crc32"], ignore_index=True)
        where, offset = fill(f.length.to_numpy(), capacity)
        return f.assign(sequence_id=(int(key[0]) << 32) + where, offset=offset).drop(columns=["part", "bin_group"]).astype({"doc_id": "Int64"})

    d = docs.select(F.col("doc_id").cast("long"), "text")
    if d.rdd.getNumPartitions() < (cores := d.sparkSession.sparkContext.defaultParallelism):
        d = d.repartition(cores)  # few files of few row groups: all cores tokenise
    p = d.mapInArrow(pieces, SCHEMA)
    return p.withColumn("bin_group", F.floor(F.col("part") / group)).groupBy("bin_group").applyInPandas(bins, PACKED)
