"""SimHash near-duplicates by meet-in-the-middle ball hashing."""

from __future__ import annotations

from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounds, connected_components, durable, runs

BLOCK = 16


def fingerprint(text: str | None) -> int:
    """Signed 64-bit SimHash of the 3-word shingles; 0 without words."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    whole = b" ".join(words)
    ends = list(accumulate(map(len, words), lambda a, n: a + n + 1))
    n = max(1, len(words) - 2)
    hashes = [xxhash.xxh64_intdigest(whole[a:b], 42) for a, b in zip([0, *(e + 1 for e in ends)], ends[min(2, len(words) - 1) :])]
    h = np.array(hashes, "<u8").view(np.uint8).reshape(n, 8)
    ones = np.unpackbits(h, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<i8")[0])


def variants(fps: np.ndarray) -> np.ndarray:
    """Keys of each fingerprint, one row each.

    Of three differing bits one at least lies in one of four 16-bit blocks. With that block erased, two bits at most differ in the
    other 48, so both balls of radius one (half of that) share a variant. The erased block holds the block's number.
    """
    out = []
    for b in range(64 // BLOCK):
        hole = np.uint64(((1 << BLOCK) - 1) << (b * BLOCK))
        base = (fps & ~hole) | np.uint64((b + 1) << (b * BLOCK))
        bits = [np.uint64(1 << i) for i in range(64) if i // BLOCK != b]
        out.append(base[:, None] ^ np.array([np.uint64(0), *bits], np.uint64)[None, :])
    return np.concatenate(out, axis=1)


#: Six blocks of ten or eleven bits, and their choices of three.
PARTS = [np.uint64((1 << z) - (1 << a)) for a, z in zip((0, 11, 22, 33, 44, 54), (11, 22, 33, 44, 54, 64))]
THREES = list(combinations(range(6), 3))


def block_keys(fp: int) -> np.ndarray:
    """Twenty keys of a fingerprint: three differing bits leave three of six blocks equal, so pairs within them share a key. Ten times fewer
    keys than `variants`, each of 31 to 33 bits: for rows that are compared on more than their fingerprints where they meet."""
    f = np.int64(fp).view(np.uint64)
    return np.array([xxhash.xxh64_intdigest((f & (PARTS[a] | PARTS[b] | PARTS[c])).tobytes(), 1000 + i) for i, (a, b, c) in enumerate(THREES)], np.uint64)


def forest(fps: np.ndarray, radius: int = 3) -> list[tuple[np.ndarray, np.ndarray]]:
    """Verified links that connect what is linked within one key; never all pairs."""
    out, rest = [], np.unique(fps)
    while len(rest):
        front, rest = [rest[0]], rest[1:]
        while front and len(rest):
            f = front.pop()
            hit = np.bitwise_count(rest ^ f) <= radius
            near, rest = rest[hit], rest[~hit]
            if len(near):
                out.append((np.full(len(near), f), near))
                front.extend(near)
    return out


def _emit(batches):
    for b in batches:
        for i in range(0, b.num_rows, 20_000):
            fps = b.column(0).slice(i, 20_000).to_numpy(zero_copy_only=False).view(np.uint64)
            keys = variants(fps)
            yield pa.RecordBatch.from_arrays([pa.array(keys.ravel().view(np.int64)), pa.array(np.repeat(fps, keys.shape[1]).view(np.int64))], ["key", "fp"])


def _collide(batches):
    for t in runs(batches, "key"):
        keys, fps = t.column("key").to_numpy(), t.column("fp").to_numpy().view(np.uint64)
        s, e = bounds(keys)
        two = s[e - s == 2]
        a, z = fps[two], fps[two + 1]
        ok = np.bitwise_count(a ^ z) <= 3
        us, vs = [a[ok]], [z[ok]]
        for i, j in zip(s[e - s > 2], e[e - s > 2]):
            for u, v in forest(fps[i:j]):
                us.append(u)
                vs.append(v)
        u, v = np.concatenate(us), np.concatenate(vs)
        pairs = np.unique(np.stack([np.minimum(u, v), np.maximum(u, v)], 1), axis=0) if len(u) else np.empty((0, 2), np.uint64)
        yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(pairs[:, k]).view(np.int64)) for k in (0, 1)], ["u", "v"])


def fingerprints(docs: DataFrame) -> DataFrame:
    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([fingerprint(t) for t in b.column(1).to_pylist()], pa.int64())], ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, fp long")


def simhash_components(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (hex), component_id for docs (doc_id, text).

    Null and empty texts have fingerprint zero and link like any other. Equal fingerprints are one node, so a group of copies costs
    one row. Rows with null doc_id are linked but never name a component; a component of these alone has a null component_id.
    Repeated rows each return. Empty table: no rows. Other columns of docs are not read, whatever their names.
    """
    fp = durable(fingerprints(docs))
    nodes = fp.groupBy("fp").agg(F.min("doc_id").alias("first"))
    keys = nodes.select("fp").mapInArrow(_emit, "key long, fp long")
    comp = connected_components(keys.repartition("key").sortWithinPartitions("key"), _collide)
    named = nodes.join(comp, nodes.fp == comp.node, "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    least = named.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = named.join(least, "root").select("fp", "component_id")
    return fp.join(classes, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
