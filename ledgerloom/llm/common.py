"""Shared pieces: sorted runs of a key; durable cuts and connected components come from the library."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from ..operators.components import connected_components, durable, shared_dir, small

__all__ = ["bounds", "connected_components", "durable", "packed", "row_keys", "runs", "shared_dir", "small", "unpacked"]


def runs(batches, key: str):
    """Yield record batches that hold whole runs of `key`, from batches sorted by it. A run may cross batches."""
    held: list[pa.Table] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        t = pa.Table.from_batches([batch])
        keys = t.column(key)
        last = keys[-1]
        cut = int(np.searchsorted(keys.to_numpy(), last.as_py(), side="left"))
        if cut > 0 or (held and held[-1].column(key)[-1] != last):
            yield pa.concat_tables([*held, t.slice(0, cut)]).combine_chunks()
            held = []
        held.append(t.slice(cut))
    if held:
        yield pa.concat_tables(held).combine_chunks()


def bounds(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of equal keys."""
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    return starts, np.r_[starts[1:], len(keys)]


def row_keys(*columns: str) -> tuple[Column, Column]:
    """Two 64-bit hashes, k1 and k2, that name a row by its columns. The second starts from another seed, so together they are 128 bits."""
    return F.xxhash64(*columns).alias("k1"), F.xxhash64(F.lit(1), *columns).alias("k2")


def packed(numbers: np.ndarray, width: int) -> bytes:
    """Integers of 4 or 8 bytes, compressed byte by byte of their place, after the length of that."""
    planes = np.ascontiguousarray(numbers.astype(f"<i{width}").view(np.uint8).reshape(-1, width).T)
    data = pa.compress(planes.tobytes(), codec="zstd", asbytes=True)
    return len(data).to_bytes(4, "little") + data


def unpacked(data: bytes, n: int, width: int) -> tuple[np.ndarray, bytes]:
    """`n` packed integers, and what follows them."""
    end = 4 + int.from_bytes(data[:4], "little")
    raw = np.frombuffer(pa.decompress(data[4:end], width * n, codec="zstd"), np.uint8)
    return np.ascontiguousarray(raw.reshape(width, n).T).view(f"<i{width}").ravel(), data[end:]
