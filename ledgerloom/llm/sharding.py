"""Placement by a permutation-filled lookup table."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _number(name: str, salt: str, mod: int) -> int:
    return int(hashlib.sha256(f"{salt}:{name}".encode()).hexdigest()[:15], 16) % mod


def fill_table(shards: list[str], size: int = 8191) -> list[int]:
    """Shards take turns; each claims the next free slot of its own permutation offset, offset+skip, ... modulo the prime size."""
    if not shards or len(shards) > size or any(size % p == 0 for p in range(2, int(size**0.5) + 1)):
        raise ValueError("need 1 to `size` shards and a prime size")
    at = [_number(s, "offset", size) for s in shards]
    skip = [_number(s, "skip", size - 1) + 1 for s in shards]
    table, free = [-1] * size, size
    while free:
        for i in range(len(shards)):
            while table[at[i]] >= 0:
                at[i] = (at[i] + skip[i]) % size
            table[at[i]] = i
            free -= 1
            if not free:
                break
    return table


def place(docs: DataFrame, shards: list[str], size: int = 8191, key: str = "doc_id") -> DataFrame:
    """docs with slot and shard (replaced where they exist). The table's `size` rows bound what is broadcast.

    Null key: the text's hash places the row, so such rows spread too; both null: the slot of the empty string. Equal keys share a shard.
    Empty table: no rows.
    """
    spark = docs.sparkSession
    lit = ",".join(map(str, fill_table(shards, size)))
    names = F.array(*[F.lit(s) for s in shards])
    table = spark.range(1).select(F.posexplode(F.split(F.lit(lit), ",")).alias("slot", "ix")).select(F.col("slot").cast("long"), F.get(names, F.col("ix").cast("int")).alias("shard"))
    digest = F.md5(F.coalesce(F.col(key).cast("string"), F.col("text") if "text" in docs.columns else F.lit(None).cast("string"), F.lit("")).cast("binary"))
    slot = F.conv(F.substring(digest, 1, 12), 16, 10).cast("long") % size
    return docs.drop("slot", "shard").withColumn("slot", slot).join(F.broadcast(table), "slot")
