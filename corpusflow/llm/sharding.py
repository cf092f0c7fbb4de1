"""Sharding by a permutation-filled lookup table (operator 9), native functions on the main path.

Each shard prefers the table's slots in an order of its own (an offset and a
step from MD5 of its name; the size is prime, so the order visits all slots).
The shards take turns: each claims the first slot of its order that is free,
until the table is full. A document's key picks a slot, the slot its shard.
Shards differ by one slot at most; when one leaves, few keys of others move.

The table has ``table_size`` rows, a parameter that does not grow with the
data, and is broadcast; documents are not shuffled. Defined cases: a null key
is placed as the empty text; equal keys share a shard; other columns are kept;
a column that is already named slot or shard (in any case) is replaced, but may
be the key; an empty table gives no rows; no shards, or fewer slots than shards, raise.
"""
from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

MAX_TABLE = 1 << 20


def _h(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def lookup_table(shards: list[str], size: int) -> list[int]:
    """slot -> number of its shard in ``shards``."""
    if not shards or len(set(shards)) < len(shards) or not len(shards) <= size <= MAX_TABLE:
        raise ValueError("distinct shard names and a table of at least as many slots (at most 2**20) are needed")
    if size < 2 or any(size % k == 0 for k in range(2, int(size ** 0.5) + 1)):
        raise ValueError(f"the table's size must be prime, not {size}")
    at = [_h(f"offset:{s}") % size for s in shards]
    step = [_h(f"step:{s}") % (size - 1) + 1 for s in shards]
    slots, free = [-1] * size, size
    while free:
        for k in range(len(shards)):
            while slots[at[k]] >= 0:
                at[k] = (at[k] + step[k]) % size
            slots[at[k]] = k
            free -= 1
            if not free:
                break
    return slots


def slot_of(key: Column, size: int) -> Column:
    """60 bits of MD5 of the key, modulo the table's size."""
    return F.pmod(F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit(""))), 1, 15), 16, 10).cast("long"), F.lit(size)).cast("int")


def place(df: DataFrame, key: str, shards: list[str], table_size: int) -> DataFrame:
    """``df`` plus slot and shard; no shuffle."""
    spark: SparkSession = df.sparkSession
    rows = [(k, shards[s]) for k, s in enumerate(lookup_table(shards, table_size))]
    # The broadcast table has table_size rows: one hash lookup for each row.
    names = spark.createDataFrame(rows, "__slot int, __shard string")
    keep = [c for c in df.columns if c.lower() not in ("slot", "shard")]
    placed = df.select(*keep, slot_of(F.col(key), table_size).alias("__slot")).join(F.broadcast(names), "__slot")
    return placed.select(*keep, F.col("__slot").alias("slot"), F.col("__shard").alias("shard"))
