"""Placement of documents by a permutation-filled lookup table.

Every shard has its own order of preference over the slots of a table of prime
size: ``offset + k * skip`` modulo the size, a permutation because the size is
prime. The shards take turns; each claims the first slot of its order that is
still free, until the table is full. Shares differ by at most one slot, and
adding or removing a shard moves little more than that shard's share.

The table has ``table_size`` rows whatever the number of documents. It is made
once, broadcast, and places a document by one hash and one lookup.
"""

from __future__ import annotations

from hashlib import md5

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MAX_TABLE = 1 << 20  # rows; the broadcast's bound


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % k for k in range(2, int(n ** 0.5) + 1))


def lookup_table(shards: list[str], table_size: int) -> list[str]:
    """The shard of every slot. Repeated names count once; order does not matter."""
    names = sorted(set(shards))
    if not names:
        raise ValueError("at least one shard is needed")
    if not _is_prime(table_size) or not len(names) <= table_size <= MAX_TABLE:
        raise ValueError("table_size must be a prime, at least the number of shards, "
                         f"at most {MAX_TABLE}")
    digests = [md5(s.encode("utf-8")).hexdigest() for s in names]
    offset = [int(d[:8], 16) % table_size for d in digests]
    skip = [int(d[8:16], 16) % (table_size - 1) + 1 if table_size > 2 else 1 for d in digests]
    turn, table, filled = [0] * len(names), [""] * table_size, 0
    taken = [False] * table_size
    while filled < table_size:
        for i, name in enumerate(names):
            while taken[slot := (offset[i] + turn[i] * skip[i]) % table_size]:
                turn[i] += 1
            taken[slot], table[slot] = True, name
            filled += 1
            if filled == table_size:
                break
    return table


def slot_of(key: Column, table_size: int) -> Column:
    """The slot of a key: the first 60 bits of its MD5 modulo the table's size."""
    return F.pmod(F.conv(F.substring(F.md5(key.cast("binary")), 1, 15), 16, 10).cast("long"),
                  F.lit(table_size)).cast("int")


def table_frame(spark: SparkSession, shards: list[str], table_size: int) -> DataFrame:
    """The lookup table as (slot, shard) rows, ready to be broadcast."""
    table = lookup_table(shards, table_size)
    listed = spark.range(1).select(F.posexplode(F.split(F.lit("\n".join(table)), "\n")).alias(
        "slot", "shard"))
    return F.broadcast(listed)


def place(df: DataFrame, key: Column, shards: list[str], table_size: int = 65537,
          slot_col: str = "slot", shard_col: str = "shard") -> DataFrame:
    """All columns of ``df`` plus the slot and the shard of each row.

    ``key`` decides alone, so equal keys land together; a null key counts as
    the empty string. No shuffle: the table is a broadcast of ``table_size``
    rows. Columns of ``df`` called like the new ones are replaced.
    """
    rows = df.drop(slot_col, shard_col).withColumn(
        "_gt_slot", slot_of(F.coalesce(key.cast("string"), F.lit("")), table_size))
    table = table_frame(df.sparkSession, shards, table_size).select(
        F.col("slot").alias("_gt_slot"), F.col("shard").alias(shard_col))
    placed = rows.join(F.broadcast(table), "_gt_slot")
    left = [c for c in df.columns if c not in (slot_col, shard_col)]
    return placed.select(*[f"`{c}`" for c in left], F.col("_gt_slot").alias(slot_col), shard_col)
