"""Sharding by a permutation-filled lookup table.

Every shard has an order of preference over the slots of a table of prime size (an offset and
a step from two hashes of its name). The shards take turns; each claims the first slot it
prefers that is still free, until all slots are taken. A row goes to the shard that holds the
slot of its key's hash: one array lookup. Shards differ by one slot at most (by their weights,
if given), and a shard that leaves moves little but its own rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Slots of the table (a prime); also the proven bound of what is broadcast.
SLOTS = 65537


def lookup(shards: list[str], slots: int = SLOTS, weights: list[int] | None = None) -> np.ndarray:
    """The index of the shard that holds each slot. ``weights``: turns in a round (1 each)."""
    if slots < 2 or any(slots % d == 0 for d in range(2, int(slots ** 0.5) + 1)):
        raise ValueError("the table's size must be a prime")
    if not 0 < len(shards) <= slots or len(set(shards)) != len(shards):
        raise ValueError("from one shard to one for each slot, with different names")
    turns = weights or [1] * len(shards)
    if len(turns) != len(shards) or min(turns) < 1:
        raise ValueError("one positive weight for each shard")
    digests = [hashlib.sha256(name.encode()).digest() for name in shards]
    place = [int.from_bytes(d[:8], "little") % slots for d in digests]
    step = [int.from_bytes(d[8:16], "little") % (slots - 1) + 1 for d in digests]
    table, free = [-1] * slots, slots
    while True:
        for shard, own in enumerate(turns):
            for _ in range(own):
                at = place[shard]
                while table[at] >= 0:
                    at = (at + step[shard]) % slots
                table[at] = shard
                place[shard] = (at + step[shard]) % slots
                free -= 1
                if not free:
                    return np.array(table, np.int32)


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    """The slot of a key (null: the empty text's)."""
    return F.pmod(F.xxhash64(F.coalesce(key.cast("string"), F.lit(""))), F.lit(slots)).cast("int")


def table_frame(spark: SparkSession, shards: list[str], slots: int = SLOTS, weights: list[int] | None = None) -> DataFrame:
    """(slot, shard_id, shard) rows of the lookup table."""
    owner = lookup(shards, slots, weights).tolist()
    return spark.createDataFrame([(i, s, shards[s]) for i, s in enumerate(owner)], "slot int, shard_id int, shard string")


def placed(rows: DataFrame, key: str, shards: list[str], slots: int = SLOTS, weights: list[int] | None = None) -> DataFrame:
    """``rows`` with the columns _slot, _shard_id and _shard. The table (``slots`` rows, whatever
    the input) is broadcast; rows neither move nor group, so no key or source can be hot. Rows
    of equal key share a shard; null keys share the shard of the empty text."""
    owner = table_frame(rows.sparkSession, shards, slots, weights).toDF("_slot", "_shard_id", "_shard")
    return rows.withColumn("_slot", slot_of(F.col(f"`{key}`"), slots)).join(F.broadcast(owner), "_slot")


def write_shards(rows: DataFrame, key: str, shards: list[str], path: str, slots: int = SLOTS, weights: list[int] | None = None) -> None:
    """One Parquet folder (_shard=name) for each shard with rows, written from where the rows are."""
    placed(rows, key, shards, slots, weights).drop("_slot", "_shard_id").write.partitionBy("_shard").parquet(path)
