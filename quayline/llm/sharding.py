"""Sharding by a lookup table that the shards fill in turns.

Every shard has an order of preference over the slots of a table of prime size: a start and a step, both from hashes of
its name, visit each slot once. The shards take turns; at its turn a shard claims the first slot of its order that is
still free. A shard of weight w gets w turns where one of weight 1 gets one. A key is hashed to a slot and the slot names
the shard, so a placement costs one lookup, shards get equal shares, and when a shard joins or leaves nearly all keys
stay where they are. The table has as many rows as slots, a parameter, which bounds what is broadcast.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Mapping

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from quayline.llm.common import free_name, table

SLOTS = 65_537
MOST_SLOTS = 1 << 22  # two integers each: at most 64 MB are broadcast
SHARDS = {f"shard-{i:03d}": 1.0 for i in range(48)}


def _prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n ** 0.5) + 1))


def lookup_table(shards: Mapping[str, float], slots: int = SLOTS) -> list[str]:
    """The shard of every slot. The shards are taken in the order of their names; equal weights get equal shares."""
    if not _prime(slots) or slots > MOST_SLOTS:
        raise ValueError(f"the number of slots must be a prime up to {MOST_SLOTS}, not {slots}")
    names = sorted(shards)
    if not names or len(names) > slots or any(not shards[n] > 0 for n in names):
        raise ValueError("shards need positive weights, and no more shards than slots")
    digests = {n: hashlib.sha256(n.encode()).digest() for n in names}
    at = {n: int.from_bytes(d[:8], "big") % slots for n, d in digests.items()}
    step = {n: int.from_bytes(d[8:16], "big") % (slots - 1) + 1 for n, d in digests.items()}
    owner: list[str | None] = [None] * slots
    turns = [(1 / shards[n], i, n) for i, n in enumerate(names)]  # the time of the next turn
    heapq.heapify(turns)
    for _ in range(slots):
        time, i, n = turns[0]
        while owner[at[n]] is not None:
            at[n] = (at[n] + step[n]) % slots
        owner[at[n]] = n
        heapq.heapreplace(turns, (time + 1 / shards[n], i, n))
    return owner  # type: ignore[return-value]


def slot_of(*keys: Column, slots: int = SLOTS) -> Column:
    """The slot of a key; of several columns the first that is not NULL counts, and all NULL is one key of its own."""
    return F.pmod(F.xxhash64(F.coalesce(*[k.cast("string") for k in keys])), F.lit(slots)).cast("int")


def place(df: DataFrame, shards: Mapping[str, float], *keys: str, slots: int = SLOTS, slot: str = "slot",
          shard: str = "shard") -> DataFrame:
    """``df`` with the slot and the shard of every row.

    Rows with equal keys, repeated ones too, share a shard. A NULL key falls back to the next key column, so that rows
    without an id are spread by their content; a row whose keys are all NULL has the shard of the NULL key. A column
    that is already called ``slot`` or ``shard`` stays; the new one gets underscores in front.
    """
    spark = df.sparkSession
    slot, shard = free_name(df.columns, slot), free_name(df.columns, shard)
    owners = pd.DataFrame({slot: range(slots), shard: lookup_table(shards, slots)}).astype({slot: "int32"})
    lookup = F.broadcast(spark.createDataFrame(owners, f"`{slot}` int, `{shard}` string"))
    return (df.withColumn(slot, slot_of(*[F.col(f"`{k}`") for k in keys], slots=slots)).join(lookup, slot)
            .select(*[F.col(f"`{c}`") for c in df.columns], slot, shard))


def write_shards(placed: DataFrame, path: str, shard: str = "shard") -> None:
    """One folder per shard; adaptive execution splits a shard too large for a task."""
    placed.hint("rebalance", shard).write.partitionBy(shard).parquet(path)


def op1_permutation_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shard of every document, by its id."""
    docs = table(spark, sf_dir, "documents")
    return place(docs.select("doc_id", "text"), SHARDS, "doc_id", "text").select("doc_id", "slot", "shard")
