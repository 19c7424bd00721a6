"""Shards against a plain reading of the method."""

import hashlib
from collections import Counter

import pytest

from quayline.llm import sharding


def test_table_is_filled_in_turns():
    names, slots = [f"s{i}" for i in range(7)], 101
    orders = {}
    for n in names:
        d = hashlib.sha256(n.encode()).digest()
        at, step = int.from_bytes(d[:8], "big") % slots, int.from_bytes(d[8:16], "big") % (slots - 1) + 1
        orders[n] = [(at + i * step) % slots for i in range(slots)]
        assert sorted(orders[n]) == list(range(slots))
    owner = {}
    while len(owner) < slots:
        for n in names:
            if len(owner) < slots:
                owner[next(s for s in orders[n] if s not in owner)] = n
    assert sharding.lookup_table(dict.fromkeys(names, 1.0), slots) == [owner[s] for s in range(slots)]


def test_shares_follow_weights_and_few_slots_move():
    table = sharding.lookup_table({"a": 1, "b": 2, "c": 1}, 1009)
    share = Counter(table)
    assert abs(share["b"] - 504) <= 2 and abs(share["a"] - share["c"]) <= 2
    before = sharding.lookup_table(dict.fromkeys("abcdefghij", 1.0))
    after = sharding.lookup_table(dict.fromkeys("abcdefghi", 1.0))
    moved = sum(x != y for x, y in zip(before, after) if x != "j")
    assert moved < 0.1 * len(before)
    for shards, slots in (({}, 7), ({"a": 0}, 7), ({"a": 1}, 8), (dict.fromkeys("abcdefgh", 1.0), 7)):
        with pytest.raises(ValueError):
            sharding.lookup_table(shards, slots)


def test_every_row_is_placed(spark, tmp_path):
    rows = [(1, "a", 5), (1, "b", 6), (None, "a", 7), (None, "b", 8), (None, None, 9), (2, None, None), (2, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, slot int")
    shards = dict.fromkeys("xyz", 1.0)
    placed = sharding.place(df, shards, "doc_id", "text", slots=11)
    found = placed.collect()
    assert placed.columns == ["doc_id", "text", "slot", "_slot", "shard"] and len(found) == len(rows)
    table = sharding.lookup_table(shards, 11)
    assert all(table[r["_slot"]] == r["shard"] for r in found)
    assert len({r["shard"] for r in found if r["doc_id"] == 1}) == 1
    assert sharding.place(df.limit(0), shards, "doc_id").collect() == []
    sharding.write_shards(placed.drop("_slot"), str(tmp_path / "shards"))
    assert spark.read.parquet(str(tmp_path / "shards")).count() == len(rows)


def test_documents_get_even_shards(spark, folder):
    df = sharding.op1_permutation_shards(spark, folder.replace("0.001", "0.1"))
    docs = spark.read.parquet(folder.replace("0.001", "0.1") + "/documents.parquet").count()
    table, rows = sharding.lookup_table(sharding.SHARDS), df.collect()
    assert len(rows) == docs and all(table[r["slot"]] == r["shard"] for r in rows)
    share = Counter(r["shard"] for r in rows)
    assert max(share.values()) < 1.5 * docs / len(sharding.SHARDS)
