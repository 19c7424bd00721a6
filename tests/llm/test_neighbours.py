"""Neighbours against all inner products."""

import numpy as np

from quayline.llm import neighbours


def brute(rows, queries, k):
    out = {}
    for q, v in queries:
        scores = sorted((-float(np.sum(np.array(v) * np.array(w))), i) for i, w in rows if i != q and len(w) == len(v))
        out[q] = [(i, -s) for s, i in scores[:k]]
    return out


def result(df, key="vec_id"):
    found = {}
    for r in df.orderBy("query_id", "rank").collect():
        found.setdefault(r["query_id"], []).append((r[key], r["score"]))
        assert r["rank"] == len(found[r["query_id"]])
    return found


def test_awkward_rows_are_exact_when_all_are_candidates(spark):
    r = np.random.default_rng(1)
    rows = [(i, r.standard_normal(5).tolist()) for i in range(90)]
    rows += [(100 + i, rows[0][1]) for i in range(30)] + [(0, rows[3][1]), (200, [1.0, 2.0]), (220, [3.0, -1.0])]
    bad = [(300, None), (301, []), (302, [0.0] * 5), (303, [1.0, None, 0.0, 0.0, 0.0]), (304, [float("nan")] * 5),
           (305, [float("inf"), 0.0, 0.0, 0.0, 0.0]), (None, [1.0] * 5)]
    df = spark.createDataFrame([(*x, 0) for x in rows + bad], "vec_id long, embedding array<double>, ids int")
    queries = [x for x in rows if x[0] % 20 == 0 and x != (0, rows[3][1])]
    asked = spark.createDataFrame(queries + bad + queries[:2], "vec_id long, embedding array<double>")
    found = result(neighbours.search(df, asked, k=7, share=1e9, shard_rows=20, block_rows=4))
    expected = brute(rows, queries, 7)
    assert found.keys() == expected.keys()
    for q in expected:
        assert [i for i, _ in found[q]] == [i for i, _ in expected[q]]
        assert np.allclose([s for _, s in found[q]], [s for _, s in expected[q]], rtol=1e-12)
    assert neighbours.search(df.limit(0), asked).collect() == neighbours.search(df, asked.limit(0)).collect() == []


def test_recall_on_the_table(spark, folder):
    for sf in (folder, folder.replace("0.001", "0.1")):
        rows = spark.read.parquet(f"{sf}/embeddings.parquet").toPandas()
        x, ids = np.array(rows["embedding"].tolist(), float), rows["vec_id"].to_numpy()
        found = result(neighbours.op10_hash_prefix_forest(spark, sf))
        hits = total = 0
        for i in np.flatnonzero(ids % 20 == 0):
            scores = x @ x[i]
            scores[i] = -9
            best = set(ids[np.argsort(-scores)[:20]].tolist())
            hits, total = hits + len(best & {j for j, _ in found[ids[i]]}), total + len(best)
            assert all(abs(s - float(x[np.flatnonzero(ids == j)[0]] @ x[i])) < 1e-12 for j, s in found[ids[i]])
        assert hits >= 0.93 * total


def test_many_copies_of_a_vector_dont_crowd_out_others(spark):
    r = np.random.default_rng(2)
    rows = [(i, v.tolist()) for i, v in enumerate(r.standard_normal((1500, 32)))]
    rows += [(2000 + i, rows[7][1]) for i in range(700)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    queries = rows[:40]
    found = result(neighbours.search(df, df.where("vec_id < 40"), k=20))
    expected = brute(rows, queries, 20)
    hits = sum(len({i for i, _ in expected[q]} & {i for i, _ in found[q]}) for q, _ in queries)
    assert hits >= 0.9 * 20 * len(queries)
    assert found[7] == [(2000 + i, found[7][0][1]) for i in range(20)]


def test_blocks_and_shards_meet_without_a_join_and_each_is_copied_few_times(spark):
    """A join of them was planned by the size of the blocks before each was repeated for every shard, and was broadcast."""
    r = np.random.default_rng(3)
    rows = [(i, v.tolist()) for i, v in enumerate(r.standard_normal((600, 8)))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = neighbours.search(df, df.where("vec_id < 200"), k=5, share=1e9, shard_rows=10, block_rows=5)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Broadcast" not in plan
    assert result(found) == {q: [(i, s) for i, s in best] for q, best in exact(rows, rows[:200], 5).items()}
    for tasks in (1, 24, 1000):
        for shards, blocks, ratio in ((1, 1, 20), (26, 11, 20), (300, 121, 20), (300, 2400, 1)):
            turns, groups = neighbours._grid(shards, blocks, 2 << 20, ratio, tasks)
            assert 1 <= turns <= blocks and 1 <= groups <= shards and shards / groups <= 64
            assert turns * groups >= min(tasks, blocks * groups) and (turns - 1) * groups < tasks


def exact(rows, queries, k):
    out = {}
    for q, v in queries:
        scores = sorted((-float((np.array(v) * np.array(w)).sum()), i) for i, w in rows if i != q)
        out[q] = [(i, -s) for s, i in scores[:k]]
    return out


def test_trees_ascend_to_the_longest_prefix_that_holds_enough():
    r = np.random.default_rng(4)
    vectors, queries = r.standard_normal((200, 6)), np.r_[r.standard_normal((40, 6)), [[1e3] * 6]]
    forest = neighbours.Forest(np.arange(200), vectors, 8, 16)
    strings = neighbours._strings(np.c_[queries / np.linalg.norm(queries, axis=1, keepdims=True) * forest.length, np.zeros(41)], 8, 16)
    for enough in (1, 30, 900, 10 ** 6):
        low, high = forest.ranges(queries, enough)
        for q in range(41):
            for rest in range(17):
                held = [np.flatnonzero(s >> rest == x >> rest) for s, x in zip(forest.sorted, strings[:, q])]
                if sum(map(len, held)) >= enough or rest == 16:
                    break
            assert [len(h) for h in held] == (high - low)[:, q].tolist()
            assert all(h[0] == a for h, a in zip(held, low[:, q]) if len(h))
        seen = forest._seen(low, high)
        assert all(set(np.flatnonzero(seen[q])) == {int(v) for t in range(8) for v in forest.order[t, low[t, q]:high[t, q]]}
                   for q in range(41))
