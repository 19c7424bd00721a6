"""Nearest neighbours by a forest of hash prefixes.

Rows are dealt by a hash of their id into shards of bounded size. In a shard every distinct vector gets one long hash
string per tree, the signs of random projections, and a tree is the sorted array of its strings. A query descends each
tree by binary search to the vectors that share the longest prefix with its own string; then all trees ascend together,
one bit at a time, until the prefixes they have reached hold enough vectors. The candidates of all trees are compared
with the query itself, in double precision, and the best of all shards are the answer.

A task builds the trees of a group of shards once and then takes blocks of queries one after the other. Every block meets
every group, so the groups are as large as memory allows, and both sides are copied no more often than it takes to keep all
tasks busy; nothing is joined or broadcast. How many candidates are enough is a share of the shard, so that recall does not
depend on the number of rows. Inner products are turned into angles by one more coordinate that gives all vectors one length.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql import Window as W

from quayline.llm.common import shuffle_partitions, table, written

TREES, BITS = 40, 32
SHARE = 0.9  # candidates, counted once per tree that finds them, by vectors of the shard
SHARD, BLOCK = 2048, 256
HELD = 128 << 20  # bytes of trees and vectors that a task holds
AT_ONCE = 32  # queries whose candidates are marked at once
SEED = 20


def valid(vector: Column) -> Column:
    """Neither NULL nor empty nor zero, and without NULL, NaN or infinite components."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & F.coalesce(fine, F.lit(False)) & F.exists(vector, lambda x: x != 0)


def _planes(size: int, trees: int, bits: int) -> np.ndarray:
    return np.random.default_rng([SEED, size]).standard_normal((size + 1, trees * bits))


def _strings(x: np.ndarray, trees: int, bits: int) -> np.ndarray:
    """Hash strings, one row per tree, as integers whose high bits come first."""
    signs = (x @ _planes(x.shape[1] - 1, trees, bits) > 0).reshape(len(x), trees, bits)
    return (signs @ (1 << np.arange(bits - 1, -1, -1, dtype=np.int64))).T


def _exact(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products that are equal for equal vectors, wherever they stand."""
    return (vectors * query).sum(axis=1)


class Forest:
    """The trees of one shard."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, trees: int = TREES, bits: int = BITS, most: int = 0):
        order = np.argsort(ids, kind="stable")
        kinds: dict[bytes, list[int]] = {}
        for i in order:
            kinds.setdefault(vectors[i].tobytes(), []).append(int(ids[i]))
        self.ids = [v[:most] if most else v for v in kinds.values()]  # copies beyond k + 1 can't be among the k
        self.vectors = np.array([np.frombuffer(k) for k in kinds]).reshape(len(kinds), -1)
        self.trees, self.bits = trees, bits
        square = (self.vectors ** 2).sum(axis=1)
        self.length = np.sqrt(square.max(initial=0))
        lifted = np.c_[self.vectors, np.sqrt(np.maximum(self.length ** 2 - square, 0))]
        strings = _strings(lifted, trees, bits)
        self.order = np.argsort(strings, axis=1, kind="stable")
        self.sorted = np.take_along_axis(strings, self.order, axis=1)

    def ranges(self, queries: np.ndarray, enough: int) -> tuple[np.ndarray, np.ndarray]:
        """Per query and tree the range of sorted strings that the query has reached when it has enough."""
        norm = np.sqrt((queries ** 2).sum(axis=1, keepdims=True))
        strings = _strings(np.c_[queries / norm * self.length, np.zeros(len(queries))], self.trees, self.bits)
        # ranges grow as prefixes get shorter: the longest prefix that has enough is found by halving, 0 bits if none has
        least, most = np.zeros(len(queries), np.int64), np.full(len(queries), self.bits)
        while (open_ := least < most).any():
            depth = (least + most + 1) // 2
            low, high = self._at(strings, depth)
            fine = (high - low).sum(axis=0) >= enough
            least, most = np.where(open_ & fine, depth, least), np.where(open_ & ~fine, depth - 1, most)
        return self._at(strings, least)

    def _at(self, strings: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the first ``depth`` bits of each query's strings stand in the sorted ones."""
        rest = self.bits - depth
        first = strings >> rest << rest
        last = first + (np.int64(1) << rest)
        return (np.array([np.searchsorted(s, f) for s, f in zip(self.sorted, first)]),
                np.array([np.searchsorted(s, f) for s, f in zip(self.sorted, last)]))

    def _seen(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Per query which vectors its ranges hold."""
        seen, kinds = np.zeros((low.shape[1], len(self.vectors)), bool), len(self.vectors)
        for q in range(0, low.shape[1], AT_ONCE):
            some = slice(q, q + AT_ONCE)
            sizes = (high - low)[:, some].ravel()
            places = (low[:, some] + np.arange(self.trees)[:, None] * kinds).ravel()
            at = np.arange(sizes.sum()) + np.repeat(places - (sizes.cumsum() - sizes), sizes)
            rows = np.repeat(np.tile(np.arange(len(seen))[some] * kinds, self.trees), sizes)
            seen.ravel()[self.order.ravel()[at] + rows] = True
        return seen

    def nearest(self, own: np.ndarray, queries: np.ndarray, k: int, enough: int) -> Iterator[tuple[int, int, float]]:
        """For each query (number, id, score) of its best, ties to smaller ids; ``own`` ids are left out."""
        if not len(self.vectors):
            return
        seen = self._seen(*self.ranges(queries, enough))
        rough = np.where(seen, queries @ self.vectors.T, -np.inf)
        if len(self.vectors) > k + 1:
            at = len(self.vectors) - k - 1
            least = np.partition(rough, at, axis=1)[:, at:at + 1]
            seen &= rough >= least - 1e-9 * (1 + np.abs(least))
        for q, query in enumerate(queries):
            at = np.flatnonzero(seen[q])
            found = [(-s, i) for s, v in zip(_exact(self.vectors[at], query).tolist(), at) for i in self.ids[v] if i != own[q]]
            for s, i in sorted(found)[:k]:
                yield q, i, -s


def _packed(df: DataFrame, number: str, *group: str) -> DataFrame:
    """Rows of a group as two binary columns: ids and vectors of the kind ``number``."""
    def pack(keys: tuple[pa.Scalar, ...], batch: pa.Table) -> pa.Table:
        batch = batch.combine_chunks()
        vectors = batch.column("_vector").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(number)
        ids = batch.column("_id").to_numpy().astype("<i8")
        return pa.table({**{g: pa.array([k.as_py()], pa.int32()) for g, k in zip(group, keys)},
                         "ids": pa.array([ids.tobytes()], pa.binary()), "vectors": pa.array([vectors.tobytes()], pa.binary())})

    return df.groupBy(*group).applyInArrow(pack, ", ".join(f"{g} int" for g in group) + ", ids binary, vectors binary")


def _grid(shards: int, blocks: int, held: int, rows_per_query: float, tasks: int) -> tuple[int, int]:
    """In how many turns the queries come, which is how often shards are copied, and in how many groups the shards lie, which
    is how often queries are.

    Together they make about ``tasks`` meetings, or more where a group would pass ``HELD`` with ``held`` bytes a shard. A query
    with its answers weighs about as much as four rows.
    """
    groups = max(-(-shards // max(1, HELD // held)), min(shards, math.ceil(math.sqrt(tasks * max(rows_per_query, 1) / 4))))
    return min(blocks, -(-tasks // groups)), groups


def search(rows: DataFrame, queries: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = 20,
           trees: int = TREES, bits: int = BITS, share: float = SHARE, shard_rows: int = SHARD,
           block_rows: int = BLOCK) -> DataFrame:
    """Each query's ``k`` nearest rows found: ``query_id``, ``rank`` from 1, ``key`` and ``score``.

    The largest inner products come first, ties to smaller ids; a query's own id is no candidate, and with too few
    candidates there are fewer ranks. Vectors that are not ``valid``, and rows without an id, take no part. Vectors of
    different sizes are never compared. Of equal query rows one counts; repeated rows are candidates each. Empty tables
    give no rows; other columns play no part.
    """
    kinds = {df.schema[vector].dataType.simpleString() for df in (rows, queries)}
    number, array = ("<f4", "array<float>") if kinds == {"array<float>"} else ("<f8", "array<double>")

    def clean(df: DataFrame) -> DataFrame:
        v = F.col(f"`{vector}`")
        return (df.where(valid(v) & F.col(f"`{key}`").isNotNull())
                .select(F.col(f"`{key}`").cast("long").alias("_id"), v.cast(array).alias("_vector"))
                .withColumn("_size", F.size("_vector")))

    index, asked = clean(rows), clean(queries).dropDuplicates(["_id", "_vector"])
    (indexed, size), questions = index.agg(F.count(F.lit(1)), F.max("_size")).first(), asked.count()
    shards, blocks = (max(1, -(-n // each)) for n, each in ((indexed, shard_rows), (questions, block_rows)))
    turns, groups = _grid(shards, blocks, shard_rows * (8 * (1 + (size or 0)) + 16 * trees), indexed / max(1, questions),
                          shuffle_partitions(rows.sparkSession))
    # repeated ids are spread by their vectors
    dealt = lambda df, n: df.withColumn("_part", F.pmod(F.xxhash64("_id", "_vector"), F.lit(n)).cast("int"))
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = written(_packed(dealt(asked, blocks), number, "_part", "_size"), "queries").select(
        "_part", "_size", "ids", "vectors", F.lit(True).alias("_asks"), F.pmod("_part", F.lit(turns)).alias("_turn"),
        each(groups).alias("_group"))
    right = written(_packed(dealt(index, shards), number, "_part", "_size"), "shards").select(
        "_part", "_size", "ids", "vectors", F.lit(False).alias("_asks"), each(turns).alias("_turn"),
        F.pmod("_part", F.lit(groups)).alias("_group"))

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, forests = None, []
        for batch in batches:
            for r in range(batch.num_rows):
                row = {n: batch.column(n)[r] for n in batch.schema.names}
                turn, group, size, asks, part = (row[c].as_py() for c in (*by, "_asks", "_part"))
                if task != (turn, group, size):
                    task, forests = (turn, group, size), []
                ids = np.frombuffer(row["ids"].as_buffer(), "<i8")
                vectors = np.frombuffer(row["vectors"].as_buffer(), number).reshape(len(ids), size).astype("<f8")
                if not asks:
                    forests.append(Forest(ids, vectors, trees, bits, k + 1))
                    continue
                best: list[list[tuple[int, float]]] = [[] for _ in ids]
                for forest in forests:
                    new = [[] for _ in ids]
                    for q, i, score in forest.nearest(ids, vectors, k, max(2 * k, int(share * len(forest.vectors)))):
                        new[q].append((i, score))
                    best = [sorted(a + b, key=lambda f: (-f[1], f[0]))[:k] for a, b in zip(best, new)]
                lines = [(q, ids[q], i, s) for q, found in enumerate(best) for i, s in found]
                at, query, found, score = zip(*lines) if lines else ((), (), (), ())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part] * len(at), pa.int32()), pa.array(at, pa.int32()), pa.array([size] * len(at), pa.int32()),
                     pa.array(query, pa.int64()), pa.array(found, pa.int64()), pa.array(score, pa.float64())],
                    ["_block", "_at", "_size", "query_id", "_found", "score"])

    by = ["_turn", "_group", "_size"]
    # more partitions than meetings, so that few of them share one; the shards of a meeting come before its queries
    meetings = left.unionByName(right).repartition(4 * turns * groups, *by).sortWithinPartitions(*by, "_asks", "_part")
    best = meetings.mapInArrow(match, "_block int, _at int, _size int, query_id long, _found long, score double")
    order = W.partitionBy("_block", "_at", "_size").orderBy(F.col("score").desc(), "_found")
    return (best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", F.col("_found").alias(key), "score"))


def op10_hash_prefix_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of every twentieth vector."""
    rows = table(spark, sf_dir, "embeddings")
    return search(rows, rows.where(F.col("vec_id") % 20 == 0))
