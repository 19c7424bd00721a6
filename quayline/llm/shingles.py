"""Similar texts by word shingles: an exact Jaccard join with signature trees, and the groups that its links form.

1. Texts become blocks of word numbers. A block asks, range by range, which of its shingles other blocks have too, for the
   half of all shingles whose hash is in the lower half. A text with more shingles there that nobody shares than a link
   lets it miss can't be in any link; the others, and only they, go on with their whole sets.
2. Equal sets are one class from here on.
3. Classes are sorted by a minimum hash, which puts similar ones side by side, and every run of neighbours is joined in a
   signature tree; then again, by another minimum hash, for links between the components found. Large groups of near copies
   shrink to a component or a few before any pair of them is formed.
4. What links may still be missing? Those between different components. Two linked classes share one of their first
   shingles, in an order that puts the rarer first. So classes of different components that share one are gathered, and
   joined in signature trees; of such a gathering the largest component is only compared with the rest.

Step 4 is exact for all pairs; step 3 only saves it work.
"""

from __future__ import annotations

from array import array
from collections import defaultdict
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from quayline.llm import signatures
from quayline.llm.common import (
    by_frequency, forget, from_planes, key_type, keyed_rows, one_of_each, planes, shuffle_partitions, small_or_joined, table,
    whole_text, without, written)

WORDS, PERCENT = 5, 75
BLOCK_BYTES = 4 << 20
ROUNDS = 2
WORTH = 0.002  # another round follows one that has found links for such a share of its sets
LEAF_SETS, LEAF_TOKENS = 512, 1 << 20
CHUNK, PIECE = 1024, 8192
HALF = np.uint64(1 << 63)
FACTOR = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """Every bit of the result depends on every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(hashes: np.ndarray, length: np.ndarray, words: int) -> list[np.ndarray]:
    """Of texts, given as hashes of their words one after the other, the sorted distinct hashes of their shingles."""
    start = np.cumsum(length) - length
    rolled = np.zeros(max(0, len(hashes) - words + 1), np.uint64)
    for i in range(words):
        rolled = rolled * FACTOR + hashes[i:i + len(rolled)]
    rolled = mixed(rolled + np.uint64(words))
    out = []
    for s, n in zip(start.tolist(), length.tolist()):
        if n >= words:
            part = np.sort(rolled[s:s + n - words + 1])
            out.append(part[np.r_[True, part[1:] != part[:-1]]])
        elif n:
            whole = np.zeros(1, np.uint64)
            for h in hashes[s:s + n]:
                whole = whole * FACTOR + h
            out.append(mixed(whole + np.uint64(n)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def may_miss(size: int, percent: int) -> int:
    """How many of its shingles a set may have that a linked one has not."""
    return size - -(-size * percent // 100)


def make_blocks(docs: DataFrame, kind: T.DataType) -> DataFrame:
    """Texts in blocks, as numbers of words and the words' hashes."""
    from pyspark.sql.pandas.types import to_arrow_type
    arrow_key = to_arrow_type(kind)

    def block(first: int, keys: list, texts: list[str]) -> pa.RecordBatch:
        known: defaultdict[bytes, int] = defaultdict()
        known.default_factory = known.__len__
        codes, lengths = array("i"), []
        for text in texts:
            words = text.encode("utf-8", "replace").lower().split()
            lengths.append(len(words))
            codes.extend(map(known.__getitem__, words))
        hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, known), np.uint64, len(known))
        code, order = by_frequency(np.frombuffer(codes, np.int32), len(known))
        return pa.RecordBatch.from_arrays([
            pa.array([first], pa.int64()), pa.array([keys], pa.list_(arrow_key)), pa.array([lengths], pa.list_(pa.int32())),
            pa.array([planes(code)], pa.binary()), pa.array([hashes[order].tobytes()], pa.binary())], schema.names)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 40
        keys, texts, size = [], [], 0
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                keys.append(key)
                texts.append(text)
                size += len(text)
                if size >= BLOCK_BYTES:
                    yield block(first, keys, texts)
                    first, keys, texts, size = first + len(keys), [], [], 0
        if keys:
            yield block(first, keys, texts)

    schema = T.StructType([
        T.StructField("block", T.LongType()), T.StructField("keys", T.ArrayType(kind)),
        T.StructField("lengths", T.ArrayType(T.IntegerType())), T.StructField("codes", T.BinaryType()),
        T.StructField("hashes", T.BinaryType())])
    return written(docs.select("_key", "_text").mapInArrow(cut, schema), "blocks")


def _sets(row: dict, words: int) -> list[np.ndarray]:
    hashes = np.frombuffer(row["hashes"], np.uint64)[from_planes(row["codes"])]
    return shingle_sets(hashes, np.array(row["lengths"], np.int64), words)


def _lower_half(sets: list[np.ndarray], ranges: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct hashes of a block that are in the lower half, how many of its sets have each, and where ranges end."""
    low = np.concatenate([s[:np.searchsorted(s, HALF)] for s in sets])
    tokens, count = np.unique(low, return_counts=True)
    return tokens, count, np.searchsorted(tokens >> np.uint64(32), np.arange(ranges + 1) * ((1 << 31) // ranges))


def shared_elsewhere(blocks: DataFrame, ranges: int, words: int) -> DataFrame:
    """Per block and range a byte for each distinct hash of ``_lower_half``: 0 if no other text has it, else how many
    blocks do, on a scale of powers of two. Hashes are compared by 32 bits and the range; one that is only taken for
    another is looked at in vain later."""
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                tokens, count, ends = _lower_half(_sets(row, words), ranges)
                if not len(tokens):
                    continue
                short = (tokens >> np.uint64(32 - ranges.bit_length())).astype(np.uint32)  # the bits below the range's
                at = np.flatnonzero(np.diff(ends))
                yield pa.RecordBatch.from_arrays([
                    pa.array(at, pa.int32()), pa.array([row["block"]] * len(at), pa.int64()),
                    pa.array([planes(np.diff(short[ends[i]:ends[i + 1]], prepend=np.uint32(0))) for i in at], pa.binary()),
                    pa.array([np.packbits(count[ends[i]:ends[i + 1]] > 1).tobytes() for i in at], pa.binary())],
                    ["range", "block", "tokens", "several"])

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, blocks, tokens, several = None, [], [], []
        for batch in batches:
            number = batch.column("range")[0].as_py()
            blocks += batch.column("block").to_pylist()
            tokens += [np.cumsum(from_planes(t), dtype=np.uint32) for t in batch.column("tokens").to_pylist()]
            several += [np.unpackbits(np.frombuffer(s, np.uint8)) for s in batch.column("several").to_pylist()]
        if number is None:
            return
        kinds, count = np.unique(np.concatenate(tokens), return_counts=True)
        scale = np.where(count > 1, np.ceil(np.log2(count)).astype(np.uint8) + 1, 0).astype(np.uint8)
        for block, own, more in zip(blocks, tokens, several):
            seen = np.maximum(scale[np.searchsorted(kinds, own)], more[:len(own)])
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([number], pa.int32()),
                                              pa.array([seen.tobytes()], pa.binary())], ["block", "range", "seen"])

    asked = blocks.select("block", "lengths", "codes", "hashes").mapInArrow(
        ask, "range int, block long, tokens binary, several binary")
    return asked.groupBy("range").applyInArrow(answer, "block long, range int, seen binary")


def make_sets(blocks: DataFrame, kind: T.DataType, ranges: int, words: int, percent: int) -> DataFrame:
    """One row per text: ``row``, ``key``, ``size`` of its set and, where links are possible, the set's ``digest`` and, once
    per block and digest, the set, its first shingles and its minimum hashes."""
    def decide(seen: pa.Table, block: pa.Table) -> pa.Table:
        row = block.to_pylist()[0]
        sets = _sets(row, words)
        tokens, _, _ = _lower_half(sets, ranges)
        parts = seen.sort_by("range").column("seen").to_pylist()
        others = np.frombuffer(b"".join(parts), np.uint8)
        out, known = [], set()
        for own in sets:
            low = own[:np.searchsorted(own, HALF)]
            rank = others[np.searchsorted(tokens, low)]
            spare = may_miss(len(own), percent) - int((rank == 0).sum())
            if not len(own) or spare < 0:
                out.append((len(own), None, None, None, *[None] * ROUNDS))
                continue
            digest = xxhash.xxh3_128_digest(own.tobytes())
            if digest in known:
                out.append((len(own), digest, None, None, *[None] * ROUNDS))
                continue
            known.add(digest)
            # the order: alone (they come first, and match nothing), then rarer first, the upper half last
            order = np.lexsort((low, rank))
            first = np.r_[low[order][int((rank == 0).sum()):], own[len(low):]][:spare + 1]
            least = [int(mixed(own * FACTOR + np.uint64(r)).min() >> np.uint64(1)) for r in range(ROUNDS)]
            out.append((len(own), digest, own.tobytes(), first.tobytes(), *least))
        size, digest, whole, first, *least = zip(*out)
        return pa.table({
            "row": pa.array(row["block"] + np.arange(len(out)), pa.int64()), "key": block.column("keys").combine_chunks().flatten(),
            "size": pa.array(size, pa.int64()), "digest": pa.array(digest, pa.binary()), "tokens": pa.array(whole, pa.binary()),
            "first": pa.array(first, pa.binary()), **{f"least{r}": pa.array(v, pa.int64()) for r, v in enumerate(least)}})

    schema = T.StructType([
        T.StructField("row", T.LongType()), T.StructField("key", kind), T.StructField("size", T.LongType()),
        *[T.StructField(c, T.BinaryType()) for c in ("digest", "tokens", "first")],
        *[T.StructField(f"least{r}", T.LongType()) for r in range(ROUNDS)]])
    return written(shared_elsewhere(blocks, ranges, words).groupBy("block").cogroup(blocks.groupBy("block"))
                   .applyInArrow(decide, schema), "sets")


def components(pairs: DataFrame) -> DataFrame:
    """``id`` and ``component``, the smallest id reachable, of every id in the pairs ``a``, ``b``.

    Ids take over the smallest of their neighbours' components, and then that of the id they have taken over.
    """
    both = written(pairs.select("a", "b").union(pairs.select("b", "a")).where("a != b").distinct(), "edges")
    now = written(both.groupBy(F.col("a").alias("id")).agg(F.least("id", F.min("b")).alias("component")), "components")
    while True:
        near = both.join(now, F.col("a") == F.col("id")).groupBy(F.col("b").alias("id")).agg(
            F.min("component").alias("near"))
        own = now.join(near, "id").select("id", "component", F.least("component", "near").alias("better"))
        far = now.select(F.col("id").alias("better"), F.col("component").alias("far"))
        new = written(own.join(far, "better").select("id", F.least("better", "far").alias("new"), "component"), "components")
        if new.where("new != component").isEmpty():
            return new.select("id", "component")
        now = new.select("id", F.col("new").alias("component"))


def _unite(classes: DataFrame, found: DataFrame) -> DataFrame:
    """``class`` and its component, after more links between components."""
    of = components(found).select(F.col("id").alias("component"), F.col("component").alias("united"))
    return written(classes.join(of, "component", "left").select(
        "class", F.coalesce("united", "component").alias("component")), "united")


def neighbour_links(sets: DataFrame, least: str, percent: int) -> DataFrame:
    """Links between components found in runs of sets that are neighbours by a minimum hash and their size."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, sets, size = [], [], 0

        def leaf() -> pa.RecordBatch:
            found = signatures.links(sets, np.array(ids), percent)
            return pa.RecordBatch.from_arrays([pa.array([ids[i] for i, _ in found], pa.int64()),
                                               pa.array([ids[j] for _, j in found], pa.int64())], ["a", "b"])

        for batch in batches:
            for number, tokens in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids.append(number)
                sets.append(np.frombuffer(tokens, np.uint64))
                size += len(sets[-1])
                if len(sets) >= LEAF_SETS or size >= LEAF_TOKENS:
                    yield leaf()
                    ids, sets, size = [], [], 0
        if len(sets) > 1:
            yield leaf()

    parts = shuffle_partitions(sets.sparkSession)
    return (sets.select("component", "tokens", least, "size", "class").repartitionByRange(parts, least, "size", "class")
            .sortWithinPartitions(least, "size", "class").select("component", "tokens").mapInArrow(run, "a long, b long"))


def first_posts(classes: DataFrame) -> DataFrame:
    """A row per class and each of its first shingles that another class has among its own, too."""
    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first = [np.frombuffer(f, np.int64) for f in batch.column(1).to_pylist()]
            row = pa.array(np.repeat(np.arange(len(first)), [len(f) for f in first]))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(row), pa.array(
                np.concatenate(first) if first else [], pa.int64())], ["class", "token"])

    posts = classes.select("class", "first").mapInArrow(spread, "class long, token long")
    common = posts.groupBy("token").agg(F.min("class").alias("low"), F.max("class").alias("high")).where("low != high")
    return written(posts.join(common.select("token"), "token"), "posts")


def _without_equals(lists: DataFrame, by: list[str], *content: str) -> DataFrame:
    """``by`` of one of the lists with the very same content, for each such content."""
    same = lists.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64(*content)).alias("who"),
                                  F.sum(F.xxhash64(*content) % (1 << 31)).alias("who2"))
    return same.groupBy("n", "who", "who2").agg(F.min(F.struct(*by)).alias("by")).select("by.*")


def missing_links(sets: DataFrame, first: DataFrame, united: DataFrame, percent: int) -> DataFrame:
    """All links between classes of different components, or enough to join what they connect."""
    posts = written(first.join(small_or_joined(united), "class"), "posts")
    # tokens of one component have nothing to find; those with the very same classes find the same
    mixed_tokens = (posts.groupBy("token").agg(F.min("component").alias("low"), F.max("component").alias("high"))
                    .where("low != high").select("token"))
    several = written(posts.join(mixed_tokens, "token"), "posts")
    mixed_posts = several.join(_without_equals(several, ["token"], "class"), "token")
    largest = (mixed_posts.groupBy("token", "component").agg(F.count(F.lit(1)).alias("n"))
               .groupBy("token").agg(F.max(F.struct("n", "component")).alias("most"), F.sum("n").alias("all")))
    largest = largest.select(
        "token", F.col("most.component").alias("largest"), F.ceil(F.col("all") / F.lit(PIECE)).cast("int").alias("pieces"),
        F.ceil((F.col("all") - F.col("most.n")) / F.lit(CHUNK)).cast("int").alias("chunks"))
    # who is not in the largest component asks, with some hundred others, all the rest, piece by piece
    spot = lambda n: F.pmod(F.xxhash64("class", F.lit(n)), F.col(n)).cast("int")
    placed = mixed_posts.join(largest, "token").withColumn("own", F.when(
        F.col("component") != F.col("largest"), spot("chunks"))).withColumn("piece", spot("pieces"))
    chunk = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk")
    told = (placed.select("token", "class", "component", "own", "piece", chunk)
            .where(F.col("own").isNull() | (F.col("own") != F.col("chunk"))))
    asking = placed.where(F.col("own").isNotNull()).select(
        "token", "class", "component", F.col("own").alias("chunk"),
        F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)).alias("piece"))
    columns = ["token", "chunk", "piece", "class", "component"]
    gathered = told.select(*columns, F.lit(False).alias("asks")).union(asking.select(*columns, F.lit(True).alias("asks")))

    def trees(batches: Iterator[pa.RecordBatch], work) -> Iterator[pa.RecordBatch]:
        """``work`` on the askers of a chunk, who come first, alone and with as many others at a time as a tree may have."""
        asking: list[dict] = []
        others: list[dict] = []
        size = 0
        for batch in batches:
            for row in batch.to_pylist():
                if row["asks"]:
                    asking.append(row)
                    continue
                others.append(row)
                size += row["size"]
                if len(others) >= LEAF_SETS or size >= LEAF_TOKENS:
                    yield work(asking, others)
                    others, size = [], 0
        if asking and others:
            yield work(asking, others)
        if asking and asking[0]["piece"] == 0:
            yield work(asking, [])

    def ordered(asking: list[dict], others: list[dict]) -> list[dict]:
        return sorted([*asking, *others], key=lambda r: (r["component"], r["size"]))

    def screen(asking: list[dict], others: list[dict]) -> pa.RecordBatch:
        rows = ordered(asking, others)
        number, of, asks = (np.array([r[c] for r in rows]) for c in ("class", "component", "asks"))
        found = [np.zeros((0, 2), np.int64)]
        for i, j in signatures.may_link([np.frombuffer(r["signature"], np.uint64) for r in rows],
                                        np.array([r["size"] for r in rows]), of, percent, asks if others else None):
            # who asks wants the other's component; of two that ask, the one with the greater component
            first = asks[i] & (~asks[j] | (of[i] > of[j]))
            second = asks[j] & ~first
            found += [np.c_[number[i[first]], of[j[first]]], np.c_[number[j[second]], of[i[second]]]]
        pairs = np.unique(np.concatenate(found), axis=0)
        return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["class", "wanted"])

    def compare(asking: list[dict], others: list[dict]) -> pa.RecordBatch:
        rows = ordered(asking, others)
        of = [r["component"] for r in rows]
        found = signatures.links([np.frombuffer(r["tokens"], np.uint64) for r in rows], np.array(of), percent,
                                 np.array([r["asks"] for r in rows]))
        return pa.RecordBatch.from_arrays([pa.array([of[i] for i, _ in found], pa.int64()),
                                           pa.array([of[j] for _, j in found], pa.int64())], ["a", "b"])

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            maps = [signatures.signature(np.frombuffer(t, np.uint64)).tobytes() for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(maps, pa.binary())],
                                             ["class", "size", "signature"])

    def grouped(rows: DataFrame, by: list[str], work, schema: str) -> DataFrame:
        return (rows.repartition(shuffle_partitions(sets.sparkSession), *by).sortWithinPartitions(*by, F.desc("asks"))
                .mapInArrow(_per_group(lambda batches: trees(batches, work), by), schema))

    signed = sets.select("class", "size", "tokens").mapInArrow(sign, "class long, size long, signature binary")
    by = ["token", "chunk", "piece"]
    # which class may link with which component, by signatures: whole sets go only there, a component's once
    wanted = written(grouped(gathered.join(signed, "class"), by, screen, "class long, wanted long").distinct(), "wanted")
    many = (wanted.groupBy("wanted").agg(F.ceil(F.count(F.lit(1)) / F.lit(LEAF_SETS)).cast("int").alias("chunks"))
            .join(united.groupBy(F.col("component").alias("wanted")).agg(
                F.ceil(F.count(F.lit(1)) / F.lit(PIECE)).cast("int").alias("pieces")), "wanted"))
    asking = (wanted.join(many, "wanted").join(united, "class").withColumn("chunk", spot("chunks"))
              .withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1))).withColumn("asks", F.lit(True)))
    told = (united.join(many, united["component"] == many["wanted"]).withColumn("piece", spot("pieces"))
            .withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).withColumn("asks", F.lit(False)))
    by = ["wanted", "chunk", "piece"]
    columns = [*by, "class", "component", "asks"]
    whole = asking.select(*columns).union(told.select(*columns)).join(sets.select("class", "size", "tokens"), "class")
    return grouped(whole, by, compare, "a long, b long").distinct()


def _per_group(work, by: list[str]):
    """``work`` on the rows of each group of a sorted partition, as they stream by."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pieces() -> Iterator[tuple[tuple, pa.RecordBatch]]:
            for batch in batches:
                keys = np.stack([batch.column(c).to_numpy() for c in by])
                edge = np.flatnonzero(np.r_[True, (keys[:, 1:] != keys[:, :-1]).any(axis=0)]) if batch.num_rows else []
                for i, j in zip(edge, [*edge[1:], batch.num_rows]):
                    yield tuple(keys[:, i].tolist()), batch.slice(i, j - i)

        for _, group in groupby(pieces(), key=lambda p: p[0]):
            yield from work(piece for _, piece in group)

    return run


def similar_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS,
                   percent: int = PERCENT) -> DataFrame:
    """Every row's ``key``, ``n_shingles``, ``component_id`` and ``row``.

    Words are what ASCII white space separates, with ASCII letters in lower case. A text's set is its distinct shingles of
    ``words`` words; a shorter text has its whole sequence as one; without words, or NULL, it is empty and links with
    nothing. Two rows link when their sets' Jaccard similarity is ``percent`` or more; ``component_id`` is the smallest key
    reachable by links, one's own included (NULL keys come last). Repeated rows link with each other. An empty table gives
    no rows; other columns play no part. ``row`` numbers the rows.
    """
    kind = key_type(docs, key)
    blocks = make_blocks(docs.select(F.col(f"`{key}`").alias("_key"), whole_text(f"`{text}`").alias("_text")), kind)
    ranges = 1 << max(3, (blocks.count() // 8).bit_length())
    rows = make_sets(blocks, kind, ranges, words, percent)
    forget(blocks)
    classes = written(rows.where(F.col("tokens").isNotNull()).groupBy("digest", "size").agg(
        F.min("row").alias("class"), *[F.any_value(c).alias(c) for c in ("first", *[f"least{r}" for r in range(ROUNDS)])]),
        "classes")
    posts = first_posts(classes)
    # whole sets only of classes that share a first shingle with another
    sets = written(posts.select("class").distinct().join(classes.drop("first", "digest"), "class").join(
        rows.where(F.col("tokens").isNotNull()).select(F.col("row").alias("class"), "tokens"), "class"), "whole_sets")
    marks = written(rows.select("row", "key", "size", "digest"), "marks")
    forget(rows)
    united = sets.select("class", F.col("class").alias("component"))
    for r in range(ROUNDS):
        part = sets.withColumn("component", F.col("class")) if r == 0 else sets.join(small_or_joined(united), "class")
        found = written(neighbour_links(part, f"least{r}", percent), "links")
        number = found.count()
        if number:
            united = _unite(united, found)
        if number < WORTH * sets.count():
            break
    found = written(missing_links(sets, posts, united, percent), "links")
    if not found.isEmpty():
        united = _unite(united, found)
    of = classes.select("digest", "size", "class").join(united, "class", "left").select(
        "digest", "size", F.coalesce("component", "class").alias("component"))
    marked = marks.join(of, ["digest", "size"], "left")
    least = (marked.where(F.col("component").isNotNull()).groupBy("component").agg(F.min("key").alias("least")))
    return (marked.join(least, "component", "left")
            .select(F.col("key").alias(key), F.col("size").alias("n_shingles"),
                    F.coalesce("least", "key").alias("component_id"), "row"))


def one_of_each_group(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each group of similar texts, the one with the smallest key, with all its columns."""
    named, name = keyed_rows(docs, key, text)
    groups = similar_groups(named, name, text)
    dropped = groups.where(F.col(name) != F.col("component_id")).select(name).distinct()
    return without(one_of_each(named, name), name, written(dropped, "dropped"))


def op9_signature_tree_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The group of every document."""
    return similar_groups(table(spark, sf_dir, "documents")).drop("row")


OP9_SQL = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, list_filter(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'),
        lambda w: w <> '') AS w
    FROM documents),
shingles AS (
    SELECT DISTINCT doc_id, hash(shingle) AS short, shingle FROM (
        SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
            ELSE list_transform(generate_series(1, len(w) - 4), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS shingle
        FROM words)),
sizes AS (SELECT doc_id, count(*) AS size FROM shingles GROUP BY doc_id),
common AS (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n FROM shingles a JOIN shingles b
    ON a.short = b.short AND a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
    SELECT x, y FROM common JOIN sizes a ON a.doc_id = x JOIN sizes b ON b.doc_id = y
    WHERE 100 * n >= 75 * (a.size + b.size - n)),
pairs AS (SELECT x, y FROM links UNION SELECT y, x FROM links),
reached AS (SELECT x, y FROM pairs UNION SELECT r.x, b.y FROM reached r JOIN pairs b ON r.y = b.x)
SELECT d.doc_id, coalesce(any_value(s.size), 0) AS n_shingles, least(d.doc_id, min(r.y)) AS component_id
FROM documents d LEFT JOIN sizes s USING (doc_id) LEFT JOIN reached r ON r.x = d.doc_id GROUP BY d.doc_id
"""
