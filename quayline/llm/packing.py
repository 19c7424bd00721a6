"""Best-fit packing by linear grouping.

Documents become token sequences, long ones are cut into pieces of the capacity, and pieces are put together so that few
sequences are needed. Only how many pieces have each length matters for that, at most ``capacity`` numbers:

1. Lengths over ``capacity / 8`` are large. In falling order they are dealt into groups of equal cardinality, and every
   group is rounded up to its greatest length, which leaves few sizes.
2. Configurations, the multisets of sizes that fit a sequence, are optimised for these sizes by a linear programme with
   generated columns. Its solution is rounded down to whole sequences.
3. Pieces take the places of a configuration: the longest left that is no longer than the place's size and, in the last
   place, no longer than the room that the others have left.
4. What is left over and all small pieces go, longest first, to the sequence with the least room that fits.

The result is a list of ranges, "of length l the pieces ranked a to b go to the sequences c to c + b - a at an offset",
whose size depends on the capacity alone. Pieces are ranked within their length by counts per task, and not shuffled.
"""

from __future__ import annotations

import base64
import re
import zlib
from array import array
from collections import defaultdict
from collections.abc import Iterator, Mapping

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql import Window as W

from quayline.llm.common import key_type, small_or_joined, table, whole_text, written

CAPACITY = 1024
END = 2
GROUPS = 128
SMALL_SHARE = 8
DOCS_AT_A_TIME = 256

_encoders: dict[str, "Encoder"] = {}


class Encoder:
    """Token ids of texts, as the tokenizer in the file ``path`` gives them without added special tokens.

    ``ranks`` is the same vocabulary for a library that is several times faster. Both agree on every text of characters
    up to U+024F that doesn't spell the special token, which a test checks; other texts go to the tokenizer itself.
    """

    UNLIKE = re.compile("[^\x00-\u024f]|<\\|endoftext\\|>")

    def __init__(self, path: str, ranks: str | None):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.fast = None
        if ranks:
            import public_tokenizers
            import tiktoken
            with open(ranks, "rb") as lines:
                merges = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
            self.fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=merges,
                                          special_tokens={})

    def encode(self, text: str) -> list[int]:
        if self.fast and not self.UNLIKE.search(text):
            return self.fast.encode_ordinary(text)
        return self.tokenizer.encode(text, add_special_tokens=False).ids


def encoder(path: str, ranks: str | None) -> Encoder:
    """One encoder per worker."""
    if path not in _encoders:
        _encoders[path] = Encoder(path, ranks)
    return _encoders[path]


def tokenizer_files() -> tuple[str, str]:
    """The tokenizer and the ranks of its vocabulary."""
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


def pieces(docs: DataFrame, key: str = "doc_id", text: str = "text", tokenizer: tuple[str, str | None] | None = None,
           capacity: int = CAPACITY, end: int = END, payload: str = "ids") -> DataFrame:
    """The pieces of every document: ``_key``, ``piece``, ``start``, ``length``, ``_rank`` and ``ids`` or ``ids_crc32``.

    ``payload`` says which: the token ids, or only their checksum where that is all a caller needs. The rank counts the
    pieces of one length that the same task made before.
    """
    files = tokenizer or tokenizer_files()
    kind = key_type(docs, key)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, seen = encoder(*files).encode, [0] * (capacity + 1)
        for batch in batches:
            texts, keys = batch.column(1), batch.column(0)
            for at in range(0, len(texts), DOCS_AT_A_TIME):
                row, number, start, length, value, rank = [], [], [], [], [], []
                for i, text in enumerate(texts.slice(at, DOCS_AT_A_TIME).to_pylist(), at):
                    ids = array("I", encode(text))
                    ids.append(end)
                    tokens = len(ids)
                    begin, stop = 0, tokens % capacity or min(tokens, capacity)
                    while begin < tokens:
                        row.append(i)
                        number.append(number[-1] + 1 if begin else 0)
                        start.append(begin)
                        length.append(stop - begin)
                        rank.append(seen[stop - begin])
                        seen[stop - begin] += 1
                        part = np.array(ids[begin:stop], "<u4")
                        value.append(zlib.crc32(part) if payload == "ids_crc32" else part.view("<i4"))
                        begin, stop = stop, stop + capacity
                yield pa.RecordBatch.from_arrays(
                    [keys.take(pa.array(row, pa.int64())), pa.array(number, pa.int32()), pa.array(start, pa.int64()),
                     pa.array(length, pa.int32()), pa.array(rank, pa.int64()),
                     pa.array(value, pa.int64() if payload == "ids_crc32" else pa.list_(pa.int32()))],
                    ["_key", "piece", "start", "length", "_rank", payload])

    schema = T.StructType([
        T.StructField("_key", kind), T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()),
        T.StructField("length", T.IntegerType()), T.StructField("_rank", T.LongType()),
        T.StructField(payload, T.LongType() if payload == "ids_crc32" else T.ArrayType(T.IntegerType()))])
    return docs.select(F.col(f"`{key}`"), whole_text(f"`{text}`").alias("_text")).mapInArrow(cut, schema)


def configurations(sizes: list[int], demand: list[int], capacity: int, rounds: int = 3000) -> list[tuple[float, np.ndarray]]:
    """How often each configuration is used in a near-optimal fractional solution: sizes fall, demands are positive.

    The simplex method on the matrix of the present configurations; a knapsack over the dual prices finds the next one.
    """
    s, d = np.array(sizes), np.array(demand, float)
    patterns = np.diag(capacity // s).astype(float)
    inverse = np.diag(1 / np.diag(patterns))
    for _ in range(rounds):
        price = inverse.sum(axis=0)
        best, choice = np.zeros(capacity + 1), np.full(capacity + 1, -1)
        for c in range(int(s[-1]), capacity + 1):
            first = np.searchsorted(-s, -c)  # sizes up to c
            gain = best[c - s[first:]] + price[first:]
            g = int(gain.argmax())
            best[c], choice[c] = (gain[g], first + g) if gain[g] > best[c - 1] + 1e-12 else (best[c - 1], -1)
        if best[capacity] <= 1 + 1e-4:
            break
        new, c = np.zeros(len(s)), capacity
        while c > 0:
            if choice[c] >= 0:
                new[choice[c]] += 1
                c -= s[choice[c]]
            else:
                c -= 1
        use, step = inverse @ d, inverse @ new
        ratio = np.where(step > 1e-9, np.maximum(use, 0) / np.where(step > 1e-9, step, 1), np.inf)
        out = int(ratio.argmin())
        patterns[:, out] = new
        row = inverse[out] / step[out]
        inverse -= np.outer(step, row)
        inverse[out] = row
    use = np.maximum(np.linalg.solve(patterns, d), 0)
    return [(u, patterns[:, j]) for j, u in enumerate(use) if u > 1e-6]


def plan(counts: Mapping[int, int], capacity: int = CAPACITY, groups: int = GROUPS) -> list[tuple[int, int, int, int, int]]:
    """Ranges ``(length, first rank, pieces, first sequence, offset)`` that place every piece once."""
    out: list[tuple[int, int, int, int, int]] = []
    used: dict[int, int] = defaultdict(int)  # pieces of a length that have a place
    room: dict[int, list[list[int]]] = defaultdict(list)  # room left: ranges [first sequence, sequences]
    sequences = counts.get(capacity, 0)
    if sequences:
        out.append((capacity, 0, sequences, 0, 0))
    left = {n: c for n, c in counts.items() if c and n != capacity}

    def put(length: int, pieces: int, first: int, offset: int) -> None:
        out.append((length, used[length], pieces, first, offset))
        used[length] += pieces

    def longest(most: int) -> int:
        """The greatest length up to ``most`` of which pieces are left, or 0."""
        return next((n for n in range(most, 0, -1) if left.get(n, 0) > used[n]), 0)

    large = sorted((n for n in left if n > capacity // SMALL_SHARE), reverse=True)
    if large:
        share, seen = -(-sum(left[n] for n in large) // groups), 0
        demand: dict[int, int] = defaultdict(int)  # a group's greatest length, and how many pieces round up to it
        size = 0
        for n in large:
            rest = left[n]
            while rest:
                if seen % share == 0:
                    size = n
                take = min(rest, share - seen % share)
                demand[size] += take
                rest, seen = rest - take, seen + take
        sizes = list(demand)
        for use, pattern in configurations(sizes, list(demand.values()), capacity):
            number = int(use + 1e-6)
            ranges = [[sequences, number, 0]] if number else []  # first sequence, sequences, tokens in them
            sequences += number
            places = [z for z, times in zip(sizes, pattern) for _ in range(int(times))]
            for i, z in enumerate(places, 1):
                after = []
                for first, many, fill in ranges:
                    # pieces shorter than their size leave room that the last place of a sequence can use
                    while many and (n := longest(z if i < len(places) else capacity - fill)):
                        take = min(many, left[n] - used[n])
                        put(n, take, first, fill)
                        after.append([first, take, fill + n])
                        first, many = first + take, many - take
                    if many:
                        after.append([first, many, fill])
                ranges = after
            for first, many, fill in ranges:
                room[capacity - fill].append([first, many])
    for n in sorted(left, reverse=True):
        rest = left[n] - used[n]
        for free in range(n, capacity + 1):
            while rest and room[free]:
                first, many = room[free][-1]
                each = free // n  # the fullest one takes pieces until it has no room for another
                take = min(many, rest // each)
                if take:
                    for i in range(each):
                        put(n, take, first, capacity - free + i * n)
                    room[free - each * n].append([first, take])
                    rest -= take * each
                elif rest:
                    for i in range(rest):
                        put(n, 1, first, capacity - free + i * n)
                    room[free - rest * n].append([first, 1])
                    rest, take = 0, 1
                room[free][-1] = [first + take, many - take]
                if take == many:
                    room[free].pop()
        each = capacity // n
        take, odd = divmod(rest, each)
        if take:
            for i in range(each):
                put(n, take, sequences, i * n)
            room[capacity - each * n].append([sequences, take])
            sequences += take
        if odd:
            for i in range(odd):
                put(n, 1, sequences, i * n)
            room[capacity - odd * n].append([sequences, 1])
            sequences += 1
    return out


def pack(docs: DataFrame, key: str = "doc_id", text: str = "text", tokenizer: tuple[str, str | None] | None = None,
         capacity: int = CAPACITY, end: int = END, payload: str = "ids") -> DataFrame:
    """Every piece with its ``sequence_id`` and ``offset``; see ``pieces`` for the other columns.

    A NULL text is an empty one, and an empty text is its end token alone. Repeated rows are packed each. A NULL key is
    kept. Only documents longer than the capacity are cut; their first piece may be shorter, and pieces of one document
    may lie in any sequences. An empty table gives no rows; other columns play no part.
    """
    bucket = "_bucket"
    found = written(pieces(docs, key, text, tokenizer, capacity, end, payload)
                    .withColumn(bucket, F.spark_partition_id()), "pieces")
    counts = written(found.groupBy("length", bucket).agg(F.count(F.lit(1)).alias("_count")), "lengths")
    total = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("_count").alias("n")).collect()}
    ranges = sorted(plan(total, capacity))
    at = np.array([r[0] << 44 | r[1] for r in ranges], np.int64)
    first, offset = np.array([r[3] for r in ranges], np.int64), np.array([r[4] for r in ranges], np.int32)

    @F.pandas_udf("sequence_id long, offset int")
    def place(length: pd.Series, ranks: pd.Series) -> pd.DataFrame:
        wanted = length.to_numpy(np.int64) << 44 | ranks.to_numpy(np.int64)
        i = np.searchsorted(at, wanted, "right") - 1
        return pd.DataFrame({"sequence_id": first[i] + wanted - at[i], "offset": offset[i]})

    before = counts.select("length", bucket, F.coalesce(F.sum("_count").over(
        W.partitionBy("length").orderBy(bucket).rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    ranked = (found.join(small_or_joined(written(before, "before")), ["length", bucket])
              .withColumn("_place", place("length", F.col("_rank") + F.col("_before"))))
    return ranked.select(F.col("_key").alias(key), "piece", "start", "length", payload, "_place.sequence_id",
                         F.col("_place.offset").alias("offset"))


def sequences(packed: DataFrame) -> DataFrame:
    """Of pieces with ``ids`` the whole sequences: ``sequence_id`` and ``ids``, at most the capacity each."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))


def op8_linear_grouping_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document with its place."""
    packed = pack(table(spark, sf_dir, "documents"), payload="ids_crc32")
    return packed.select("doc_id", "piece", "start", F.col("length").cast("long").alias("length"), "ids_crc32",
                         "sequence_id", F.col("offset").cast("long").alias("offset"))
