"""Language-model scores by logistic mixing of hashed-context bit predictors.

The corpus is cut into blocks of texts. A block lists its distinct words, each with the state it is met in, a class of
text guessed online from the frequent words before it. Ranges of the sorted words are the pages of a vocabulary: a page
gets each block's words of its range, adds up how often they occur in training, and later answers with their scores. So
what is exchanged are distinct words per block, never tokens, and a word that is in every text costs one entry a block.

On the pages the bit predictors of ``bitmix`` are trained: tables and the counts of prefixes that span pages in one pass,
mixing weights and their refinement, online and from all other tokens, in a second. A word's probability is the product
over its bits. That looks at no other word, so pairs of neighbouring words are counted too, over all training tokens: a
block sends its distinct pairs, as hashes of 50 bits, to ranges of hashes, which answer with the sums. A word's share of
what follows the word before it is mixed with its own probability, by how often that word was seen. In a text each word is
then mixed with the words before it in the same text, at several rates at once and with and without pairs; what has
predicted the text best so far weighs most.
"""

from __future__ import annotations

import bisect
import hashlib
import math
from collections import defaultdict
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import StorageLevel, TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from quayline.llm import bitmix
from quayline.llm.common import by_frequency, forget, from_planes, id_remainder, key_type, planes, table, whole_text, written

BLOCK_BYTES = 4 << 20
STATES, ANCHORS = 6, 256
ROWS = 2000  # texts in a block of counts
RARE, DOUBTFUL = 1e-5, 100_000  # share of a part's words up to which it keeps a word's count back; words to count again
SPLIT_WORDS = 80_000  # the borders of pages are made from about so many words, of every block alike
RATES = np.array([0.0, 0.04, 0.12, 0.3, 0.6, 0.9])
FOLLOW = (10.0, 300.0)  # so many tokens' weight has a word's own probability beside the counts of what follows a word
PAIR_BITS = 50  # of 10^9 different pairs fewer than a thousand share a hash with another
PARTS = 64
PART_TOKENS = 200_000
LOG10_2, LN10 = math.log10(2), math.log(10)
LEADS = [[bytes([i + 1]) for i in range(8) if m >> i & 1] for m in range(256)]  # the bytes of the states in a set of them
LONG_WORD = 64  # bytes up to which words are hashed together

Evidence = dict[bytes, np.ndarray]


def split_words(texts: pa.Array) -> pa.ListArray:
    """The words of texts in lower case, without the end; there may be empty ones at the sides."""
    return pc.ascii_split_whitespace(pc.ascii_lower(texts))


def parts_of(texts: pa.Array) -> Iterator[pa.Array]:
    """Texts in runs of at most ``ROWS`` and, but for a longer text alone, ``BLOCK_BYTES``."""
    ends, start = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False), dtype=np.int64), 0
    while start < len(texts):
        before = ends[start - 1] if start else 0
        end = min(start + ROWS, max(start + 1, int(np.searchsorted(ends, before + BLOCK_BYTES, "right"))))
        yield texts.slice(start, end - start)
        start = end


def word_counts(docs: DataFrame, share: float = 0.0, wanted: list[str] | None = None) -> DataFrame:
    """How often all texts have each word, or each of ``wanted``, and what bounds the rest: a part of the texts keeps back
    the counts of words with at most ``share`` of its tokens. ``cut`` adds up what the parts that passed a word on may keep
    back of others, so a word's count is at most ``n`` and the NULL word's ``cut`` without its own, and ``n`` if both agree.
    """
    only = None if wanted is None else pa.array(wanted, pa.string())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in parts_of(batch.column(0)):
                words = split_words(texts).flatten()
                most = int(len(words) * share)
                if only is not None:
                    words = words.filter(pc.is_in(words, only))
                found = pc.value_counts(words)
                found = found.filter(pc.greater(found.field("counts"), most))
                word, n = found.field("values").cast(pa.string()), found.field("counts")
                yield pa.RecordBatch.from_arrays([
                    pa.concat_arrays([word, pa.nulls(1, pa.string())]), pa.concat_arrays([n, pa.array([0], pa.int64())]),
                    pa.array([most] * (len(n) + 1), pa.int64())], ["word", "n", "cut"])

    return (docs.select("_text").mapInArrow(count, "word string, n long, cut long").where("word is null or word != ''")
            .groupBy("word").agg(F.sum("n").alias("n"), F.sum("cut").alias("cut")))


def frequent_words(docs: DataFrame) -> list[str]:
    """The ``ANCHORS`` commonest words of all texts, of equally common ones the first, in the order of their letters.

    Words that are rare in a part of the texts are not passed on. Where that leaves in doubt which words are the commonest,
    those that may be are counted again, and all words if these are too many.
    """
    def commonest(counts: DataFrame) -> list:
        return counts.where("word is not null").orderBy(F.desc("n"), "word").limit(ANCHORS).collect()

    counts = word_counts(docs, RARE).persist(StorageLevel.DISK_ONLY)
    top, rest = commonest(counts), counts.where("word is null").first()
    kept_back = rest["cut"] if rest else 0
    if kept_back:
        least = top[-1]["n"] if len(top) == ANCHORS else 0
        maybe = counts.where("word is not null").where(F.col("n") - F.col("cut") + kept_back >= least)
        if least <= kept_back or (number := maybe.count()) > DOUBTFUL:
            top = commonest(word_counts(docs))
        elif number > ANCHORS and not maybe.where(F.col("cut") < kept_back).isEmpty():
            top = commonest(word_counts(docs, wanted=[r["word"] for r in maybe.select("word").collect()]))
    counts.unpersist()
    return sorted(r["word"] for r in top)


def anchor_counts(docs: DataFrame, anchors: list[str]) -> DataFrame:
    """How often each text has each anchor, texts with none left out, in numbered blocks of at most ``ROWS`` texts."""
    wanted = pa.array(anchors, pa.string())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for texts in parts_of(batch.column(0)):
                words = split_words(texts)
                at = pc.index_in(words.flatten(), wanted)
                there = at.is_valid().to_numpy(zero_copy_only=False)
                row = np.repeat(np.arange(len(words)), pc.list_value_length(words).to_numpy(zero_copy_only=False))[there]
                x = np.bincount(row * len(wanted) + at.drop_null().to_numpy(), minlength=len(words) * len(wanted))
                x = x.reshape(len(words), -1)
                x = x[x.any(axis=1)]
                if len(x):
                    yield pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([len(x)], pa.int64()), pa.array(
                        [zstandard.compress(x.astype("<u4").tobytes(), 1)], pa.binary())], ["number", "n", "x"])
                    number += 1

    return written(docs.select("_text").mapInArrow(count, "number long, n long, x binary"), "anchors")


def learn_states(docs: DataFrame) -> Evidence:
    """Per frequent word how much it speaks for each state: classes of texts by their frequent words, learned from all texts.

    The driver holds the centres; each round is a pass over the counts, from which every task sends a sum.
    """
    anchors = frequent_words(docs)
    if not anchors:
        return {}
    width, blocks = len(anchors), anchor_counts(docs, anchors)
    texts = blocks.agg(F.sum("n").alias("n")).first()["n"]

    def matrix(data: bytes) -> tuple[np.ndarray, np.ndarray]:
        x = np.frombuffer(zstandard.decompress(data), "<u4").reshape(-1, width).astype(float)
        return x, np.sqrt(x / x.sum(axis=1, keepdims=True))

    def farthest(centres: list[np.ndarray]) -> np.ndarray:
        def least(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for number, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    unit = matrix(data)[1]
                    near = np.max([unit @ c for c in centres], axis=0)
                    at = int(np.argmin(near))
                    yield pa.RecordBatch.from_arrays([pa.array([near[at]], pa.float64()), pa.array([number], pa.int64()),
                                                      pa.array([unit[at].tobytes()], pa.binary())], ["near", "number", "unit"])

        row = (blocks.select("number", "x").mapInArrow(least, "near double, number long, unit binary")
               .orderBy("near", "number").first())
        return np.frombuffer(bytes(row["unit"]))

    centres = [matrix(bytes(blocks.orderBy("number").first()["x"]))[1][0]]
    while len(centres) < min(STATES, texts):  # the text least like any so far
        centres.append(farthest(centres))
    centres = np.array(centres)

    def shares(centres: np.ndarray) -> np.ndarray:
        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((len(centres), 2 * width + 1))
            for batch in batches:
                for data in batch.column(0).to_pylist():
                    x, unit = matrix(data)
                    own = np.eye(len(centres))[np.argmax(unit @ centres.T, axis=1)].T
                    total[:, :width] += own @ unit
                    total[:, width:-1] += own @ x
                    total[:, -1] += own.sum(axis=1)
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId() % PARTS], pa.int32()),
                                              pa.array([total.tobytes()], pa.binary())], ["slot", "value"])

        found = summed(blocks.select("x").mapInArrow(add, "slot int, value binary"))
        return sum(found[slot] for slot in sorted(found)).reshape(len(centres), -1)

    found = None
    for _ in range(20):
        last, found = found, shares(centres)
        if last is not None and np.array_equal(last[:, width:], found[:, width:]):
            break  # the classes stay as they are
        sums = found[:, :width] + 1e-9
        centres = sums / np.linalg.norm(sums, axis=1, keepdims=True)
    forget(blocks)
    counts = found[:, width:2 * width] + 0.5
    logs = np.rint(1000 * np.log(counts / counts.sum(axis=1, keepdims=True))).astype(np.int32)
    order = np.argsort(-found[:, -1], kind="stable")  # without evidence: the commonest
    return {w.encode(): logs[order, i] for i, w in enumerate(anchors)}


def spaced(words: pa.Array) -> bytes:
    """Words one after another, a blank after each."""
    with_blanks = pc.binary_join_element_wise(words, pa.scalar(b"", pa.binary()), pa.scalar(b" ", pa.binary()))
    first, last = (np.frombuffer(with_blanks.buffers()[1], "<i4")[with_blanks.offset + i] for i in (0, len(with_blanks)))
    return with_blanks.buffers()[2][int(first):int(last)].to_pybytes()


def numbered_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """For every word of every text in lower case, and an empty one that ends each text, its number among the distinct
    words; the texts' numbers of words; and the distinct words, sorted with a blank after each."""
    lists = split_words(texts)
    flat = lists.flatten().dictionary_encode()
    code, known = flat.indices.to_numpy(zero_copy_only=False).astype(np.int32), flat.dictionary.cast(pa.binary())
    end = pc.index(known, pa.scalar(b"", pa.binary())).as_py()
    if end < 0:
        end, known = len(known), pa.concat_arrays([known, pa.array([b""], pa.binary())])
    word = code != end  # not an empty one at the sides
    text = np.repeat(np.arange(len(texts)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    length = np.bincount(text[word], minlength=len(texts)) + 1
    place = np.ones(int(length.sum()), bool)
    place[np.cumsum(length) - 1] = False
    order = pc.sort_indices(pc.binary_join_element_wise(known, pa.scalar(b"", pa.binary()), pa.scalar(b" ", pa.binary())))
    rank = np.empty(len(known), np.int32)
    rank[order.to_numpy()] = np.arange(len(known), dtype=np.int32)
    out = np.full(len(place), rank[end], np.int32)
    out[place] = rank[code[word]]
    return out, length, known.take(order)


def make_blocks(docs: DataFrame, evidence: Evidence, kind: T.DataType) -> DataFrame:
    """Texts in blocks: their keys and lengths, the distinct words with states and training counts, and for every token
    the number of its word."""
    k = len(next(iter(evidence.values()))) if evidence else 1

    def states(code: np.ndarray, length: np.ndarray, known: pa.Array) -> np.ndarray:
        """The state before each token: the one that the frequent words so far speak for most."""
        speak = np.zeros((k, len(known)), np.int32)
        for at, e in zip(pc.index_in(pa.array(list(evidence), pa.binary()), known).to_pylist(), evidence.values()):
            if at is not None:
                speak[:, at] = e
        out, at = np.zeros(len(code), np.uint8), 0
        for text in np.array_split(np.arange(len(length)), max(1, len(code) // PART_TOKENS)):
            n = int(length[text].sum())
            part, start = code[at:at + n], np.cumsum(length[text]) - length[text]
            most = None
            for i in range(k):
                own = speak[i][part]
                so_far = np.cumsum(own, dtype=np.int64) - own
                so_far -= np.repeat(so_far[start], length[text])
                if most is None:
                    most = so_far
                else:
                    out[at:at + n][so_far > most] = i
                    most = np.maximum(most, so_far)
            at += n
        return out

    def block(number: int, keys: list, training: list[bool], texts: list[pa.Array]) -> pa.RecordBatch:
        code, length, known = numbered_words(pa.concat_arrays(texts))
        pair = code * np.int32(k) + states(code, length, known)
        there = np.zeros(len(known) * k, bool)
        there[pair] = True
        pairs, pair = np.flatnonzero(there), (np.cumsum(there, dtype=np.int32) - 1)[pair]
        counts = np.bincount(pair[np.repeat(np.array(training, bool), length)], minlength=len(pairs))
        pair, order = by_frequency(pair, len(pairs))
        met = np.packbits(there.reshape(-1, k), axis=1, bitorder="little")  # per word the states that it is met in
        return pa.RecordBatch.from_arrays([
            pa.array([number], pa.int64()), pa.array([keys], pa.list_(arrow_key)), pa.array([training], pa.list_(pa.bool_())),
            pa.array([length.tolist()], pa.list_(pa.int32())), *[pa.array([v], pa.binary()) for v in (
                planes(pair), planes(order), spaced(known), met.tobytes(), planes(counts))]], schema.names)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        keys, training, texts, size = [], [], [], 0
        for batch in batches:
            key, learn, text, start = *[batch.column(i).to_pylist() for i in range(2)], batch.column(2), 0
            ends = np.cumsum(pc.utf8_length(text).to_numpy(zero_copy_only=False), dtype=np.int64)
            while start < len(text):
                before = ends[start - 1] if start else 0
                end = min(len(text), int(np.searchsorted(ends, before + BLOCK_BYTES - size)) + 1)
                keys += key[start:end]
                training += learn[start:end]
                texts.append(text.slice(start, end - start))
                size, start = size + int(ends[end - 1] - before), end
                if size >= BLOCK_BYTES:
                    yield block(number, keys, training, texts)
                    number, keys, training, texts, size = number + 1, [], [], [], 0
        if keys:
            yield block(number, keys, training, texts)

    schema = T.StructType([
        T.StructField("block", T.LongType()), T.StructField("keys", T.ArrayType(kind)),
        T.StructField("training", T.ArrayType(T.BooleanType())), T.StructField("lengths", T.ArrayType(T.IntegerType())),
        *[T.StructField(n, T.BinaryType()) for n in ("codes", "order", "spelled", "met", "counts")]])
    from pyspark.sql.pandas.types import to_arrow_type
    arrow_key = to_arrow_type(kind)
    return written(docs.select("_key", "_training", "_text").mapInArrow(cut, schema), "blocks")


def borders(blocks: DataFrame) -> list[bytes]:
    """Words that cut the sorted vocabulary into a page for every six blocks, eight at least."""
    number = blocks.count()

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for spelled in batch.column(0).to_pylist():
                words = spelled.split(b" ")[:-1]
                yield pa.RecordBatch.from_arrays([pa.array([words[:: max(1, len(words) // each)]], pa.list_(pa.binary()))], ["w"])

    each = min(200, max(1, SPLIT_WORDS // max(1, number)))
    rows = blocks.select("spelled").mapInArrow(spread, "w array<binary>").collect()
    words, pages = sorted({bytes(w) + b" " for r in rows for w in r["w"]}), max(8, number // 6)
    return sorted({words[len(words) * i // pages] for i in range(1, pages)}) if words else []


def requests(blocks: DataFrame, cuts: list[bytes]) -> DataFrame:
    """What each block asks each page: its words of the page's range, with states and training counts."""
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, spelled, met, counts in zip(*[c.to_pylist() for c in batch.columns]):
                words, counts = [w + b" " for w in spelled.split(b" ")[:-1]], from_planes(counts)
                ends = [0, *[bisect.bisect_left(words, c) for c in cuts], len(words)]
                at = np.r_[0, np.cumsum(np.bitwise_count(np.frombuffer(met, np.uint8)))][ends]
                rows = [(page, number, b"".join(words[a:b]), met[a:b], planes(counts[i:j]))
                        for page, (a, b, i, j) in enumerate(zip(ends, ends[1:], at, at[1:])) if b > a]
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), (
                    pa.int32(), pa.int64(), *[pa.binary()] * 3))], ["page", "block", "spelled", "met", "counts"])

    return blocks.select("block", "spelled", "met", "counts").mapInArrow(
        ask, "page int, block long, spelled binary, met binary, counts binary")


def _asked(spelled: bytes, met: bytes) -> list[bytes]:
    """The words of a request, each led by its state and once per state."""
    return [lead + w for w, m in zip(spelled.split(b" "), met) for lead in LEADS[m]]


def make_pages(asked: DataFrame) -> DataFrame:
    """The vocabulary: per page and state the sorted words, their training counts in the state and in all states."""
    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[bytes, int] = defaultdict(int)
        page = None
        for batch in batches:
            page = batch.column("page")[0].as_py()
            for spelled, met, counts in zip(*[batch.column(c).to_pylist() for c in ("spelled", "met", "counts")]):
                for w, c in zip(_asked(spelled, met), from_planes(counts).tolist()):
                    total[w] += c
        every: dict[bytes, int] = defaultdict(int)
        for w, c in total.items():
            every[w[1:]] += c
        by_state: dict[int, list[bytes]] = defaultdict(list)
        for w in total:
            by_state[w[0]].append(w)
        for state, words in sorted(by_state.items()):
            words.sort(key=lambda w: w + b" ")
            some = state == min(by_state)
            yield pa.RecordBatch.from_arrays([
                pa.array([page], pa.int32()), pa.array([state], pa.int32()), pa.array([words[0]], pa.binary()),
                pa.array([words[-1]], pa.binary()), pa.array([b" ".join(words)], pa.binary()),
                pa.array([np.array([total[w] for w in words], np.int64).tobytes()], pa.binary()),
                pa.array([np.array([every[w[1:]] for w in words], np.int64).tobytes()], pa.binary()),
                pa.array([sum(every.values()) if some else 0], pa.int64()),
                pa.array([sum(c > 0 for c in every.values()) if some else 0], pa.int64())],
                ["page", "state", "first", "last", "words", "counts", "all_counts", "train_tokens", "train_words"])

    return written(asked.groupBy("page").applyInArrow(
        merge, "page int, state int, first binary, last binary, words binary, counts binary, all_counts binary, "
               "train_tokens long, train_words long"), "pages")


def _page(words: bytes, counts: bytes) -> bitmix.Page:
    return bitmix.Page(words.split(b" "), np.frombuffer(counts, np.int64))


def over_pages(pages: DataFrame, work: Callable[[Iterator[tuple]], Iterator[tuple[int, bytes]]]) -> DataFrame:
    """Rows of ``slot`` and ``value`` from a task's pages, each as its number, state, words and counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in zip(*[c.to_pylist() for c in batch.columns]))
        for slot, value in work(rows):
            yield pa.RecordBatch.from_arrays([pa.array([slot], pa.int32()), pa.array([value], pa.binary())],
                                             ["slot", "value"])

    return pages.select("page", "state", "words", "counts").mapInArrow(run, "slot int, value binary")


def summed(parts: DataFrame) -> dict[int, np.ndarray]:
    """The sum of the arrays of each slot; the slots are few."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slot, total = None, None
        for batch in batches:
            for slot, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                value = np.frombuffer(value, np.float64)
                total = value.copy() if total is None else total + value
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([slot], pa.int32()), pa.array([total.tobytes()], pa.binary())],
                                             ["slot", "value"])

    return {r["slot"]: np.frombuffer(bytes(r["value"])) for r in parts.groupBy("slot").applyInArrow(
        add, "slot int, value binary").collect()}


def train_model(spark: SparkSession, pages: DataFrame) -> tuple[bitmix.Model, dict, dict]:
    """The model, the bits every page shares with its neighbours, and the totals of the nodes they share."""
    ends = sorted((bytes(r["first"]) + b" ", bytes(r["last"]) + b" ", r["page"], r["state"])
                  for r in pages.select("first", "last", "page", "state").collect())
    between = [-1, *[bitmix.common_bits(a[1], b[0]) for a, b in zip(ends, ends[1:])], -1]
    shared = {e[2:]: (a, b) for e, a, b in zip(ends, between, between[1:])}
    share = spark.sparkContext.broadcast(shared)  # two numbers a page

    def count(rows: Iterator[tuple]) -> Iterator[tuple[int, bytes]]:
        tables = np.zeros(2 * bitmix.SLOTS)
        for page, state, words, counts in rows:
            bitmix.table_counts(_page(words, counts), tables)
        size = -(-len(tables) // PARTS)
        for i in range(PARTS):
            part = tables[i * size:(i + 1) * size]
            if part.any():
                yield i, part.tobytes()

    found = summed(over_pages(pages, count))
    tables, size = np.zeros(2 * bitmix.SLOTS), -(-2 * bitmix.SLOTS // PARTS)
    for i, part in found.items():
        tables[i * size:i * size + len(part)] = part

    def edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for page, state, words, counts in zip(*[c.to_pylist() for c in batch.columns]):
                nodes = _page(words, counts).edge_nodes(*share.value[page, state])
                if nodes:
                    yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in nodes], pa.int32()),
                        pa.array([k[1] for k in nodes], pa.binary()), pa.array([v[0] for v in nodes.values()], pa.float64()),
                        pa.array([v[1] for v in nodes.values()], pa.float64())], ["depth", "prefix", "total", "ones"])

    nodes = (pages.select("page", "state", "words", "counts")
             .mapInArrow(edges, "depth int, prefix binary, total double, ones double")
             .groupBy("depth", "prefix").agg(F.sum("total").alias("total"), F.sum("ones").alias("ones")))
    outside = {(r["depth"], bytes(r["prefix"])): (r["total"], r["ones"]) for r in nodes.collect()}  # some hundred a page
    given = spark.sparkContext.broadcast((tables.astype(np.float32), outside))

    def learn(rows: Iterator[tuple]) -> Iterator[tuple[int, bytes]]:
        counts32, totals = given.value
        learner = bitmix.Learner.start(counts32[:bitmix.SLOTS], counts32[bitmix.SLOTS:])
        for page, state, words, counts in rows:
            learner.learn(_page(words, counts), totals, *share.value[page, state])
        yield TaskContext.get().partitionId() % PARTS, np.concatenate([
            learner.weighed.ravel(), learner.mass, learner.seen, learner.hits]).tobytes()

    learned = sum(summed(over_pages(pages, learn)).values())
    gates, cells = bitmix.GATES, bitmix.GATES * bitmix.LEVELS
    weighed, mass, seen, hits = np.split(learned, np.cumsum([gates * bitmix.INPUTS, gates, cells]))
    weights = np.where(mass[:, None] > 0, weighed.reshape(gates, -1) / np.maximum(mass, 1e-9)[:, None],
                       bitmix.START_WEIGHTS)
    model = bitmix.Model.finish(tables[:bitmix.SLOTS], tables[bitmix.SLOTS:], weights, seen, hits)
    return model, shared, outside


def score_pages(spark: SparkSession, pages: DataFrame, model: bitmix.Model, shared: dict, outside: dict) -> DataFrame:
    """The pages with the log10 probability of every word."""
    given = spark.sparkContext.broadcast((model, shared, outside))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, shared, outside = given.value
        for batch in batches:
            for page, state, words, counts, every in zip(*[c.to_pylist() for c in batch.columns]):
                logs = model.log10(_page(words, counts), outside, *shared[page, state])
                yield pa.RecordBatch.from_arrays([pa.array([page], pa.int32()), *[pa.array([v], pa.binary()) for v in (
                    words, every, logs.tobytes())]], ["page", "words", "all_counts", "logs"])

    return written(pages.select("page", "state", "words", "counts", "all_counts").mapInArrow(
        score, "page int, words binary, all_counts binary, logs binary"), "scores")


def replies(asked: DataFrame, scored: DataFrame) -> DataFrame:
    """What each page answers each block: counts and scores in the order of the question."""
    def answer(questions: pa.Table, page: pa.Table) -> pa.Table:
        number: dict[bytes, int] = {}
        counts, logs = [], []
        for words, every, log in zip(*[page.column(c).to_pylist() for c in ("words", "all_counts", "logs")]):
            for w in words.split(b" "):
                number[w] = len(number)
            counts.append(np.frombuffer(every, np.int64))
            logs.append(np.frombuffer(log))
        counts, logs = np.concatenate(counts), np.concatenate(logs)
        out = []
        for block, spelled, met in zip(*[questions.column(c).to_pylist() for c in ("block", "spelled", "met")]):
            at = [number[w] for w in _asked(spelled, met)]
            out.append((block, counts[at].astype("<i8").tobytes(), logs[at].astype("<f4").tobytes()))
        block, count, log = zip(*out)
        return pa.table({"block": pa.array(block, pa.int64()), "page": pa.array([questions.column("page")[0].as_py()] * len(
            out), pa.int32()), "counts": pa.array(count, pa.binary()), "logs": pa.array(log, pa.binary())})

    return (asked.drop("counts").groupBy("page").cogroup(scored.groupBy("page"))
            .applyInArrow(answer, "block long, page int, counts binary, logs binary"))


def packed(numbers: np.ndarray) -> bytes:
    """Numbers below 2^64, compressed by the place of their bytes."""
    return zstandard.compress(np.ascontiguousarray(numbers, "<u8").view(np.uint8).reshape(-1, 8).T.tobytes(), 1)


def unpacked(data: bytes) -> np.ndarray:
    """What ``packed`` was given."""
    return np.ascontiguousarray(np.frombuffer(zstandard.decompress(data), np.uint8).reshape(8, -1).T).view("<u8").ravel()


def word_numbers(met: bytes, order: bytes) -> np.ndarray:
    """For the numbers in a block's codes the number of the word."""
    met = np.frombuffer(met, np.uint8)
    return np.repeat(np.arange(len(met), dtype=np.int32), np.bitwise_count(met))[from_planes(order)]


def word_digests(spelled: bytes) -> np.ndarray:
    """A hash of 64 bits for each of the words that a blank follows, eight bytes of all words at a time."""
    flat = np.frombuffer(spelled + bytes(8), np.uint8)
    ends = np.flatnonzero(flat[:len(spelled)] == 32)
    starts = np.r_[0, ends[:-1] + 1][:len(ends)]
    length = ends - starts
    eight = np.ndarray(len(spelled) + 1, "<u8", flat, strides=(1,))  # from every byte on
    out, at = length.astype(np.uint64), np.flatnonzero((length > 0) & (length <= LONG_WORD))
    for j in range(0, LONG_WORD, 8):
        at = at[length[at] > j]
        keep = np.minimum(length[at] - j, 8).astype(np.uint64)
        x = out[at] * np.uint64(0x9E3779B97F4A7C15) ^ eight[starts[at] + j] << (np.uint64(64) - np.uint64(8) * keep)
        x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
        out[at] = x ^ x >> np.uint64(31)
    for i in np.flatnonzero(length > LONG_WORD):
        out[i] = int.from_bytes(hashlib.blake2b(spelled[starts[i]:ends[i]], digest_size=8).digest(), "little")
    return out


def block_pairs(codes: bytes, order: bytes, met: bytes, spelled: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of a block's distinct pairs of a word and the one before it, sorted, and for every token the place of its
    pair. Before a text's first word stands the end of another text, as before a block's first one stands its last end."""
    own = word_digests(spelled)[word_numbers(met, order)][from_planes(codes)]
    both = (np.roll(own, 1) * np.uint64(0x9E3779B97F4A7C15) + own) * np.uint64(0xC2B2AE3D27D4EB4F)
    return np.unique((both ^ (both >> np.uint64(31))) >> np.uint64(64 - PAIR_BITS), return_inverse=True)


def pair_counts(blocks: DataFrame) -> DataFrame:
    """For every block how often each of its pairs occurs in training, by ranges of hashes; their ``page`` is negative."""
    parts = max(8, blocks.count() // 6)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, training, lengths, *block in zip(*[c.to_pylist() for c in batch.columns]):
                pairs, at = block_pairs(*block)
                counts = np.bincount(at[np.repeat(np.array(training, bool), lengths)], minlength=len(pairs))
                part = ((pairs >> np.uint64(PAIR_BITS - 32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
                ends = np.searchsorted(part, np.arange(parts + 1))
                rows = [(i - parts, number, packed(np.diff(pairs[a:b], prepend=np.uint64(0))), planes(counts[a:b]))
                        for i, (a, b) in enumerate(zip(ends, ends[1:])) if b > a]
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), (
                    pa.int32(), pa.int64(), pa.binary(), pa.binary()))], ["page", "block", "pairs", "counts"])

    def answer(questions: pa.Table) -> pa.Table:
        asked = [np.cumsum(unpacked(p.as_py()), dtype=np.uint64) for p in questions.column("pairs")]
        ends, pairs = np.cumsum([len(a) for a in asked]), np.concatenate(asked)
        del asked  # a task has memory for few arrays of all pairs at a time
        order = np.argsort(pairs)
        pairs = pairs[order]
        start = np.flatnonzero(np.r_[True, pairs[1:] != pairs[:-1]])
        sizes = np.diff(start, append=len(pairs))
        del pairs
        total = np.concatenate([from_planes(c.as_py()) for c in questions.column("counts")])
        found = np.add.reduceat(total[order], start, dtype=np.int64)
        del total
        total = np.empty(len(order), np.int64)
        total[order] = np.repeat(found, sizes)
        return pa.table({"block": questions.column("block"), "page": questions.column("page"),
                         "counts": pa.array([packed(c) for c in np.split(total, ends[:-1])], pa.binary()),
                         "logs": pa.array([b""] * len(ends), pa.binary())})

    return (blocks.select("block", "training", "lengths", "codes", "order", "met", "spelled")
            .mapInArrow(ask, "page int, block long, pairs binary, counts binary")
            .groupBy("page").applyInArrow(answer, "block long, page int, counts binary, logs binary"))


def after_word(logs: np.ndarray, pair: np.ndarray, before: np.ndarray) -> list[np.ndarray]:
    """The log10 probability of every token after the word before it, for each of ``FOLLOW``, from its own, the count of
    the pair and that of the word before."""
    out, seen = [], np.flatnonzero(pair)
    known, pair, after = np.exp(logs[seen] * LN10), pair[seen], before[seen]
    for d in FOLLOW:
        log = logs + np.log(d / (before + d)) / LN10
        log[seen] = np.log((pair + d * known) / (after + d)) / LN10
        out.append(log)
    return out


def text_scores(length: np.ndarray, code: np.ndarray, word: np.ndarray, logs: np.ndarray,
                others: Sequence[np.ndarray] = ()) -> np.ndarray:
    """The log10 probability of each text of a block: each word's own, mixed with the share that the word has of the words
    before it, at every one of ``RATES``; the text's probability is the mean over the rates. ``others`` are further log10
    probabilities of all tokens, which are mixed alike and share in the mean."""
    start = np.cumsum(length) - length
    text = np.repeat(np.arange(len(length)), length)
    place = np.arange(len(code)) - start[text]
    key = text.astype(np.int64) * (int(word.max(initial=0)) + 1) + word[code]
    at, bits = np.arange(len(code)), len(code).bit_length()
    if int(key.max(initial=0)).bit_length() + bits < 64:  # sorted with the place in the number itself, which is quicker
        key = np.sort(key << bits | at)
        order, key = key & (1 << bits) - 1, key >> bits
    else:
        order = np.argsort(key, kind="stable")
        key = key[order]
    new = np.r_[True, key[1:] != key[:-1]]
    before = np.empty(len(code))
    before[order] = at - np.maximum.accumulate(np.where(new, at, 0))
    # in logarithms where the word is new, as a long word's probability is too small for a number
    seen, sums = np.flatnonzero(before), []
    part, where = before[seen] / place[seen], text[seen]
    fresh = np.add.reduceat(((before == 0) & (place > 0)).astype(np.int64), start)  # the first word has none before it
    for single in (logs[code], *others):
        known = np.exp(single[seen] * LN10)
        every = np.add.reduceat(single, start)
        rest = every - np.bincount(where, single[seen], len(length))
        for r in RATES:
            sums.append(rest + fresh * np.log10(1 - r) + np.bincount(
                where, np.log(known + r * (part - known)), len(length)) / LN10 if r else every)
    sums = np.stack(sums)
    best = sums.max(axis=0)
    return best + np.log10(np.mean(10.0 ** (sums - best), axis=0))


def score_texts(docs: DataFrame, training: Column, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row's ``key``, ``training``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score`` and
    ``bits_per_byte``.

    The model learns from the rows where ``training`` holds and scores all, whole. A NULL text is empty, and an empty text
    is its end alone. Without training rows every count is 0 and bits are even. Repeated rows count and are scored each.
    An empty table gives no rows; other columns play no part.
    """
    spark, kind = docs.sparkSession, key_type(docs, key)
    docs = docs.select(F.col(f"`{key}`").alias("_key"), F.coalesce(training, F.lit(False)).alias("_training"),
                       whole_text(f"`{text}`").alias("_text"))
    blocks = make_blocks(docs, learn_states(docs.where("_training")), kind)
    asked = requests(blocks, borders(blocks))
    pages = make_pages(asked)
    size = pages.agg(F.sum("train_tokens").alias("n"), F.sum("train_words").alias("v")).first()
    n, v = size["n"] or 0, size["v"] or 0
    answers = replies(asked, score_pages(spark, pages, *train_model(spark, pages))).unionByName(pair_counts(blocks))

    def finish(answer: pa.Table, block: pa.Table) -> pa.Table:
        answer = answer.sort_by("page")
        pairs = answer.filter(pc.less(answer.column("page"), 0))
        answer = answer.slice(len(pairs))
        row = block.to_pylist()[0]
        order, met = from_planes(row["order"]), np.frombuffer(row["met"], np.uint8)
        count = np.frombuffer(b"".join(answer.column("counts").to_pylist()), "<i8")[order]
        logs = np.frombuffer(b"".join(answer.column("logs").to_pylist()), "<f4")[order].astype(np.float64)
        word = word_numbers(row["met"], row["order"])
        letters = np.diff(np.flatnonzero(np.frombuffer(row["spelled"], np.uint8) == 32), prepend=-1)[word]  # with the blank
        single = np.log10((count + 1) / (n + v + 1))
        code, length, at, parts = from_planes(row["codes"]), np.array(row["lengths"]), 0, []
        pair = np.concatenate([unpacked(c) for c in pairs.column("counts").to_pylist()])[
            block_pairs(*[row[c] for c in ("codes", "order", "met", "spelled")])[1]]
        before = np.roll(count[code], 1)
        for text in np.array_split(np.arange(len(length)), max(1, len(code) // PART_TOKENS)):
            part, own = code[at:at + int(length[text].sum())], length[text]
            start, here, at = np.cumsum(own) - own, slice(at, at + len(part)), at + len(part)
            parts.append([np.add.reduceat(values[part], start) for values in (letters, (count > 0).astype(np.int64), single)]
                         + [text_scores(own, part, word, logs, after_word(logs[part], pair[here], before[here]))])
        size, known, base, score = (np.concatenate(p) for p in zip(*parts))
        return pa.table({
            key: block.column("keys").combine_chunks().flatten(), "training": pa.array(row["training"], pa.bool_()),
            "n_tokens": pa.array(length, pa.int64()), "n_known": pa.array(known, pa.int64()),
            "train_tokens": pa.array([n] * len(length), pa.int64()), "base_score": pa.array(base, pa.float64()),
            "score": pa.array(score, pa.float64()), "bits_per_byte": pa.array(-score / LOG10_2 / size, pa.float64())})

    schema = T.StructType([
        T.StructField(key, kind), T.StructField("training", T.BooleanType()),
        *[T.StructField(c, T.LongType()) for c in ("n_tokens", "n_known", "train_tokens")],
        *[T.StructField(c, T.DoubleType()) for c in ("base_score", "score", "bits_per_byte")]])
    whole = blocks.select("block", "keys", "training", "lengths", "codes", "order", "met", "spelled")
    return answers.groupBy("block").cogroup(whole.groupBy("block")).applyInArrow(finish, schema)


def op4_context_mixing_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The score of every document."""
    scored = score_texts(table(spark, sf_dir, "documents"), id_remainder("doc_id", 7) != 2)
    return scored.select("doc_id", (~F.col("training")).alias("held_out"), "n_tokens", "n_known", "train_tokens",
                         "base_score", "score", "bits_per_byte")
