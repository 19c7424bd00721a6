"""Phrase collocations by prefix-free parsing.

Texts are parsed into overlapping chunks whose borders depend on the words alone: a chunk begins wherever the next four
words hash to a trigger, and ends with the four words that begin the next one. Equal passages so become equal chunks,
wherever they stand, and the dictionary of distinct chunks with their frequencies is all that is counted. A phrase of up to
five words belongs to the chunk in whose own part, before the overlap, it begins; that chunk holds all of it, so it is
counted once. Where the borders lie has no influence on the counts.

Counting goes up by length: a phrase can only be frequent if what it holds is. Words and phrases that are frequent get
numbers; while there are at most ``limit`` they are broadcast, and chunks keep only the places that are still open. Beyond
it all phrases of a length are counted as they are. Both ways count every occurrence.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from quayline.llm.common import forget, shuffle_partitions, table, whole_text, written

LONGEST = 5
OVERLAP = LONGEST - 1
AT_LEAST = 100
TOP = 2000
EVERY = 24  # one place in so many is a trigger
LIMIT = 2_000_000  # numbered words or phrases that are broadcast: 16 MB of numbers, some 60 MB of words
BYTES_AT_A_TIME = 1 << 19

WORD, BLANK, BREAK = 0, 1, 2
KIND = np.zeros(256, np.uint8)
KIND[[0x20, 0x09]] = BLANK
KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = BREAK
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20
MIX = np.random.default_rng(20).integers(1, 1 << 62, 256, dtype=np.uint64) | np.uint64(1)  # any odd numbers will do


def parse(texts: list[bytes], every: int = EVERY) -> tuple[np.ndarray, np.ndarray, list[bytes], np.ndarray]:
    """The chunks of texts: which text each is from, how many words it owns, its words joined by blanks, and all its words."""
    data = LOWER[np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)]
    kind = KIND[data]
    inside = kind == WORD
    # words, each followed by one blank, and where they begin and end there
    after = np.zeros(len(data), bool)
    after[1:] = inside[:-1]
    ends = np.flatnonzero(after & ~inside)
    if not len(ends):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), [], np.zeros(0, np.int64)
    starts = np.flatnonzero(inside & ~after)
    size = ends - starts
    stop = np.cumsum(size + 1) - 1
    start = stop - size
    words = data[inside | (after & ~inside)]
    words[stop] = 0x20
    # pieces: words with no break between them
    breaks = np.cumsum(kind == BREAK)[starts]
    count = len(starts)
    piece_end = np.append(np.flatnonzero(np.diff(breaks)) + 1, count)
    until = np.repeat(piece_end, np.diff(np.append(0, piece_end)))  # the end of each word's piece
    # a trigger: four words of one piece whose sums of mixed bytes hash to it
    sums = np.concatenate([[np.uint64(0)], np.cumsum(MIX[words], dtype=np.uint64)])
    word = (sums[stop] - sums[start]) * (2 * size.astype(np.uint64) + np.uint64(1))
    hashed = np.zeros(count, np.uint64)
    for i in range(min(OVERLAP, count)):
        hashed[:count - i] = hashed[:count - i] * MIX[i] + word[i:]
    trigger = (((hashed ^ (hashed >> np.uint64(31))) * MIX[7]) >> np.uint64(33)) % np.uint64(every) == 0
    trigger &= until - np.arange(count) >= OVERLAP
    trigger[np.append(0, piece_end[:-1])] = True
    first = np.flatnonzero(trigger)
    own = np.diff(np.append(first, count))
    last = np.minimum(first + own + OVERLAP, until[first])
    held = words.tobytes()
    chunks = [held[a:b] for a, b in zip(start[first].tolist(), stop[last - 1].tolist())]
    begins = np.cumsum([0] + [len(t) + 1 for t in texts])
    return np.searchsorted(begins, starts[first], "right") - 1, own, chunks, last - first


def dictionary(docs: DataFrame, text: str = "text", group: str = "lang", none: str = "und", every: int = EVERY) -> DataFrame:
    """The distinct chunks of each group: ``_group``, ``_chunk`` (words and blanks), ``_own`` and ``_weight``."""
    rows = docs.select(F.coalesce(F.col(f"`{group}`").cast("string"), F.lit(none)).alias("_group"),
                       whole_text(f"`{text}`").cast("binary").alias("_text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            groups, texts, at = batch.column(0), batch.column(1), 0
            sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False)
            while at < len(texts):
                to = at + max(1, int(np.searchsorted(np.cumsum(sizes[at:]), BYTES_AT_A_TIME)))
                which, own, chunks, _ = parse(texts.slice(at, to - at).to_pylist(), every)
                yield pa.RecordBatch.from_arrays(
                    [groups.take(pa.array(which + at)), pa.array(chunks, pa.binary()).cast(pa.string()),
                     pa.array(own, pa.int32())], ["_group", "_chunk", "_own"])
                at = to

    chunks = rows.mapInArrow(cut, "_group string, _chunk string, _own int")
    return chunks.groupBy("_group", "_chunk", "_own").agg(F.count(F.lit(1)).alias("_weight"))


def windows(size: int) -> Column:
    """The phrases of so many words that begin in a chunk's own part."""
    words = F.split("_chunk", " ")
    last = F.least(F.col("_own"), F.size(words) - (size - 1))
    places = F.when(last >= 1, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>"))
    return F.transform(places, lambda i: F.array_join(F.slice(words, i, size), " "))


def counted(chunks: DataFrame, size: int) -> DataFrame:
    """How often each phrase of so many words occurs, all of them: ``_group``, ``phrase`` and ``a``."""
    return (chunks.select("_group", "_weight", F.explode(windows(size)).alias("phrase"))
            .groupBy("_group", "phrase").agg(F.sum("_weight").alias("a")))


def word_counts(chunks: DataFrame) -> DataFrame:
    """``counted`` for single words."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            split = pc.split_pattern(batch.column("_chunk"), " ")
            sizes = pc.list_value_length(split).to_numpy(zero_copy_only=False)
            row = np.repeat(np.arange(len(sizes)), sizes)
            place = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            groups, coded = batch.column("_group").dictionary_encode(), split.flatten().dictionary_encode()
            group, word = (c.indices.to_numpy(zero_copy_only=False).astype(np.int64) for c in (groups, coded))
            weight = np.where(place < batch.column("_own").to_numpy()[row], batch.column("_weight").to_numpy()[row], 0)
            keys, which = np.unique(group[row] * len(coded.dictionary) + word, return_inverse=True)
            total = np.zeros(len(keys), np.int64)
            np.add.at(total, which, weight)
            some = np.flatnonzero(total)
            group, word = np.divmod(keys[some], len(coded.dictionary)) if len(keys) else (keys, keys)
            yield pa.RecordBatch.from_arrays(
                [groups.dictionary.take(pa.array(group)), coded.dictionary.take(pa.array(word)), pa.array(total[some])],
                ["_group", "phrase", "a"])

    return (chunks.mapInArrow(count, "_group string, phrase string, a long")
            .groupBy("_group", "phrase").agg(F.sum("a").alias("a")))


def number_chunks(chunks: DataFrame, words: pd.DataFrame) -> DataFrame:
    """Chunks as numbers of the frequent words, -1 for other words; those with no two of them together are left out."""
    spark = chunks.sparkSession
    shared = spark.sparkContext.broadcast({
        g: (pa.array(part["phrase"]), part.index.to_numpy(np.int32)) for g, part in words.groupby("_group")})

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            split, groups = pc.split_pattern(batch.column("_chunk"), " "), batch.column("_group").dictionary_encode()
            sizes = pc.list_value_length(split).to_numpy(zero_copy_only=False).astype(np.int64)
            row, which = np.repeat(np.arange(len(sizes)), sizes), groups.indices.to_numpy(zero_copy_only=False)
            found = np.full(len(row), -1, np.int32)
            flat = split.flatten()
            for i, name in enumerate(groups.dictionary.to_pylist()):
                if name in shared.value:
                    known, numbers = shared.value[name]
                    mine = np.flatnonzero(which[row] == i)
                    at = pc.index_in(flat.take(pa.array(mine)), known).fill_null(-1).to_numpy(zero_copy_only=False)
                    found[mine] = np.where(at >= 0, numbers[at], -1)
            pair = (found[:-1] >= 0) & (found[1:] >= 0) & (row[:-1] == row[1:])
            kept = np.unique(row[:-1][pair])
            ends = np.cumsum(sizes).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(np.append(np.int32(0), ends)), pa.array(found))
            rows = pa.array(kept)
            yield pa.RecordBatch.from_arrays(
                [lists.take(rows), batch.column("_own").take(rows), batch.column("_weight").take(rows)],
                ["_words", "_own", "_weight"])

    return chunks.mapInArrow(number, "_words array<int>, _own int, _weight long")


def numbered_counts(numbered: DataFrame, known: list[np.ndarray], words: int) -> DataFrame:
    """Counts of phrases one word longer than the longest in ``known``, of those whose two shorter parts are frequent.

    ``known`` has for two, three ... words the sorted keys of the frequent phrases. A phrase's key is the place of its
    words but the last among the frequent ones, times the number of words, plus the last word.
    """
    shared = numbered.sparkSession.sparkContext.broadcast(known)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("_words")
            sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            row = np.repeat(np.arange(len(sizes)), sizes)
            begins = np.cumsum(sizes) - sizes
            # places where a frequent phrase begins, and its number
            at, number = np.flatnonzero(flat >= 0), flat[flat >= 0]
            for size, keys in enumerate([*shared.value, None], 2):
                after = np.flatnonzero(np.diff(at) == 1)  # the phrase at the next place is frequent too
                end = at[after] + size - 1
                after = after[(end < len(flat)) & (row[np.minimum(end, len(flat) - 1)] == row[at[after]])]
                at, key = at[after], number[after] * words + flat[at[after] + size - 1]
                if keys is not None:
                    place = np.minimum(np.searchsorted(keys, key), max(0, len(keys) - 1))
                    same = keys[place] == key if len(keys) else np.zeros(len(key), bool)
                    at, number = at[same], place[same]
            own = at - begins[row[at]] < batch.column("_own").to_numpy()[row[at]]
            keys, which = np.unique(key[own], return_inverse=True)
            total = np.zeros(len(keys), np.int64)
            np.add.at(total, which, batch.column("_weight").to_numpy()[row[at[own]]])
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(total)], ["_key", "a"])

    return numbered.mapInArrow(count, "_key long, a long").groupBy("_key").agg(F.sum("a").alias("a"))


def frequent_phrases(chunks: DataFrame, longest: int = LONGEST, at_least: int = AT_LEAST, limit: int = LIMIT) -> DataFrame:
    """Every phrase of up to ``longest`` words that occurs ``at_least`` times: ``_group``, ``phrase``, ``_size`` and ``a``.

    Numbers of phrases are checked before they are broadcast; from the first length that passes the limit on, phrases are
    counted without them.
    """
    spark = chunks.sparkSession
    often = F.col("a") >= at_least
    columns = ["_group", "phrase", F.lit(1).alias("_size"), "a"]
    found = [written(word_counts(chunks).where(often).select(columns), "words")]
    size, known, numbered = 2, [], None
    if found[0].count() <= limit:
        words = found[0].select("_group", "phrase").toPandas().sort_values(["_group", "phrase"], ignore_index=True)
        numbered = written(number_chunks(chunks, words), "numbered")
        names, spelled = words["phrase"].to_numpy(), words
        while size <= longest and len(spelled):
            counts = written(numbered_counts(numbered, known, len(words)).where(often), "counts")
            if counts.count() > limit:
                break
            rows = counts.toPandas().sort_values("_key", ignore_index=True)
            before, last = np.divmod(rows["_key"].to_numpy(np.int64), max(1, len(words)))
            spelled = pd.DataFrame({
                "_group": spelled["_group"].to_numpy()[before],
                "phrase": spelled["phrase"].to_numpy()[before] + " " + names[last], "a": rows["a"].to_numpy(np.int64)})
            if len(spelled):
                found.append(spark.createDataFrame(spelled, "_group string, phrase string, a long").select(
                    "_group", "phrase", F.lit(size).alias("_size"), "a"))
            known.append(rows["_key"].to_numpy(np.int64))
            size += 1
        if not len(spelled):
            size = longest + 1
    for n in range(size, longest + 1):
        found.append(counted(chunks, n).where(often).select("_group", "phrase", F.lit(n).alias("_size"), "a"))
    result = found[0]
    for more in found[1:]:
        result = result.unionByName(more)
    result = written(result, "phrases")
    forget(*([numbered] if numbered is not None else []))
    return result


def scored(phrases: DataFrame, totals: DataFrame) -> DataFrame:
    """The candidates, phrases of two words and more, with their lowest cut; those that a longer one holds are left out."""
    words = F.split("phrase", " ")
    cut = (phrases.where(F.col("_size") > 1)
           .select("_group", "phrase", "a", words.alias("_words"), F.explode(F.sequence(F.lit(1), F.col("_size") - 1)).alias("_cut"))
           .select("_group", "phrase", "a", "_cut", F.array_join(F.slice("_words", F.lit(1), F.col("_cut")), " ").alias("_left"),
                   F.array_join(F.slice("_words", F.col("_cut") + 1, F.size("_words")), " ").alias("_right")))
    part = lambda side, name: phrases.select("_group", F.col("phrase").alias(side), F.col("a").alias(name))
    big = lambda c: F.col(c).cast("decimal(38,0)")
    cut = (cut.join(part("_left", "l"), ["_group", "_left"]).join(part("_right", "r"), ["_group", "_right"])
           .join(F.broadcast(totals) if totals.count() <= LIMIT else totals, "_group")
           .withColumns({"_above": F.lit(1000).cast("decimal(38,0)") * big("a") * big("n"), "_below": big("l") * big("r")})
           .withColumn("score", F.expr("_above div _below")))
    lowest = cut.groupBy("_group", "phrase").agg(F.min(F.struct("score", "_cut", "a", "l", "r", "n")).alias("_cut"))
    # a longer phrase that is as frequent has one in it, a word longer than this one, that is too
    longer = phrases.where(F.col("_size") > 2).select("_group", F.col("a").alias("_longer"), F.explode(F.array(
        F.array_join(F.slice(words, F.lit(1), F.col("_size") - 1), " "),
        F.array_join(F.slice(words, F.lit(2), F.col("_size") - 1), " "))).alias("phrase"))
    longer = longer.groupBy("_group", "phrase").agg(F.max("_longer").alias("_longer"))
    return (lowest.join(longer, ["_group", "phrase"], "left")
            .where(F.col("_longer").isNull() | (F.col("_longer") < F.col("_cut.a")))
            .select("_group", "phrase", "_cut.a", "_cut.l", "_cut.r", "_cut.n", "_cut.score"))


def collocations(docs: DataFrame, text: str = "text", group: str = "lang", top: int = TOP, at_least: int = AT_LEAST,
                 longest: int = LONGEST, every: int = EVERY, limit: int = LIMIT) -> DataFrame:
    """The ``top`` phrases of each group: ``group``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n`` and ``score``.

    A NULL group is ``und``, a NULL text is empty, and a text without words adds nothing; repeated rows count as often as
    they are there. Equal scores are ordered by frequency, then by the phrase. An empty table gives no rows; other columns
    play no part. At most ``LONGEST`` words make a phrase.
    """
    if not 2 <= longest <= LONGEST:
        raise ValueError(f"phrases have 2 to {LONGEST} words")
    chunks = written(dictionary(docs, text, group, every=every), "chunks")
    totals = written(chunks.groupBy("_group").agg(F.sum(F.col("_own") * F.col("_weight")).alias("n")), "totals")
    rows = scored(frequent_phrases(chunks, longest, at_least, limit), totals)
    forget(chunks)
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    # the first of every part of a group, so that no task sorts a whole group
    part = F.pmod(F.xxhash64("phrase"), F.lit(shuffle_partitions(docs.sparkSession)))
    first = (rows.withColumn("_part", part)
             .withColumn("_place", F.row_number().over(W.partitionBy("_group", "_part").orderBy(*order)))
             .where(F.col("_place") <= top))
    return (first.withColumn("rank", F.row_number().over(W.partitionBy("_group").orderBy(*order)))
            .where(F.col("rank") <= top)
            .select(F.col("_group").alias(group), "rank", "phrase", "a", "l", "r", "n", "score"))


def op13_prefix_free_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2000 phrases of every language of the documents."""
    return collocations(table(spark, sf_dir, "documents"))


OP13_SQL = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents),
worded AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda w: w <> '') AS words FROM pieces),
places AS (SELECT lang, words, unnest(generate_series(1, len(words))) AS spot FROM worded),
sizes AS (SELECT unnest([1, 2, 3, 4, 5]) AS size),
grams AS (
    SELECT lang, size, array_to_string(words[spot:spot + size - 1], ' ') AS phrase, count(*) AS a
    FROM places JOIN sizes ON spot + size - 1 <= len(words) GROUP BY ALL HAVING count(*) >= 100),
totals AS (SELECT lang, count(*) AS n FROM places GROUP BY lang),
cuts AS (
    SELECT g.lang, g.size, g.phrase, g.a, n, k, string_split(g.phrase, ' ') AS words
    FROM grams g JOIN totals USING (lang) JOIN (SELECT unnest([1, 2, 3, 4]) AS k) ON k < g.size),
scores AS (
    SELECT c.lang, c.size, c.phrase, c.a, l.a AS l, r.a AS r, n, k,
           (1000::HUGEINT * c.a * n) // (l.a::HUGEINT * r.a) AS score
    FROM cuts c
    JOIN grams l ON l.lang = c.lang AND l.phrase = array_to_string(words[1:k], ' ')
    JOIN grams r ON r.lang = c.lang AND r.phrase = array_to_string(words[k + 1:], ' ')),
lowest AS (
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS place FROM scores)
    WHERE place = 1),
kept AS (
    SELECT * FROM lowest p WHERE NOT EXISTS (
        SELECT 1 FROM grams g WHERE g.lang = p.lang AND g.size > p.size AND g.a >= p.a
          AND contains(' ' || g.phrase || ' ', ' ' || p.phrase || ' ')))
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
WHERE rank <= 2000
"""
