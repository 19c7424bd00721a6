"""An inverted index for ranked term search, as Parquet.

A word's postings lie in rows of one word and one block of document numbers: the block's first document, and for every
document that has the word its distance from the first, how often the word occurs and how many words the document has.
No row grows beyond a block, however frequent a word is. Rows are stored by a hash of the word in folders and sorted in
them, so that a search lists the folders of its words and skips the other words' row groups; texts are not read.

A document's weight is the usual one (BM25): rare words count more, further occurrences less and less, and occurrences in
long documents less.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from quayline.operators.search import words_of

BLOCK = 1 << 14  # document numbers in a block, and so the longest list in a row
PARTS = 64
POSTINGS = ("term string, block long, docs int, first long, after array<int>, times array<int>, lengths array<int>, "
            "part int")
LISTS = POSTINGS.rsplit(",", 1)[0]  # without the folder
SATURATION, LENGTH_SHARE = 1.2, 0.75  # fixed values: the customary k1 and b


def _part(term: Column, parts: int) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(parts)).cast("int")


def _lists(docs: pa.Table) -> pa.Table:
    """The rows of one block: for each word its documents in order. Rows with the same key and length count as one document."""
    docs = docs.combine_chunks()
    key, inverse = np.unique(np.stack([docs["doc"].to_numpy(), docs["length"].to_numpy()]), axis=1, return_inverse=True)
    words = pc.split_pattern(docs["words"].chunk(0), " ").flatten().dictionary_encode()
    row = np.repeat(inverse.ravel(), docs["length"].to_numpy())
    pairs, times = np.unique(words.indices.to_numpy().astype(np.int64) * key.shape[1] + row, return_counts=True)
    term, row = np.divmod(pairs, key.shape[1])
    doc, length = key[:, row]
    order = np.lexsort((length, times, doc, term))
    term, doc, length, times = term[order], doc[order], length[order], times[order]
    starts = np.flatnonzero(np.r_[True, term[1:] != term[:-1]])
    size, ends = np.diff(np.r_[starts, len(term)]), pa.array(np.r_[starts, len(term)].astype(np.int32))
    listed = lambda values: pa.ListArray.from_arrays(ends, pa.array(values.astype(np.int32)))
    return pa.table({
        "term": words.dictionary.take(pa.array(term[starts])), "block": pa.array(np.repeat(docs["block"][0].as_py(), len(starts))),
        "docs": pa.array(size.astype(np.int32)), "first": pa.array(doc[starts]),
        "after": listed(doc - np.repeat(doc[starts], size)), "times": listed(times), "lengths": listed(length)})


class SearchIndex:
    """The index under a folder, of documents with a number as key that differs from document to document."""

    def __init__(self, spark: SparkSession, path: str, parts: int = PARTS, block: int = BLOCK):
        self.spark, self.path, self.parts, self.block = spark, path.rstrip("/"), parts, block

    def build(self, docs: DataFrame, key: str, text: str) -> None:
        """Index all documents; what was there is replaced. A document without a key or without words is in no list."""
        worded = docs.where(F.col(key).isNotNull()).select(F.col(key).cast("long").alias("doc"), words_of(F.col(text)).alias("words"))
        # the shuffle moves a row per document, its words as one text; the lists of a block are made where it lies
        lists = (worded.where(F.size("words") > 0)
                 .select(F.expr(f"doc div {self.block}").alias("block"), "doc", F.size("words").alias("length"),
                         F.array_join("words", " ").alias("words"))
                 .groupBy("block").applyInArrow(_lists, LISTS)
                 .select(_part(F.col("term"), self.parts).alias("part"), "*"))
        (lists.hint("rebalance", "part").sortWithinPartitions("part", "term", "block")
         .write.mode("overwrite").option("partitionOverwriteMode", "static").option("parquet.block.size", 8 << 20)
         .partitionBy("part").parquet(f"{self.path}/postings"))
        # a document's words add up to its length, so the words of all documents of a length tell how many these are
        rows = self.spark.read.schema(POSTINGS).parquet(f"{self.path}/postings")
        by_length = (rows.select(F.explode(F.arrays_zip("times", "lengths")).alias("p"))
                     .groupBy(F.col("p.lengths").alias("length")).agg(F.sum("p.times").alias("words")))
        (by_length.agg(F.coalesce(F.sum(F.expr("words div length")), F.lit(0)).alias("docs"), F.sum("words").alias("words"))
         .coalesce(1).write.mode("overwrite").parquet(f"{self.path}/totals"))

    def postings(self, terms: Sequence[str]) -> DataFrame:
        """The rows of some words, and of no others."""
        wanted = sorted({t.lower() for t in terms})
        if not wanted:
            raise ValueError("no words to search for")
        rows = self.spark.read.schema(POSTINGS).parquet(f"{self.path}/postings")
        return rows.where(F.col("part").isin([_part(F.lit(t), self.parts) for t in wanted]) & F.col("term").isin(wanted))

    def matches(self, terms: Sequence[str]) -> DataFrame:
        """``doc``, ``term``, ``times`` and ``length`` of every document that has one of the words."""
        return (self.postings(terms)
                .select("term", "first", F.explode(F.arrays_zip("after", "times", "lengths")).alias("p"))
                .select((F.col("first") + F.col("p.after")).alias("doc"), "term", "p.times", F.col("p.lengths").alias("length")))

    def count(self, terms: Sequence[str]) -> DataFrame:
        """How many documents have one of the words."""
        return self.matches(terms).agg(F.count_distinct("doc").alias("total"))

    def ranked(self, terms: Sequence[str], limit: int = 0, key: str = "doc") -> DataFrame:
        """``key``, ``score`` and ``found`` (how many of the words) of the documents, or of the best ``limit`` of them, in the
        order of ``score``, then of the key."""
        totals = self.spark.read.parquet(f"{self.path}/totals").first()
        # one row per word of the search
        weight = self.postings(terms).groupBy("term").agg(F.sum("docs").alias("in_docs")).select("term", F.log(
            1 + (F.lit(float(totals["docs"])) - F.col("in_docs") + 0.5) / (F.col("in_docs") + 0.5)).alias("weight"))
        mean = float(totals["words"] or 0) / max(1, totals["docs"])
        damped = F.col("times") + SATURATION * (1 - LENGTH_SHARE + LENGTH_SHARE * F.col("length") / F.lit(mean or 1.0))
        scored = (self.matches(terms).join(F.broadcast(weight), "term").groupBy("doc")
                  .agg(F.round(F.sum(F.col("weight") * F.col("times") * (SATURATION + 1) / damped), 9).alias("score"),
                       F.count(F.lit(1)).alias("found"))
                  .select(F.col("doc").alias(key), "score", "found").orderBy(F.col("score").desc(), key))
        return scored.limit(limit) if limit else scored


