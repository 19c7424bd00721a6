"""Exact de-duplication by a tree merge of sorted digest runs.

Rows are dealt in blocks of an input partition to ``fan ** rounds`` runs. A run has one entry per digest: the digest, the
smallest identifier and the number of rows. In every round each run exchanges entries with ``fan - 1`` partners, those
that differ from it in one digit of its number, and keeps the digests whose own digit says so; what arrives is merged,
by digest, and of equal digests the smallest identifier stays. After the last round run number n holds, complete, the
digests that belong to n. An entry carries the text's length and a second hash, and only entries that agree in all three
are merged, at every level. A digest has at most ``fan`` entries in a task, however many copies it has; the winners go
back down the same way, per digest and run, so that a group of copies is never in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from quayline.llm.common import (
    keyed_rows, one_of_each, shuffle_partitions, single_spaced, table, tree_shape, whole_text, without, written)

DIGEST = ["_digest", "_bytes", "_tag"]
BLOCK_BITS = 10  # 1,024 consecutive rows of an input partition belong to one run


def _digits(number, fan: int, rounds: int) -> list:
    return [F.floor(number / F.lit(fan ** i)) % fan for i in range(rounds)]


def digest_rows(docs: DataFrame, runs: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One small row per document: its key, a row number, its run and its digest with length and second hash."""
    normal = docs.select(F.col(f"`{key}`").alias("_key"), F.monotonically_increasing_id().alias("_row"),
                         single_spaced(whole_text(f"`{text}`")).alias("_text"))
    return written(normal.select(
        "_key", "_row", F.pmod(F.xxhash64(F.shiftright("_row", BLOCK_BITS)), F.lit(runs)).cast("int").alias("_run"),
        F.unhex(F.sha2("_text", 256)).alias("_digest"), F.octet_length("_text").alias("_bytes"),
        F.xxhash64("_text").alias("_tag")), "digests")


def merge_runs(rows: DataFrame, fan: int, rounds: int) -> tuple[DataFrame, DataFrame]:
    """The entries of the runs, and of each digest over all runs: smallest (no key, key, row) and number of rows."""
    first = F.min(F.struct(F.col("_key").isNull().alias("none"), F.col("_key").alias("key"),
                           F.col("_row").alias("row")))
    runs = rows.groupBy("_run", *DIGEST).agg(first.alias("_first"), F.count(F.lit(1)).alias("_size"))
    merged, home = runs, F.pmod(F.xxhash64(*DIGEST), F.lit(fan ** rounds))
    for i in range(rounds):
        own, wanted = _digits(F.col("_run"), fan, rounds), _digits(home, fan, rounds)
        to = sum((wanted if j <= i else own)[j] * fan ** j for j in range(rounds))
        merged = (merged.withColumn("_run", to.cast("int")).repartitionById(fan ** rounds, F.col("_run"))
                  .groupBy("_run", *DIGEST).agg(F.min("_first").alias("_first"), F.sum("_size").alias("_size")))
    return runs, merged


def duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", fan: int | None = None,
               rounds: int | None = None) -> DataFrame:
    """Every row's group: ``key``, ``keep_id``, ``group_size``, ``kept`` and ``text_sha256``.

    Texts are equal when they are after every run of ASCII white space has become one blank; a NULL text counts as empty,
    and empty texts are equal. The row with the smallest key is kept; a NULL key comes after all others, and of rows with
    one key and one text exactly one is kept. An empty table gives an empty result; other columns play no part.
    """
    if fan is None or rounds is None:
        fan, rounds = tree_shape(shuffle_partitions(docs.sparkSession))
    rows = digest_rows(docs, fan ** rounds, key, text)
    runs, merged = merge_runs(rows, fan, rounds)
    down = runs.select("_run", *DIGEST).join(
        merged.select(*DIGEST, "_first", F.col("_size").alias("group_size")), DIGEST)
    return rows.join(down, ["_run", *DIGEST]).select(
        F.col("_key").alias(key), F.col("_first.key").alias("keep_id"), "group_size",
        (F.col("_first.row") == F.col("_row")).alias("kept"), F.lower(F.hex("_digest")).alias("text_sha256"))


def deduplicate(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each group of equal texts, the one with the smallest key, with all its columns."""
    named, name = keyed_rows(docs, key, text)
    kept = duplicates(named, name, text).groupBy(name).agg(F.max("kept").alias("kept"))
    return without(one_of_each(named, name), name, written(kept.where(~F.col("kept")).select(name), "dropped"))


def op2_tree_merge_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the one that stays for it."""
    return duplicates(table(spark, sf_dir, "documents"))


OP2_SQL = r"""
WITH normal AS (
    SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
    FROM documents)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = min(doc_id) OVER same AS kept, text_sha256
FROM normal WINDOW same AS (PARTITION BY text_sha256)
"""
