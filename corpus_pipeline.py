"""The corpus pipeline: documents in, packed training sequences out.

Every stage takes the session, the documents that the stage before has left and the folder of the other tables. All but
the last return documents with the same columns.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quayline.llm import exact, mixing, packing, quality, shingles
from quayline.llm.common import table, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the quality classifier rejects."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact.deduplicate(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar texts."""
    return shingles.one_of_each_group(docs)


def target_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, those of scarce languages as often as the mix of languages asks for."""
    return mixing.mix(docs, table(spark, sf_dir, "labels"), keep_all=True)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents, with their token ids and their places in sequences."""
    return packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality", good_quality), ("exact_copies", exact_copies), ("near_copies", near_copies), ("mixing", target_mix),
    ("packing", packed_sequences)]

#: SQL can express neither the classifier nor the rates; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn, each written and read again as the next one's documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
