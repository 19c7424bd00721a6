"""Helpers that several operators share."""

from __future__ import annotations

import math
from collections.abc import Iterable

import numpy as np
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from quayline.llm.scratch import remove_folder
from quayline.session import fresh_path

#: At most about 100 MB as a hash table, with a digest in each name.
BROADCAST_NAMES = 500_000

#: Runs of white space that are not one single blank, the only ones that normalising has to touch.
ODD_WHITE = r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder, read back: cuts the lineage, and what reads it twice sees equal rows."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table._written_to = path
    return table


def forget(*tables: DataFrame) -> None:
    """Remove tables that ``written`` has made, once nothing that is still to run reads them."""
    for t in tables:
        remove_folder(t.sparkSession, t._written_to)


def whole_text(column: str = "text") -> Column:
    """The text, an empty one for NULL."""
    return F.coalesce(F.col(column), F.lit(""))


def single_spaced(text: Column) -> Column:
    """Every run of ASCII white space becomes one blank."""
    return F.regexp_replace(text, ODD_WHITE, " ")


def id_remainder(column: str, modulus: int) -> Column:
    """crc32 of the id as text, by a modulus; NULL counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % modulus


def free_name(taken: Iterable[str], name: str) -> str:
    """``name``, with underscores in front until no column is called so (Spark ignores case)."""
    lower = {c.lower() for c in taken}
    while name.lower() in lower:
        name = f"_{name}"
    return name


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def tree_shape(leaves: int, most: int = 16) -> tuple[int, int]:
    """Fan-in and number of rounds, two at least, of a tree over ``leaves`` or a few more."""
    rounds = max(2, math.ceil(math.log(max(leaves, 2)) / math.log(most)))
    fan = 2
    while fan ** rounds < leaves:
        fan += 1
    return fan, rounds


def key_type(docs: DataFrame, key: str) -> T.DataType:
    """The key's type, with parts that may be NULL, as Arrow data have them."""
    kind = docs.schema[key].dataType
    return T.StructType([T.StructField(f.name, f.dataType) for f in kind]) if isinstance(kind, T.StructType) else kind


def keyed_rows(docs: DataFrame, key: str = "doc_id", text: str = "text") -> tuple[DataFrame, str]:
    """``docs`` with a column that names its rows, and the column.

    That is the key where all keys are there and differ. Where not, it is the key, or that there is none, with a digest of
    the text, so that only rows with one key and one text share a name. Names sort as the keys do, rows without one last.
    """
    name = free_name(docs.columns, "_name")
    repeated = docs.groupBy(F.col(f"`{key}`").alias(name)).count().where((F.col("count") > 1) | F.col(name).isNull())
    if repeated.isEmpty():
        return docs.withColumn(name, F.col(f"`{key}`")), name
    kind = docs.schema[key].dataType.simpleString()
    none = F.expr(f"cast(0 as {kind})") if kind != "string" else F.lit("")
    return docs.withColumn(name, F.struct(
        F.col(f"`{key}`").isNull().alias("none"), F.coalesce(F.col(f"`{key}`"), none).alias("key"),
        F.sha2(whole_text(f"`{text}`"), 256).alias("text"))), name


def small_or_joined(rows: DataFrame) -> DataFrame:
    """Rows that are joined by a key, with a few numbers or a digest each: broadcast up to a checked number of them."""
    return F.broadcast(rows) if rows.count() <= BROADCAST_NAMES else rows


def without(docs: DataFrame, name: str, dropped: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose ``name`` is not in ``dropped``, without that column.

    The names are counted: up to ``BROADCAST_NAMES`` go to every task, which saves a shuffle of the texts; more are joined.
    """
    other = free_name(docs.columns, "_dropped")
    names = small_or_joined(dropped.select(F.col(name).alias(other)))
    return docs.join(names, F.col(name) == F.col(other), "left_anti").drop(name)


def one_of_each(docs: DataFrame, name: str) -> DataFrame:
    """One row per ``name`` where that is not a plain key."""
    return docs.dropDuplicates([name]) if docs.schema[name].dataType.typeName() == "struct" else docs


def planes(numbers: np.ndarray) -> bytes:
    """Numbers below 2^32, compressed: all first bytes together, then all second ones and so on, as many as are needed."""
    numbers = np.ascontiguousarray(numbers, "<u4")
    size = max(1, (int(numbers.max(initial=0)).bit_length() + 7) // 8)
    return bytes([size]) + zstandard.compress(numbers.view(np.uint8).reshape(-1, 4).T[:size].tobytes(), 1)


def from_planes(data: bytes) -> np.ndarray:
    """What ``planes`` was given."""
    parts = np.frombuffer(zstandard.decompress(data[1:]), np.uint8).reshape(data[0], -1)
    out = np.zeros((parts.shape[1], 4), np.uint8)
    out[:, :data[0]] = parts.T
    return out.view("<u4").ravel()


def by_frequency(codes: np.ndarray, kinds: int) -> tuple[np.ndarray, np.ndarray]:
    """New codes, the most frequent first, and the old code of each."""
    order = np.argsort(-np.bincount(codes, minlength=kinds), kind="stable")
    new = np.empty(kinds, np.int64)
    new[order] = np.arange(kinds)
    return new[codes], order
