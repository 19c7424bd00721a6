"""Changelog tables: rows with a sign and a version, collapsed when they are read."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from quayline.session import fresh_path

# How Spark types are called in the changelog store.
STORE_TYPES = {
    "tinyint": "Int8",
    "smallint": "Int16",
    "int": "Int32",
    "float": "Float32",
    "double": "Float64",
    "bigint": "Int64",
    "date": "DateTime",
    "timestamp": "DateTime",
    "string": "String",
    "void": "String",
    # types the store can hold although nothing wrote them so far
    "boolean": "UInt8",
    "binary": "String",
    "timestamp_ntz": "DateTime",
}


def store_type(data_type: T.DataType) -> str:
    if isinstance(data_type, T.DecimalType):
        return f"Decimal({data_type.precision}, {data_type.scale})"
    return STORE_TYPES[data_type.simpleString()]


def store_columns(schema: T.StructType, op: str = "opType") -> dict[str, str]:
    """The store's types of a changelog table for rows of ``schema``; the operation column is not kept."""
    kept = {f.name: store_type(f.dataType) for f in schema.fields if f.name != op}
    return kept | {"sign": "Int8", "version": "Int64"}


def to_changelog(changes: DataFrame, version: Column | str, op: str = "op_type", key: Sequence[str] = (),
                 before: DataFrame | None = None) -> DataFrame:
    """Changes as changelog rows: a delete has sign -1, all others +1; the operation column goes.

    Without ``key`` every change is one row, and the state is that of the highest version per key. With ``key`` a version
    that is a column becomes the log's, and the log can also be collapsed: each row that ends, by an update or a delete, is written again with sign -1 and its own version.
    What ends is the key's row before, in the changes or in ``before``, the changelog so far; a delete of nothing is none.
    """
    deletes = F.col(op) == "delete"
    kept = [c for c in changes.columns if c != op and (not key or c != version)]
    version = F.col(version) if isinstance(version, str) else version
    if not key:
        return changes.select(*kept, F.when(deletes, F.lit(-1)).otherwise(F.lit(1)).cast("tinyint").alias("sign"),
                              version.cast("bigint").alias("version"))
    rows = changes.select(*kept, deletes.alias("_deletes"), version.cast("bigint").alias("version"))
    if before is not None:
        old = final_rows(before, key, keep_version=True)
        rows = rows.unionByName(old.select(*kept, F.lit(False).alias("_deletes"), "version").withColumn("_old", F.lit(True)),
                                allowMissingColumns=True)
    else:
        rows = rows.withColumn("_old", F.lit(None).cast("boolean"))
    each = with_row_before(rows, key, ["version", "_deletes"], [*kept, "version", "_deletes"], "_ends")
    ends = each.where(~F.col("_ends._deletes")).select(
        *[F.col(f"_ends.{c}").alias(c) for c in kept], F.lit(-1).cast("tinyint").alias("sign"), "_ends.version")
    begins = each.where(~F.col("_deletes") & F.col("_old").isNull()).select(
        *kept, F.lit(1).cast("tinyint").alias("sign"), "version")
    return begins.unionByName(ends)


def with_row_before(rows: DataFrame, key: Sequence[str], order: Sequence[str], columns: Sequence[str], name: str,
                    blocks: int = 0) -> DataFrame:
    """``rows`` with the ``columns`` of the row before, of the same key in ``order``, as the struct ``name``.

    A key may have any number of rows: they are dealt into even blocks by key and order, and every block is looked at by
    itself, with the last row of the key's block before it in front. Adaptive execution decides how many, or ``blocks``.
    """
    path = fresh_path(rows.sparkSession, "blocks")  # stored, as another sample would deal them differently
    dealt = rows.repartitionByRange(*([blocks] if blocks else []), *key, *order)
    dealt.withColumn("_block", F.spark_partition_id()).write.parquet(path)
    schema = T.StructType([*rows.schema.fields, T.StructField("_block", T.IntegerType())])
    dealt = rows.sparkSession.read.schema(schema).parquet(path)
    last = dealt.groupBy(*key, "_block").agg(F.max_by(F.struct(*columns), F.struct(*order)).alias("_row"))
    following = F.lead("_block").over(Window.partitionBy(*key).orderBy("_block"))  # a row per block
    carried = last.withColumn("_block", following).where(F.col("_block").isNotNull()).select(
        "_block", *key, *[F.col(f"_row.{c}").alias(c) for c in columns if c not in key], F.lit(True).alias("_carried"))
    whole = dealt.withColumn("_carried", F.lit(False)).unionByName(carried, allowMissingColumns=True)
    back = Window.partitionBy(*key, "_block").orderBy(F.col("_carried").desc(), *order)
    return whole.withColumn(name, F.lag(F.struct(*columns)).over(back)).where(~F.col("_carried")).drop("_carried", "_block")


def final_rows(changelog: DataFrame, key: Sequence[str], keep_version: bool = False) -> DataFrame:
    """Current state: per key the row of the highest version, unless that one deletes."""
    rest = [c for c in changelog.columns if c not in (*key, "sign", "version")]
    last = F.max(F.struct("version", (-F.col("sign")).alias("deletes"), *rest)).alias("last")
    wanted = [c for c in changelog.columns if c not in (*key, "sign") and (keep_version or c != "version")]
    return (changelog.groupBy(*key).agg(last).where(F.col("last.deletes") < 0)
            .select(*key, *[F.col(f"last.{c}").alias(c) for c in wanted]))


def collapsed_rows(changelog: DataFrame) -> DataFrame:
    """What is left of a log with cancel rows when each -1 has cancelled the +1 of equal content and version."""
    content = [c for c in changelog.columns if c != "sign"]
    return (changelog.groupBy(*content).agg(F.sum("sign").alias("copies")).where(F.col("copies") > 0)
            .drop("copies", "version"))
