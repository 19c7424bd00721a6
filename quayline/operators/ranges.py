"""Tables stored in ranges of their key, of even sizes however the keys are spread.

Ranges are cut at quantiles of a sample, by the key and then by a hash of the row, so a key that holds much of the table is
split over several ranges. What each range holds is kept beside them, a row per range; a read for some keys names the
ranges that can have them before anything is scanned.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from quayline.session import finished_folders, fresh_path, remove_folder

RANGE = "_range"


class RangeTable:
    """A table under a folder, in ranges of ``key``."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, key: str = "id"):
        self.spark, self.path, self.schema, self.key = spark, path.rstrip("/"), schema, key

    def replace(self, rows: DataFrame, ranges: int) -> None:
        """Make ``rows`` the whole table. Rows without a key are in the first range. The new ranges are complete before they
        take the old ones' place, and those stay until ``vacuum``."""
        number = 1 + max(self._versions(), default=0)
        folder = f"{self.path}/rows/version={number}"
        spread = F.xxhash64(*[F.col(c).cast("string") if isinstance(rows.schema[c].dataType, T.MapType) else F.col(c)
                              for c in rows.columns])
        dealt = rows.select(self.schema.names).repartitionByRange(ranges, F.col(self.key).asc_nulls_first(), spread)
        (dealt.sortWithinPartitions(self.key).withColumn(RANGE, F.spark_partition_id())
         .write.partitionBy(RANGE).parquet(folder))
        held = self._read(folder).groupBy(RANGE).agg(
            F.min(self.key).alias("low"), F.max(self.key).alias("high"), F.count_if(F.col(self.key).isNull()).alias("without"),
            F.count(F.lit(1)).alias("rows"))
        held.coalesce(1).write.parquet(f"{self.path}/ranges/version={number}")  # a version counts once its ranges are known

    def _versions(self) -> list[int]:
        return sorted(int(f.rsplit("=", 1)[1]) for f in finished_folders(self.spark, f"{self.path}/ranges/version=*"))

    def _read(self, folder: str) -> DataFrame:
        return self.spark.read.schema(T.StructType([*self.schema.fields, T.StructField(RANGE, T.IntegerType())])).parquet(folder)

    def _latest(self) -> int:
        versions = self._versions()
        if not versions:
            raise ValueError(f"nothing stored under {self.path}")
        return versions[-1]

    def ranges(self) -> DataFrame:
        """A row per range: its number, least and greatest key, rows without a key, and rows."""
        return self.spark.read.parquet(f"{self.path}/ranges/version={self._latest()}")

    def snapshot(self) -> DataFrame:
        return self._read(f"{self.path}/rows/version={self._latest()}").select(self.schema.names)

    def _where(self, held: Column, wanted: Column) -> DataFrame:
        version = self._latest()
        found = self.spark.read.parquet(f"{self.path}/ranges/version={version}").where(held)
        numbers = [r[RANGE] for r in found.select(RANGE).collect()]  # numbers of ranges, of which a table has thousands at most
        rows = self._read(f"{self.path}/rows/version={version}")
        return rows.where(F.col(RANGE).isin(numbers) & wanted).select(self.schema.names)

    def lookup(self, keys: Sequence[object]) -> DataFrame:
        """The rows of some keys, from the ranges that can have them."""
        known = sorted({k for k in keys if k is not None})
        held, wanted = F.lit(False), F.col(self.key).isin(known)
        for k in known:
            held = held | F.lit(k).between(F.col("low"), F.col("high"))
        if any(k is None for k in keys):
            held, wanted = held | (F.col("without") > 0), wanted | F.col(self.key).isNull()
        return self._where(held, wanted)

    def between(self, low: object, high: object) -> DataFrame:
        """The rows with a key from ``low`` to ``high``, both included."""
        return self._where((F.col("low") <= F.lit(high)) & (F.col("high") >= F.lit(low)), F.col(self.key).between(low, high))

    def vacuum(self) -> None:
        """Remove all versions but the last. Frames made from them can't be read any more."""
        for number in self._versions()[:-1]:
            for part in ("ranges", "rows"):
                remove_folder(self.spark, f"{self.path}/{part}/version={number}")


def equal_ranges(spark: SparkSession, df: DataFrame, key: str, ranges: int) -> RangeTable:
    """``df`` as a new table of ranges in a fresh folder of the shared ones."""
    table = RangeTable(spark, fresh_path(spark, "ranges"), df.schema, key)
    table.replace(df, ranges)
    return table
