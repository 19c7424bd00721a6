"""Catalog tables in hash buckets, which joins and aggregates on the key read without a shuffle."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from quayline.session import fresh_path

BUCKETS = 3  # fixed value: the buckets of a table where nobody says otherwise


def write_bucketed(df: DataFrame, name: str, keys: Sequence[str] = ("id",), buckets: int = BUCKETS,
                   path: str | None = None) -> None:
    """Store ``df`` as the catalog table ``name``, hashed on ``keys`` into buckets of one sorted file each.

    ``path`` is where its files go, by default a fresh folder of the shared ones.
    """
    (df.repartition(buckets, *keys).write.mode("overwrite").format("parquet").option("path", path or fresh_path(df.sparkSession, name))
     .bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name))


class BucketedTables:
    """``tables(name)`` gives the catalog table of that name with a prefix in front.

    ``keys`` has the column on which each table is in buckets; ``widen(..., co_located=tables.keys)`` joins by them as they
    lie.
    """

    def __init__(self, spark: SparkSession, prefix: str, keys: Mapping[str, str]):
        self.spark, self.prefix, self.keys = spark, prefix, dict(keys)

    def write(self, name: str, df: DataFrame, buckets: int = BUCKETS) -> None:
        write_bucketed(df, self.prefix + name, [self.keys[name]], buckets)

    def __call__(self, name: str) -> DataFrame:
        return self.spark.table(self.prefix + name)
