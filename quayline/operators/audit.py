"""Row-count audit over many tables."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, functions as F


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table with its number of rows."""
    counts = [df.agg(F.count(F.lit(1)).alias("cnt")).select(F.lit(name).alias("table_name"), "cnt")
              for name, df in tables.items()]
    return reduce(DataFrame.unionByName, counts)


def total_count(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows in all tables together."""
    return table_counts(tables).agg(F.sum("cnt").alias("total"))


def distinct_total_count(tables: Mapping[str, DataFrame]) -> DataFrame:
    """The sum of the *different* counts: tables of equal size count once, as under ``UNION``."""
    return table_counts(tables).select("cnt").distinct().agg(F.sum("cnt").alias("total"))


def audit(tables: Mapping[str, DataFrame], expected: DataFrame) -> DataFrame:
    """Counts next to expected counts (``table_name, cnt``): one row per table of either side, with the difference."""
    found = table_counts(tables).withColumnRenamed("cnt", "found")
    wanted = expected.select("table_name", F.col("cnt").alias("expected"))
    return found.join(wanted, "table_name", "full").select(
        "table_name", "found", "expected",
        (F.coalesce("found", F.lit(0)) - F.coalesce("expected", F.lit(0))).alias("difference"))
