"""Reading stored tables: whole, one day of them, or by example."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from quayline.functions.columns import as_date
from quayline.operators.keyed import KeyedTable
from quayline.schemas import Table


class StoredTables:
    """``tables(name)`` gives the current rows of a table that a change feed keeps under ``root``."""

    def __init__(self, spark: SparkSession, root: str, catalogue: Mapping[str, Table], by_event: bool = False):
        self.by_event = by_event
        self.spark = spark
        self.root = root
        self.catalogue = catalogue
        self._made: dict[str, DataFrame] = {}

    def __call__(self, name: str) -> DataFrame:
        if name not in self._made:
            table = self.catalogue[name]
            self._made[name] = KeyedTable(
                self.spark, f"{self.root}/{name}", table.schema, table.key, by_event=self.by_event).snapshot()
        return self._made[name]


def day_before(df: DataFrame, as_of: dt.date | str, column: str = "cdt") -> DataFrame:
    """Rows of the day before ``as_of``.

    A range on the bare column, so that the scan can skip files; it works on timestamps and on ``yyyy-MM-dd ...`` text.
    """
    today = as_date(as_of)
    start, end = today - dt.timedelta(days=1), today
    if isinstance(df.schema[column].dataType, T.StringType):
        start, end = str(start), str(end)
    return df.where((F.col(column) >= F.lit(start)) & (F.col(column) < F.lit(end)))


def load_fact(df: DataFrame, mode: str, as_of: dt.date | str, column: str = "cdt") -> DataFrame:
    """``mode="full"``: everything; ``"incremental"``: the day before ``as_of``."""
    if mode not in ("full", "incremental"):
        raise ValueError(f"unknown mode: {mode}")
    return df if mode == "full" else day_before(df, as_of, column)


def is_set(value: object) -> bool:
    """Whether a field of an example counts: numbers above zero, texts with characters, every boolean and date."""
    if value is None:
        return False
    if isinstance(value, bool):
        return True
    if isinstance(value, (int, float)):
        return value > 0
    if isinstance(value, str):
        return value != ""
    return True


def query_by_example(df: DataFrame, example: Mapping[str, object], limit: int = 0,
                     order: Sequence[str] = ()) -> DataFrame:
    """The example's columns of the rows that equal it in every field that is set."""
    conditions = [F.col(c) == F.lit(v) for c, v in example.items() if is_set(v)]
    if conditions:
        df = df.where(reduce(lambda a, b: a & b, conditions))
    df = df.select(*example)
    if order:
        df = df.orderBy(*order)
    return df.limit(limit) if limit > 0 else df
