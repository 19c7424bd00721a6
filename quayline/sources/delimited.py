"""Typed ingest of comma-separated files."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from quayline.functions.columns import parse_time
from quayline.schemas import Table

# Fixed value: how the sample files write a date-time.
FILE_TIME = "yyyy/M/d H:mm"

_LINE = "_line"


def read_header(spark: SparkSession, path: str) -> list[str]:
    """The column names in the first line read; all files of a folder share one header."""
    line = spark.read.text(path).first()["value"].lstrip("﻿")
    return [name.strip() for name in line.replace('"', "").split(",")]


def _typed(cells: Sequence[Column], place: int, data_type: T.DataType) -> Column:
    """A cell as its type.

    An empty text is NULL and an empty number 0, but empty cells at the end of a line count as missing, which is NULL
    for both. A date-time may have any known layout.
    """
    text = F.nullif(F.trim(cells[place]), F.lit(""))
    if isinstance(data_type, T.StringType):
        return text
    if isinstance(data_type, T.TimestampType):
        return F.coalesce(F.try_to_timestamp(text, F.lit(FILE_TIME)), parse_time(text))
    present = F.coalesce(*cells[place:]).isNotNull()
    return F.when(text.isNotNull(), text.try_cast(data_type)).when(present, F.lit(0).cast(data_type))


def ingest(spark: SparkSession, path: str, schema: T.StructType, header: Sequence[str] | None = None,
           header_lines: bool = True) -> tuple[DataFrame, DataFrame]:
    """Read files whose header names columns of ``schema``: good rows with their types, and the rejected lines.

    Lines are cut at every comma, without quoting. A line that is too short ends in NULLs; one that is too long is
    rejected, as are lines with a value that cannot be read. ``header_lines=False`` says that no file starts with the
    header.
    """
    header = list(header) if header is not None else read_header(spark, path)
    places = {name: i for i, name in enumerate(header)}
    raw = T.StructType([T.StructField(f"_c{i}", T.StringType()) for i in range(len(header))]
                       + [T.StructField(_LINE, T.StringType())])
    lines = (spark.read.schema(raw).option("header", header_lines).option("quote", "").option("mode", "PERMISSIVE")
             .option("columnNameOfCorruptRecord", _LINE).csv(path))
    cells = [F.col(f"_c{i}") for i in range(len(header))]

    values, unread = [], []
    for field in schema.fields:
        if field.name not in places:
            values.append(F.lit(None).cast(field.dataType).alias(field.name))
            continue
        value = _typed(cells, places[field.name], field.dataType)
        values.append(value.alias(field.name))
        if not isinstance(field.dataType, T.StringType):
            unread.append(value.isNull() & (F.length(F.trim(cells[places[field.name]])) > 0))
    # The reader keeps the line when it has not as many values as the header.
    extra = F.regexp_count(F.regexp_replace(_LINE, ",+$", ""), F.lit(",")) >= len(header)
    problem = F.when(extra, "too many values").when(reduce(or_, unread, F.lit(False)), "unreadable value")
    typed = lines.select(F.coalesce(F.col(_LINE), F.concat_ws(",", *cells)).alias("line"),
                         problem.alias("problem"), *values)
    return (typed.where(F.col("problem").isNull()).select(schema.names),
            typed.where(F.col("problem").isNotNull()).select("line", "problem"))


def ingest_table(spark: SparkSession, path: str, table: Table, **options) -> tuple[DataFrame, DataFrame]:
    """``ingest`` for a table of the catalogue."""
    return ingest(spark, path, table.stored_schema, **options)
