"""Tables of other databases over JDBC: typed scans."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

# Column types of the external store and the Spark types they are read as.
SPARK_TYPES = {
    "IntervalYear": "int",
    "IntervalQuarter": "int",
    "IntervalMonth": "int",
    "IntervalWeek": "int",
    "IntervalDay": "int",
    "IntervalHour": "int",
    "IntervalMinute": "int",
    "IntervalSecond": "int",
    "UInt64": "bigint",
    "UInt32": "bigint",
    "UInt16": "int",
    "UInt8": "int",
    "Int64": "bigint",
    "Int32": "int",
    "Int16": "int",
    "Int8": "int",
    "Date": "date",
    "DateTime": "timestamp",
    "Enum8": "string",
    "Enum16": "string",
    "Float32": "float",
    "Float64": "double",
    "Decimal32": "decimal(10,0)",
    "Decimal64": "decimal(10,0)",
    "Decimal128": "decimal(10,0)",
    "Decimal": "decimal(10,0)",
    "UUID": "string",
    "String": "string",
    "FixedString": "string",
    "Nothing": "void",
    "Nested": "string",
    "Tuple": "string",
    "Array": "string",
    "AggregateFunction": "string",
    "Unknown": "string",
}


def spark_type(name: str) -> str:
    """The Spark type of a store type; arguments like ``FixedString(8)`` do not count, except a decimal's digits."""
    base, _, arguments = name.partition("(")
    if base == "Nullable":
        return spark_type(arguments[:-1])
    if base == "Decimal" and arguments:
        return f"decimal({arguments.replace(' ', '')}"
    return SPARK_TYPES.get(base, "void")


def custom_schema(columns: Mapping[str, str]) -> str:
    """The ``customSchema`` option for columns given with their store types; unknown types read as text."""
    types = {c: spark_type(t) for c, t in columns.items()}
    return ", ".join(f"`{c}` {'string' if t == 'void' else t}" for c, t in types.items())


def scan_options(url: str, table: str, columns: Mapping[str, str] | None = None, partition_column: str | None = None,
                 bounds: tuple[object, object] | None = None, partitions: int = 1, **extra: str) -> dict[str, str]:
    """Options of a JDBC scan that many tasks share, each with its range of ``partition_column``."""
    options = {"url": url, "dbtable": table, **extra}
    if columns:
        options["customSchema"] = custom_schema(columns)
    if partition_column:
        if bounds is None:
            raise ValueError("a partitioned scan needs bounds")
        options |= {"partitionColumn": partition_column, "lowerBound": str(bounds[0]),
                    "upperBound": str(bounds[1]), "numPartitions": str(partitions)}
    return options


def external_table(spark: SparkSession, url: str, table: str, **options) -> DataFrame:
    """An external table; filters, column choice, aggregates and limits are pushed to its database."""
    return spark.read.format("jdbc").options(**scan_options(url, table, **options)).load()


def external_query(spark: SparkSession, url: str, query: str, **extra: str) -> DataFrame:
    """The result of a query that the external database runs."""
    return spark.read.format("jdbc").options(url=url, query=query, **extra).load()
