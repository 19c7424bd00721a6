"""The source-table catalogue: names, typed columns, keys and the names the columns have at the source.

The catalogue is a parameter, not code: a text with a line per table and, indented below it, a line per column.
``catalogue.txt`` of this package is the default.
"""

from __future__ import annotations

import functools
import re
from dataclasses import dataclass
from importlib import resources
from pathlib import Path

from pyspark.sql import types as T

DEFAULT_CATALOGUE = "catalogue.txt"

# The enumeration kept by each type number of the code dictionary.
CODE_TYPES = {
    "register_channel": 1,
    "collect_status": 2,
    "dispatch_status": 3,
    "courier_status": 4,
    "address_type": 5,
    "dot_status": 6,
    "staff_status": 7,
    "is_insured": 8,
    "transport_type": 9,
    "transport_status": 10,
    "warehouse_type": 11,
    "is_rent": 12,
    "goods_shelves_state": 13,
    "receipt_status": 14,
    "warehousing_type": 15,
    "custom_type": 16,
    "order_terminal_type": 17,
    "order_channel_type": 18,
}

_EVENT_TYPES = {
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
}


@dataclass(frozen=True)
class Column:
    """One column: its name and type in the events, and both at the source database."""

    name: str
    type: T.DataType
    source_name: str
    source_type: str

    @property
    def stored_type(self) -> T.DataType:
        """The analytics type of the source column: exact numbers and real timestamps."""
        if self.source_type == "DATE":
            return T.TimestampType()
        number = re.fullmatch(r"NUMBER\((\d+),(\d+)\)", self.source_type)
        if not number:
            return T.StringType()
        precision, scale = int(number[1]), int(number[2])
        if scale:
            return T.DecimalType(precision, scale)
        return T.IntegerType() if precision <= 10 else T.LongType()


@dataclass(frozen=True)
class Table:
    """One source table."""

    name: str
    columns: tuple[Column, ...]
    key: str = "id"

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(c.name, c.type, c.name != self.key) for c in self.columns])

    @property
    def stored_schema(self) -> T.StructType:
        return T.StructType([T.StructField(c.source_name, c.stored_type, c.source_name != self.key)
                             for c in self.columns])


def parse_catalogue(text: str) -> dict[str, Table]:
    """Read a catalogue: a line with a table's name, then an indented line per column; raises on any other line."""
    tables: dict[str, list[Column]] = {}
    columns: list[Column] | None = None
    for number, line in enumerate(text.splitlines(), 1):
        if not line.strip() or line.startswith("#"):
            continue
        column = re.fullmatch(r"\s+(\w+) (\w+) (\w+) (\w+(?:\([\d,]+\))?)", line)
        if column and columns is not None and column[2] in _EVENT_TYPES:
            columns.append(Column(column[1], _EVENT_TYPES[column[2]], column[3], column[4]))
        elif re.fullmatch(r"\w+", line) and line not in tables:
            columns = tables[line] = []
        else:
            raise ValueError(f"catalogue line {number} is neither a new table nor a column: {line!r}")
    empty = [name for name, found in tables.items() if "id" not in [c.name for c in found]]
    if empty:
        raise ValueError(f"tables without their key: {empty}")
    return {name: Table(name, tuple(found)) for name, found in tables.items()}


@functools.lru_cache
def load_catalogue(path: str | Path | None = None) -> dict[str, Table]:
    """The catalogue kept in a text file, by default the one of this package. It is metadata, read on the driver."""
    if path is None:
        return parse_catalogue(resources.files("quayline").joinpath(DEFAULT_CATALOGUE).read_text(encoding="utf-8"))
    return parse_catalogue(Path(path).read_text(encoding="utf-8"))
