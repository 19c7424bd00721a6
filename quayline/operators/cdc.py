"""Change events: from raw messages to typed rows, one last change per key.

Everything here is a function from DataFrame to DataFrame that works alike on a static table and on a stream (the last
change per key inside ``foreachBatch``). A parsed change has these columns:

``table``        table name as the catalogue knows it
``op_type``      insert, update or delete
``event_time``   commit time at the source, as text
``event_pos``    log position at the source: its length without leading zeros, and the text
``event_partition``, ``event_offset``  where the message is in its topic, 0 where the input has none
``row_no``       index of the row in a message that carries several
``payload``      the row, as a map from source column name to text
``problem``      why the message cannot be used, NULL for a good one
``value``        the message itself; ``check_tables`` keeps it only where there is a problem
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from quayline.schemas import Table

# The message layouts of the two capture tools, and the operation names.
ORACLE_ENVELOPE = ("table STRING, op_type STRING, op_ts STRING, current_ts STRING, pos STRING, "
                   "before MAP<STRING, STRING>, after MAP<STRING, STRING>")
MYSQL_ENVELOPE = ("data ARRAY<MAP<STRING, STRING>>, database STRING, es BIGINT, id BIGINT, isDdl BOOLEAN, "
                  "mysqlType MAP<STRING, STRING>, old ARRAY<MAP<STRING, STRING>>, sql STRING, "
                  "sqlType MAP<STRING, INT>, table STRING, ts BIGINT, type STRING")
OPERATIONS = {
    "I": "insert",
    "U": "update",
    "D": "delete",
    "INSERT": "insert",
    "UPDATE": "update",
    "DELETE": "delete",
}

#: What decides which of two changes of a key is the later one.
ORDER = ("event_time", "event_pos", "event_partition", "event_offset", "row_no")
ORDER_TYPE = (T.StructType().add("event_time", "string")
              .add("event_pos", T.StructType().add("length", "integer").add("text", "string"))
              .add("event_partition", "long").add("event_offset", "long").add("row_no", "integer"))


def has_text(c: Column | str) -> Column:
    """Neither NULL nor blank."""
    c = F.col(c) if isinstance(c, str) else c
    return c.isNotNull() & (F.length(F.trim(c)) > 0)


def operation(code: Column | str) -> Column:
    """The operation name of a code; an unknown code is an insert."""
    code = F.col(code) if isinstance(code, str) else code
    name = F.when(F.lit(False), F.lit(None))
    for known, meaning in OPERATIONS.items():
        name = name.when(code == known, meaning)
    return F.coalesce(name, F.lit("insert"))


def strip_schema(table: Column | str) -> Column:
    """``SCHEMA.tbl_x`` to ``tbl_x``."""
    return F.regexp_replace(table, r"[A-Z]+\.", "")


def crm_to_tbl(table: Column | str) -> Column:
    """A leading ``crm_`` becomes ``tbl_``."""
    return F.regexp_replace(table, "^crm_", "tbl_")


def number_order(c: Column) -> Column:
    """Orders digits of any length as numbers: first by length, then as text."""
    digits = F.ltrim(F.trim(c.cast("string")), F.lit("0"))
    return F.when(c.isNotNull(), F.struct(F.length(digits).alias("length"), digits.alias("text")))


def _place(messages: DataFrame) -> list[Column]:
    return [(F.col(name) if name in messages.columns else F.lit(0)).cast("bigint").alias(f"event_{name}")
            for name in ("partition", "offset")]


def _unpacked(messages: DataFrame, envelope: str) -> DataFrame:
    """The fields of each message as columns.

    ``inline`` reads a message once. Plain field access would be merged into every expression behind it, each of which
    would then read the JSON again.
    """
    return messages.where(has_text("value")).select(
        "value", *_place(messages),
        F.inline(F.array(F.from_json("value", envelope))))


def _finish(parsed: DataFrame, problem: Column) -> DataFrame:
    parsed = parsed.withColumn("problem", problem)
    return parsed.select("table", "op_type", *ORDER, "payload", "problem", "value")


def parse_oracle(messages: DataFrame) -> DataFrame:
    """Changes captured from Oracle. A delete has no ``after``, so its row is the one ``before``."""
    parsed = _unpacked(messages, ORACLE_ENVELOPE).select(
        "value", "event_partition", "event_offset",
        strip_schema(F.col("table")).alias("table"),
        operation("op_type").alias("op_type"),
        F.col("op_ts").alias("event_time"),
        number_order(F.col("pos")).alias("event_pos"),
        F.lit(0).alias("row_no"),
        F.coalesce("after", "before").alias("payload"))
    return _finish(parsed, F.when(F.col("table").isNull(), "unreadable").when(F.col("payload").isNull(), "no row"))


def parse_mysql(messages: DataFrame, first_row_only: Iterable[str] = ()) -> DataFrame:
    """Changes captured from MySQL: one change per element of ``data``, none for an empty ``data`` and for a change of
    the table itself. A ``data`` that is missing or no list is a problem of the message.

    For the tables named in ``first_row_only`` only the first element counts.
    """
    parsed = (_unpacked(messages, MYSQL_ENVELOPE)
              .where(F.col("table").isNull() | F.col("data").isNull() | (F.size("data") > 0))
              .where(~F.coalesce("isDdl", F.lit(False)) | (F.size(F.coalesce("data", F.array())) > 0))
              .select("value", "event_partition", "event_offset", "table", "type", "ts", "id",
                      F.posexplode_outer("data").alias("row_no", "payload"))
              .select("value", "event_partition", "event_offset",
                      crm_to_tbl(F.col("table")).alias("table"),
                      operation("type").alias("op_type"),
                      number_order(F.col("ts")).alias("event_time"),
                      number_order(F.col("id")).alias("event_pos"),
                      F.coalesce("row_no", F.lit(0)).alias("row_no"),
                      "payload"))
    first_row_only = list(first_row_only)
    if first_row_only:
        parsed = parsed.where(~F.coalesce(F.col("table").isin(first_row_only), F.lit(False)) | (F.col("row_no") == 0))
    return _finish(parsed, F.when(F.col("table").isNull(), "unreadable").when(F.col("payload").isNull(), "no row"))


def parse(messages: DataFrame, category: str) -> DataFrame:
    """Parse by capture tool; messages of any other category pass through unchanged."""
    if category == "oracle":
        return parse_oracle(messages)
    if category == "mysql":
        return parse_mysql(messages)
    return messages


def check_tables(changes: DataFrame, catalogue: dict[str, Table]) -> DataFrame:
    """Mark changes of tables that are not in the catalogue, and rows without a key."""
    key = F.lit(None)
    for name in {table.key for table in catalogue.values()}:
        tables = [t.name for t in catalogue.values() if t.key == name]
        key = F.when(F.col("table").isin(tables), F.try_element_at("payload", F.lit(name))).otherwise(key)
    problem = (F.when(F.col("problem").isNotNull(), F.col("problem"))
               .when(~F.col("table").isin(list(catalogue)), "unknown table")
               .when(F.trim(key).try_cast("bigint").isNull(), "no key"))
    return changes.withColumn("problem", problem).withColumn("value", F.when(F.col("problem").isNotNull(), F.col("value")))


def typed_rows(changes: DataFrame, table: Table, null_numbers_as_zero: bool = False) -> DataFrame:
    """The good changes of one table, with the table's columns, ``op_type`` and the order columns.

    A value that does not read as its column's type is NULL. ``null_numbers_as_zero`` gives 0 for missing numbers.
    """
    def value(column) -> Column:
        names = dict.fromkeys([column.source_name, column.name])
        text = F.coalesce(*[F.try_element_at("payload", F.lit(n)) for n in names])
        typed = text if isinstance(column.type, T.StringType) else F.trim(text).try_cast(column.type)
        if null_numbers_as_zero and not isinstance(column.type, T.StringType):
            typed = F.coalesce(typed, F.lit(0).cast(column.type))
        return typed.alias(column.name)

    return (changes.where(F.col("problem").isNull() & (F.col("table") == table.name))
            .select(*[value(c) for c in table.columns], "op_type", *ORDER)
            .where(F.col(table.key).isNotNull()))


def last_change(rows: DataFrame, key: str = "id", order: Sequence[str] = ORDER) -> DataFrame:
    """One row per key: the change that is last in ``order``; of two that tie, the one with the larger values.

    Each task first keeps one row per key, so a key that holds much of the input still sends one row per task.
    """
    rest = [*order, *[c for c in rows.columns if c != key and c not in order]]
    return (rows.groupBy(key).agg(F.max(F.struct(*rest)).alias("last"))
            .select([F.col(c) if c == key else F.col(f"last.{c}").alias(c) for c in rows.columns]))


def upserts(changes: DataFrame) -> DataFrame:
    """Inserts and updates, without the operation column."""
    return changes.where(F.col("op_type").isin("insert", "update")).drop("op_type")


def deletes(changes: DataFrame, key: str = "id") -> DataFrame:
    """The keys to delete."""
    return changes.where(F.col("op_type") == "delete").select(key)


def where_json_path(messages: DataFrame, path: str, values: Sequence[str], column: str = "value") -> DataFrame:
    """Keep messages whose JSON has one of ``values`` at ``path``, before anything is parsed."""
    return messages.where(has_text(column) & F.get_json_object(column, path).isin(list(values)))


def check_operations(changes: DataFrame, column: str = "op_type") -> DataFrame:
    """Fail the job when a row has an operation that nobody knows."""
    known = sorted(set(OPERATIONS.values()))
    message = F.concat(F.lit("unknown operation: "), F.coalesce(F.col(column), F.lit("NULL")))
    return changes.withColumn(column, F.when(F.col(column).isin(known), F.col(column))
                              .otherwise(F.raise_error(message).cast("string")))
