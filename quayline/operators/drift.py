"""Fields of change messages that the catalogue does not know.

Rows of changes are read as maps of texts, from which a table's columns are taken; whatever else a source sends would vanish.
Here the rows are read as VARIANT, which keeps the type that each value has in the message.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from quayline.operators.cdc import crm_to_tbl, has_text, strip_schema
from quayline.schemas import Table


def variant_rows(messages: DataFrame, category: str) -> DataFrame:
    """``table`` and ``row``, a VARIANT, of every row in the messages; what does not parse has none."""
    whole = F.try_parse_json("value")
    if category == "oracle":
        parsed = messages.where(has_text("value")).select(F.inline(F.array(F.struct(whole.alias("whole")))))
        after, before = (F.try_variant_get("whole", f"$.{side}", "variant") for side in ("after", "before"))
        row = F.when(after.isNotNull() & ~F.is_variant_null(after), after).otherwise(before)
        rows = parsed.select(strip_schema(F.try_variant_get("whole", "$.table", "string")).alias("table"), row.alias("row"))
    elif category == "mysql":
        parsed = messages.where(has_text("value")).select(F.inline(F.array(F.struct(whole.alias("whole")))))
        rows = parsed.select(crm_to_tbl(F.try_variant_get("whole", "$.table", "string")).alias("table"),
                             F.explode(F.try_variant_get("whole", "$.data", "array<variant>")).alias("row"))
    else:
        raise ValueError(f"no rows in messages of category {category!r}")
    return rows.where(F.col("table").isNotNull() & F.col("row").isNotNull())


def unknown_fields(messages: DataFrame, category: str, catalogue: Mapping[str, Table]) -> DataFrame:
    """The fields that rows of known tables have and the catalogue has not: ``table``, ``field``, ``type`` and ``rows``.

    The type is the narrowest that all values of a field have; NULLs have none (``VOID``). One row per field leaves a task.
    A row that is no object has no fields.
    """
    spark = messages.sparkSession
    known = [(t.name, n) for t in catalogue.values() for c in t.columns for n in dict.fromkeys([c.source_name, c.name])]
    fields = F.broadcast(spark.createDataFrame(known, "table string, field string"))  # the size of the catalogue
    named = variant_rows(messages, category).where(F.col("table").isin(list(catalogue)))
    # a map of variants keeps every field; rows that are no objects have no map
    sent = named.select("table", F.explode(F.try_variant_get("row", "$", "map<string, variant>")).alias("field", "value"))
    return (sent.join(fields, ["table", "field"], "left_anti").groupBy("table", "field")
            .agg(F.schema_of_variant_agg("value").alias("type"), F.count(F.lit(1)).alias("rows")))
