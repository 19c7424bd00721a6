"""Change messages made from the generic tables, and their outcome as one frame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def oracle_messages(events: DataFrame) -> DataFrame:
    """An event stream as Oracle change messages: of two tables, of an unknown one, and broken ones."""
    kind = F.col("event_type")
    op = F.when(kind == "view", "U").when(kind == "error", "D").when(kind == "purchase", "X").otherwise("I")
    table = (F.when(kind == "signup", "SRC.tbl_nowhere").when(F.col("user_id") % 2 == 0, "SRC.tbl_vehicle_monitor")
             .otherwise("SRC.tbl_waybill_line"))
    row = F.create_map(
        F.lit("id"), F.col("user_id").cast("string"),
        F.lit("delivery_record"), F.col("event_id").cast("string"),
        F.lit("express_bill__id"), kind,
        F.lit("route_id"), F.col("event_id").cast("string"),
        F.lit("waybill_number"), F.concat(F.lit("WB"), F.col("user_id")),
        F.lit("transport_tool"), F.lit("none"),
        F.lit("cdt"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    envelope = F.struct(
        table.alias("table"), op.alias("op_type"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("op_ts"),
        F.col("event_id").cast("string").alias("pos"),
        F.when(op == "D", row).alias("before"), F.when(op != "D", row).alias("after"))
    text = F.to_json(envelope)
    broken = F.when(F.col("value") > 200, F.lit("   ")).when(F.col("value") > 150, F.substring(text, 1, 30))
    return events.select(F.explode(F.array(F.coalesce(broken, text))).alias("value"))  # written once, not per use


def mysql_messages(orders: DataFrame) -> DataFrame:
    """Orders as MySQL change messages: three address maps per order, none for a cancelled one."""
    def row(i: int) -> Column:
        return F.create_map(
            F.lit("id"), (F.col("o_custkey") * 3 + i).cast("string"),
            F.lit("consumer_id"), F.col("o_custkey").cast("string"),
            F.lit("address_id"), (F.col("o_orderkey") + i).cast("string"),
            F.lit("remark"), F.col("o_orderpriority"))

    data = F.when(F.col("o_orderstatus") == "P", F.array().cast("array<map<string,string>>")).otherwise(
        F.array(row(0), row(1), row(2)))
    table = F.when(F.col("o_orderpriority") == "5-LOW", "crm_customer").otherwise("crm_consumer_address_map")
    kind = (F.when(F.col("o_orderpriority") == "1-URGENT", "DELETE")
            .when(F.col("o_orderpriority") == "2-HIGH", "UPDATE").otherwise("INSERT"))
    text = F.to_json(F.struct(
        data.alias("data"), F.lit("crm").alias("database"), F.col("o_orderkey").alias("id"),
        F.lit(False).alias("isDdl"), table.alias("table"),
        F.unix_millis(F.col("o_orderdate").cast("timestamp")).alias("ts"), kind.alias("type")))
    return orders.select(F.explode(F.array(text)).alias("value"))


def with_rejects(parts: dict[str, DataFrame], rejected: DataFrame) -> DataFrame:
    """Rows of several tables, each with all its columns, and the messages that could not be used, by problem."""
    counts = rejected.groupBy("table", "problem").agg(F.count(F.lit(1)).alias("messages"))
    for name, rows in parts.items():
        counts = counts.unionByName(rows.withColumn("table", F.lit(name)), allowMissingColumns=True)
    return counts
