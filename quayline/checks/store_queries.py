"""Buckets, ranges, drifting fields, watched feeds and the SQL functions, as queries with their SQL."""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F

from quayline.checks import messages
from quayline.checks.derived import DerivedTables
from quayline.operators.bucketed import BucketedTables
from quayline.operators.drift import unknown_fields
from quayline.operators.joins import widen
from quayline.operators.ranges import equal_ranges
from quayline.plans import sql, wide
from quayline.schemas import load_catalogue
from quayline.session import fresh_path
from quayline.sources.streams import file_stream
from quayline.streaming import feeds, supervision

RANGES = 16
FILES = 4
#: The columns by which the tables of the bill job lie in buckets.
BUCKET_KEYS = {"tbl_express_bill": "id", "tbl_customer": "id", "tbl_courier": "id", "tbl_consumer_address_map": "consumerId",
               "tbl_address": "id", "tbl_pkg": "pwBill", "tbl_dot": "id", "tbl_company_dot_map": "dotId", "tbl_company": "id"}


def bucketed_tables(spark: SparkSession, folder: str) -> BucketedTables:
    """The source tables of the bill job as catalog tables in buckets."""
    derived, tables = DerivedTables(spark, folder), BucketedTables(spark, f"quay_{uuid.uuid4().hex}_", BUCKET_KEYS)
    for name in BUCKET_KEYS:
        tables.write(name, derived(name), buckets=8)
    tables.keys["tbl_codes"] = "id"
    tables.write("tbl_codes", derived("tbl_codes"), buckets=1)
    return tables


def wide_bucketed(spark: SparkSession, folder: str) -> DataFrame:
    """The bill table from tables in buckets."""
    tables = bucketed_tables(spark, folder)
    return widen(wide.EXPRESS_BILL, tables, co_located=tables.keys)


def skewed_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders under a key that a third of them share and some have not."""
    key = F.when(F.col("o_orderkey") % 3 == 0, 77).when(F.col("o_orderkey") % 50 == 1, None).otherwise(F.col("o_custkey"))
    return spark.read.parquet(f"{folder}/orders.parquet").select(key.cast("long").alias("id"), "o_orderkey", "o_orderpriority")


def keyed_ranges(spark: SparkSession, folder: str) -> DataFrame:
    """Rows by single keys, a frequent one and none among them, and rows of a span of keys."""
    table = equal_ranges(spark, skewed_orders(spark, folder), "id", RANGES)
    return (table.lookup([77, 5, None, -1]).withColumn("asked", F.lit("keys"))
            .unionByName(table.between(100, 140).withColumn("asked", F.lit("span")))
            .unionByName(table.snapshot().withColumn("asked", F.lit("all"))))


def drifting_messages(events: DataFrame) -> DataFrame:
    """Change messages with fields that nobody announced, of several types."""
    number = F.col("event_id")

    def text(axles) -> F.Column:
        row = F.struct(
            F.col("user_id").cast("string").alias("id"), F.col("event_type").alias("delivery_record"),
            F.when(F.col("value") > 50, number).alias("speed"), F.when(F.col("user_id") % 3 == 0, F.col("event_type")).alias("driver"),
            (F.col("value") > 20).alias("sealed"), axles.alias("axles"),
            F.when(number % 5 == 0, F.struct((number % 90).alias("lat"), (F.col("user_id") % 180).alias("lon"))).alias("gps"))
        table = F.when(F.col("event_type") == "signup", "SRC.tbl_nowhere").when(
            F.col("user_id") % 2 == 0, "SRC.tbl_vehicle_monitor").otherwise("SRC.tbl_waybill_line")
        deleted = F.col("event_type") == "error"
        return F.to_json(F.struct(table.alias("table"), F.lit("U").alias("op_type"), F.when(deleted, row).alias("before"),
                                  F.when(~deleted, row).alias("after")))

    return events.select(F.when(number % 2 == 0, text(number % 6)).otherwise(text(F.lit("two"))).alias("value"))


def cdc_schema_drift(spark: SparkSession, folder: str) -> DataFrame:
    """The fields that the catalogue does not know, with the type and the rows of each."""
    return unknown_fields(drifting_messages(spark.read.parquet(f"{folder}/events.parquet")), "oracle", load_catalogue())


def feed_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """What a feed of three batches reported of each."""
    rows, inbox = spark.read.parquet(f"{folder}/events.parquet"), fresh_path(spark, "messages")
    for part in range(3):
        messages.oracle_messages(rows.where(F.col("event_id") % 3 == part)).repartition(FILES).write.mode("append").text(inbox)
    metrics = supervision.watch(spark)
    try:
        query = feeds.start_change_feed(file_stream(spark, inbox, FILES), "oracle", fresh_path(spark, "tables"),
                                        fresh_path(spark, "checkpoint"), load_catalogue(), available_now=True)
        supervision.await_first(spark, [query])
        metrics.wait_for(query)
    finally:
        spark.streams.removeListener(metrics)
    return metrics.frame(spark).where(F.col("query") == str(query.id)).select("batch", "rows", "rejects")


def sql_functions(spark: SparkSession, folder: str) -> DataFrame:
    """Wide tables and KPIs through SQL alone."""
    sql.register(spark, DerivedTables(spark, folder))
    return spark.sql("""
        SELECT w.company_name, count(*) AS bills, max(k.total) AS busiest_day, min(one.total) AS total_of_a_day
        FROM wide_express_bill() w JOIN kpi_express_bill() k ON k.id = w.day
             LEFT JOIN kpi_express_bill('19980615') one ON one.id = w.day
        GROUP BY w.company_name""")


QUERIES = {f.__name__: f for f in (wide_bucketed, keyed_ranges, cdc_schema_drift, feed_metrics, sql_functions)}


def oracles(others: Mapping[str, str]) -> dict[str, str]:
    skewed = """SELECT CAST(CASE WHEN o_orderkey % 3 = 0 THEN 77 WHEN o_orderkey % 50 = 1 THEN NULL ELSE o_custkey END AS BIGINT)
                       AS id, o_orderkey, o_orderpriority FROM orders"""
    known = "CASE WHEN user_id % 2 = 0 THEN 'tbl_vehicle_monitor' ELSE 'tbl_waybill_line' END"
    fields = {"speed": ("BIGINT", "value > 50"), "driver": ("STRING", "user_id % 3 = 0"),
              "sealed": ("BOOLEAN", "value IS NOT NULL"), "axles": ("VARIANT", "TRUE"),
              "delivery_record": ("STRING", "user_id % 2 = 1"),  # the other table has it
              "gps": ("OBJECT<lat: BIGINT, lon: BIGINT>", "event_id % 5 = 0")}
    return {
        "wide_bucketed": others["wide_express_bill"],
        "keyed_ranges": f"""
            SELECT *, 'keys' AS asked FROM ({skewed}) WHERE id IN (77, 5, -1) OR id IS NULL
            UNION ALL SELECT *, 'span' FROM ({skewed}) WHERE id BETWEEN 100 AND 140
            UNION ALL SELECT *, 'all' FROM ({skewed})""",
        "cdc_schema_drift": " UNION ALL ".join(f"""
            SELECT {known} AS "table", '{field}' AS field, '{kind}' AS type, count(*) AS rows FROM events
            WHERE event_type <> 'signup' AND {condition} GROUP BY 1""" for field, (kind, condition) in fields.items()),
        "feed_metrics": """
            SELECT event_id % 3 AS batch, count(*) AS rows,
                   count(*) FILTER (WHERE value > 150 OR event_type = 'signup') AS rejects
            FROM events WHERE value <= 200 OR value IS NULL GROUP BY 1""",
        "sql_functions": f"""
            WITH w AS ({others["wide_express_bill"]}), k AS ({others["kpi_express_bill"]})
            SELECT w.company_name, count(*) AS bills, max(k.total) AS busiest_day,
                   min(CASE WHEN k.id = '19980615' THEN k.total END) AS total_of_a_day
            FROM w JOIN k ON k.id = w.day GROUP BY 1""",
    }
