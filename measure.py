"""Compare the plans of this repository with the plain forms they replace; prints one line per comparison.

``python measure.py [folder]``, at ``sf0.1`` by default.
"""

from __future__ import annotations

import sys
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from quayline.checks.queries import oracle_messages
from quayline.operators import cdc
from quayline.operators.keyed import KeyedTable
from quayline.operators.kpi import stats_of_group_counts
from quayline.plans import wide
from quayline.schemas import load_catalogue
from quayline.session import build_session, fresh_path, stream_id
from quayline.checks.derived import DerivedTables
from quayline.sources.streams import file_stream
from quayline.streaming import feeds

KEYS = {"Priority": "o_orderpriority", "Status": "o_orderstatus", "Terminal": "terminal"}


def drain(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def best(run: Callable[[], object], times: int = 3) -> float:
    took = []
    for _ in range(times):
        start = time.perf_counter()
        run()
        took.append(time.perf_counter() - start)
    return min(took)


def kpi_loop(rows: DataFrame) -> None:
    """A filter and four jobs per day, as a driver loop."""
    for (day,) in rows.select("day").distinct().collect():
        part = rows.where(F.col("day") == day)
        part.agg(F.count("o_orderkey")).first()
        for key in KEYS.values():
            part.groupBy(key).count().agg(F.max("count"), F.min("count"), F.round(F.avg("count"), 0)).first()


def compare_kpi(spark: SparkSession, folder: str) -> None:
    rows = spark.read.parquet(f"{folder}/orders.parquet").select(
        F.date_format("o_orderdate", "yyyyMM").alias("day"), "o_orderkey", "o_orderpriority", "o_orderstatus",
        (F.col("o_custkey") % 7).alias("terminal"))
    single = best(lambda: drain(stats_of_group_counts(rows, KEYS, total="o_orderkey")))
    loop = best(lambda: kpi_loop(rows), 1)
    print(f"KPIs of {rows.select('day').distinct().count()} periods: one pass {single:.2f} s, driver loop {loop:.2f} s")


def compare_feed(spark: SparkSession, folder: str, tables: int) -> None:
    names = list(load_catalogue())[:tables]
    catalogue = {n: load_catalogue()[n] for n in names}
    events = spark.read.parquet(f"{folder}/events.parquet").withColumn("value", F.lit(1.0))
    table = F.element_at(F.array(*[F.lit(n) for n in names]), (F.col("n") % len(names) + 1).cast("int"))
    inbox = fresh_path(spark, "messages")
    (oracle_messages(events).withColumn("n", F.monotonically_increasing_id())
     .select(F.regexp_replace("value", "tbl_(vehicle_monitor|waybill_line|nowhere)", table).alias("value"))
     .write.text(inbox))

    def one_query() -> None:
        feeds.start_change_feed(file_stream(spark, inbox), "oracle", fresh_path(spark, "a"), fresh_path(spark, "s"),
                                catalogue, available_now=True).awaitTermination()

    def two_per_table() -> None:
        root, queries = fresh_path(spark, "b"), []
        for name, spec in catalogue.items():
            rows = cdc.typed_rows(cdc.parse(file_stream(spark, inbox), "oracle"), spec)
            for kind, part in (("u", rows.where("op_type <> 'delete'")), ("d", rows.where("op_type = 'delete'"))):
                store = KeyedTable(spark, f"{root}/{name}-{kind}", spec.schema)
                writer = part.writeStream.option("checkpointLocation", fresh_path(spark, "s")).trigger(availableNow=True)
                queries.append(writer.foreachBatch(lambda df, n, store=store: store.apply(df, n, feed=stream_id(df))).start())
        for query in queries:
            query.awaitTermination()

    line = f"change feed into {len(names)} tables: one query {best(one_query, 2):.2f} s"
    if tables <= 10:  # a hundred queries at a time are more than one machine bears
        line += f", two per table {best(two_per_table, 2):.2f} s"
    print(line)


def compare_shape(spark: SparkSession, folder: str) -> None:
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "200k")
    tables = DerivedTables(spark, folder)
    for job in (wide.EXPRESS_BILL, wide.TRANSPORT_RECORD):
        times = [best(lambda n=n: drain(wide.wide_table(job, tables, nested=n))) for n in (True, False)]
        print(f"{job.name}, little broadcast: large dimensions first {times[0]:.2f} s, all to the fact {times[1]:.2f} s")


def compare_last_change(spark: SparkSession, folder: str) -> None:
    lines = spark.read.parquet(f"{folder}/lineitem.parquet")
    rows = lines.select(
        F.col("l_partkey").alias("id"), "l_shipdate", "l_orderkey", "l_linenumber", "l_extendedprice", "l_returnflag",
        F.explode(F.sequence(F.lit(1), F.lit(10))).alias("copy"))
    order = ["l_shipdate", "l_orderkey", "l_linenumber", "copy", "l_extendedprice"]
    window = Window.partitionBy("id").orderBy(*[F.col(c).desc() for c in order])
    biggest = best(lambda: drain(cdc.last_change(rows, order=order)))
    ranked = best(lambda: drain(rows.withColumn("place", F.row_number().over(window)).where("place = 1")))
    print(f"last change of {rows.count()} rows: greatest struct {biggest:.2f} s, row number {ranked:.2f} s")


def main() -> None:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session("measure", "local[8]", settings={
        "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "16g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    for compare in (compare_kpi, compare_feed, compare_last_change, compare_shape):
        compare(spark, folder)
    spark.stop()


if __name__ == "__main__":
    main()
