"""Every operator as a query over the generic tables of a folder, each over its whole input."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from quayline.functions import calendar as cal, columns as fc
from quayline.operators import audit, cdc, changelog, joins, keyed, kpi, search
from quayline.plans import jobs, summary, wide
from quayline.plans.increments import stored as stored_rows
from quayline.schemas import CODE_TYPES, load_catalogue
from quayline.session import fresh_path
from quayline.sources import delimited, tables as stored
from quayline.checks import change_queries, search_queries, store_queries
from quayline.checks.derived import DerivedTables
from quayline.checks.messages import mysql_messages, oracle_messages, with_rejects
from quayline.sources.streams import file_stream, table_stream
from quayline.streaming import feeds

Query = Callable[[SparkSession, str], DataFrame]

GENERIC = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
           "embeddings", "pages", "benchmark", "labels", "conversations")
TERMS = ("the", "and")
ORDERS_AS_OF = "2001-08-02"
EVENTS_AS_OF = "2024-01-31"


def _read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


# --- wide tables and KPIs -----------------------------------------------------------------------------------------


def _wide(job: joins.WideJob, **options) -> Query:
    return lambda spark, folder: wide.wide_table(job, DerivedTables(spark, folder), **options)


def _kpi(job: summary.SummaryJob) -> Query:
    return lambda spark, folder: summary.summarise_source(job, DerivedTables(spark, folder))


def wide_customer(spark: SparkSession, folder: str) -> DataFrame:
    return wide.customer_wide(DerivedTables(spark, folder))


def kpi_customer(spark: SparkSession, folder: str) -> DataFrame:
    return summary.customer_summary(DerivedTables(spark, folder), ORDERS_AS_OF)


def sender_totals(spark: SparkSession, folder: str) -> DataFrame:
    tables = DerivedTables(spark, folder)
    totals = wide.sender_totals(tables("tbl_consumer_sender_info"), tables("tbl_express_package"))
    return totals.withColumn("totalAmount", F.col("totalAmount").cast("double"))


def dictionary_decode(spark: SparkSession, folder: str) -> DataFrame:
    tables = DerivedTables(spark, folder)
    channels = joins.dictionary_slice(tables("tbl_codes"), CODE_TYPES["order_channel_type"], "channel_code",
                                      "channel_name")
    bills = tables("tbl_express_bill").select("id", "orderChannelId")
    return (bills.join(channels, F.col("orderChannelId") == F.col("channel_code").try_cast("bigint"), "left")
            .groupBy("orderChannelId", "channel_name").agg(F.count("id").alias("bills")))


def kpi_order_daily(spark: SparkSession, folder: str) -> DataFrame:
    orders, customer, nation = (_read(spark, folder, n) for n in ("orders", "customer", "nation"))
    rows = (orders.join(customer, F.col("o_custkey") == F.col("c_custkey"), "left")
            .join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
            .select(fc.day_of_time("o_orderdate").alias("day"), "o_orderkey", "o_orderpriority",
                    F.nullif("o_orderstatus", F.lit("P")).alias("status"), "c_mktsegment", "n_name"))
    return kpi.stats_of_group_counts(
        rows, {"Segment": "c_mktsegment", "Nation": "n_name", "Priority": "o_orderpriority", "Status": "status"},
        total="o_orderkey", sums=True)


def distinct_days(spark: SparkSession, folder: str) -> DataFrame:
    orders = _read(spark, folder, "orders").select(fc.day_of_text(F.col("o_orderdate").cast("string")).alias("day"))
    return kpi.distinct_days(orders)


def group_count(spark: SparkSession, folder: str) -> DataFrame:
    return kpi.group_count(_read(spark, folder, "part"), "p_brand")


# --- scans --------------------------------------------------------------------------------------------------------


def incremental_scan(spark: SparkSession, folder: str) -> DataFrame:
    return stored.load_fact(_read(spark, folder, "events"), "incremental", EVENTS_AS_OF, "ts").select(
        "event_id", "user_id", "event_type")


def incremental_scan_text(spark: SparkSession, folder: str) -> DataFrame:
    bills = DerivedTables(spark, folder)("tbl_express_bill")
    return stored.load_fact(bills, "incremental", "1998-06-16").select("id", "cdt")


def query_by_example(spark: SparkSession, folder: str) -> DataFrame:
    example = {"p_partkey": 0, "p_name": None, "p_brand": "Brand#12", "p_type": "", "p_size": 7}
    return stored.query_by_example(_read(spark, folder, "part"), example)


def query_by_example_limit(spark: SparkSession, folder: str) -> DataFrame:
    """A look at the first rows in key order: the limit is what is asked for."""
    example = {"p_partkey": 0, "p_brand": "Brand#12"}
    return stored.query_by_example(_read(spark, folder, "part"), example, limit=5, order=["p_partkey"])


def csv_ingest(spark: SparkSession, folder: str) -> DataFrame:
    """Orders written as ragged lines, some too long, some with an unreadable number, and read back."""
    names = ["o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority", "o_totalprice", "o_orderstatus"]
    orders = _read(spark, folder, "orders")
    when = F.date_format("o_orderdate", delimited.FILE_TIME)
    late = F.when(F.col("o_orderstatus") == "P", F.lit("")).otherwise(F.col("o_orderstatus"))
    price = (F.when(F.col("o_orderpriority") == "5-LOW", F.lit(""))
             .when(F.col("o_totalprice") < 20000, F.lit("n/a"))
             .otherwise(F.col("o_totalprice").cast("decimal(18,2)").cast("string")))
    line = F.concat_ws(",", F.col("o_orderkey"), F.concat(F.lit(" "), F.col("o_custkey"), F.lit(" ")), when,
                       F.col("o_orderpriority"), price, late,
                       F.when(F.col("o_totalprice") > 490000, F.lit("one more")))
    path = fresh_path(spark, "orders.csv")
    orders.select(F.regexp_replace(line, ",$", "").alias("value")).write.text(path)
    schema = (T.StructType().add("o_orderkey", "long").add("o_custkey", "long").add("o_orderdate", "timestamp")
              .add("o_orderpriority", "string").add("o_totalprice", "double").add("o_orderstatus", "string"))
    good, rejected = delimited.ingest(spark, path, schema, names, header_lines=False)
    return good.withColumn("problem", F.lit(None).cast("string")).unionByName(
        rejected.select(F.split("line", ",")[0].cast("bigint").alias("o_orderkey"), "problem"),
        allowMissingColumns=True)


# --- change events ------------------------------------------------------------------------------------------------


def _applied(messages: DataFrame, category: str, *names: str) -> DataFrame:
    """All tables that the messages are of, after the last change of each key, and the rejects; parsed once for all."""
    changes = stored_rows(cdc.check_tables(cdc.parse(messages, category), load_catalogue()).sortWithinPartitions("table"))
    rows = {n: cdc.upserts(cdc.last_change(cdc.typed_rows(changes, load_catalogue()[n]))).drop(*cdc.ORDER) for n in names}
    return with_rejects(rows, changes.where(F.col("problem").isNotNull()))


def _stored(spark: SparkSession, root: str, *names: str) -> DataFrame:
    """The stored tables under a root, and the rejects of all feeds."""
    tables = feeds.keyed_tables(spark, root, load_catalogue())
    return with_rejects({n: tables[n].snapshot() for n in names}, feeds.rejects(spark, root))


def cdc_oracle_apply(spark: SparkSession, folder: str) -> DataFrame:
    return _applied(oracle_messages(_read(spark, folder, "events")), "oracle", "tbl_vehicle_monitor", "tbl_waybill_line")


def broken_mysql_messages(orders: DataFrame) -> DataFrame:
    """The same with some messages that have no rows, rows of the wrong kind, nothing, or half a text."""
    text, part = F.col("value"), F.get_json_object("value", "$.id").cast("bigint") % 50
    kind = F.regexp_replace(text, r'"data":\[.*\],"database"', '"data":7,"database"')
    return mysql_messages(orders).select(
        F.when(part == 1, F.regexp_replace(text, r'"data":\[.*\],"database"', '"database"')).when(part == 2, kind)
        .when(part == 3, F.lit("  ")).when(part == 4, F.substring(text, 1, 40)).otherwise(text).alias("value"))


def cdc_oracle_deletes(spark: SparkSession, folder: str) -> DataFrame:
    changes = cdc.parse(oracle_messages(_read(spark, folder, "events")), "oracle")
    rows = cdc.typed_rows(changes, load_catalogue()["tbl_waybill_line"], null_numbers_as_zero=True)
    last = cdc.last_change(rows)
    return cdc.deletes(last).join(last.select("id", "routeId", "transportTool"), "id")


def cdc_mysql_apply(spark: SparkSession, folder: str) -> DataFrame:
    return _applied(mysql_messages(_read(spark, folder, "orders")), "mysql", "tbl_consumer_address_map", "tbl_customer")


def cdc_mysql_first_row(spark: SparkSession, folder: str) -> DataFrame:
    changes = cdc.parse_mysql(mysql_messages(_read(spark, folder, "orders")), first_row_only=["tbl_customer"])
    return changes.groupBy("table", "op_type").agg(F.count(F.lit(1)).alias("changes"))


def cdc_route_counts(spark: SparkSession, folder: str) -> DataFrame:
    changes = cdc.check_tables(cdc.parse(oracle_messages(_read(spark, folder, "events")), "oracle"), load_catalogue())
    return changes.groupBy("table", "op_type", "problem").agg(F.count(F.lit(1)).alias("changes"))


def json_path_filter(spark: SparkSession, folder: str) -> DataFrame:
    events = _read(spark, folder, "events")
    return cdc.where_json_path(events, "$.k", ["7", "42", "69"], column="props").select("event_id", "props")


def stream_cdc(spark: SparkSession, folder: str) -> DataFrame:
    messages = oracle_messages(table_stream(spark, f"{folder}/events.parquet"))
    root, catalogue = fresh_path(spark, "tables"), load_catalogue()
    feeds.start_change_feed(messages, "oracle", root, fresh_path(spark, "checkpoint"), catalogue, available_now=True,
                            tasks=spark.sparkContext.defaultParallelism).awaitTermination()
    return _stored(spark, root, "tbl_vehicle_monitor", "tbl_waybill_line")


def two_feeds(spark: SparkSession, folder: str) -> DataFrame:
    """An Oracle and a MySQL stream into one warehouse: its tables, and the rejects of both."""
    root, catalogue, tasks = fresh_path(spark, "tables"), load_catalogue(), spark.sparkContext.defaultParallelism
    for category, name, messages in (("oracle", "events", oracle_messages), ("mysql", "orders", broken_mysql_messages)):
        feeds.start_change_feed(messages(table_stream(spark, f"{folder}/{name}.parquet")), category, root,
                                fresh_path(spark, "checkpoint"), catalogue, available_now=True, tasks=tasks).awaitTermination()
    return _stored(spark, root, "tbl_vehicle_monitor", "tbl_waybill_line", "tbl_consumer_address_map", "tbl_customer")


def cdc_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """The messages of both tools that cannot be used, by problem."""
    parts = [cdc.check_tables(cdc.parse(messages, category), load_catalogue()) for category, messages in (
        ("oracle", oracle_messages(_read(spark, folder, "events"))),
        ("mysql", broken_mysql_messages(_read(spark, folder, "orders"))))]
    return (parts[0].select("table", "problem").unionByName(parts[1].select("table", "problem"))
            .where(F.col("problem").isNotNull()).groupBy("table", "problem").agg(F.count(F.lit(1)).alias("messages")))


def cdc_order(spark: SparkSession, folder: str) -> DataFrame:
    """The last change of each key where positions of 19 to 25 digits decide: commit times are equal."""
    messages = _read(spark, folder, "orders").select(F.to_json(F.struct(
        F.lit("SRC.tbl_job").alias("table"), F.lit("U").alias("op_type"), F.lit("2020-01-01 00:00:00").alias("op_ts"),
        _long_position().alias("pos"), F.create_map(
            F.lit("id"), F.col("o_custkey").cast("string"), F.lit("job_name"), F.col("o_orderkey").cast("string"))
        .alias("after"))).alias("value"))
    rows = cdc.typed_rows(cdc.parse(messages, "oracle"), load_catalogue()["tbl_job"])
    return cdc.last_change(rows).select("id", "jobName")


def _long_position() -> Column:
    """A number that falls with the order's key, of 19 to 25 digits, some with zeros in front."""
    digits = F.concat(F.lit("9"), F.repeat(F.lit("0"), (F.col("o_orderkey") % 7).cast("int")),
                      F.lpad((F.lit(10 ** 9) - F.col("o_orderkey")).cast("string"), 18, "0"))
    return F.when(F.col("o_orderpriority") == "5-LOW", F.lpad(digits, 25, "0")).otherwise(digits)


def cdc_pass_through(spark: SparkSession, folder: str) -> DataFrame:
    """Messages of a category that nobody knows go on as they are."""
    messages = _read(spark, folder, "events").select(F.col("props").alias("value"), "event_id")
    return cdc.parse(messages, "audit")


def cdc_unknown_operations(spark: SparkSession, folder: str) -> DataFrame:
    """Operations by what becomes of a job that meets them: known ones pass, all rows together make it fail."""
    kind = F.col("event_type")
    rows = _read(spark, folder, "events").select(
        "event_id", F.when(kind == "error", "truncate").when(kind != "signup", "insert").alias("op_type"))
    known = F.coalesce(F.col("op_type").isin(*set(cdc.OPERATIONS.values())), F.lit(False))

    def fails(some: DataFrame) -> bool:
        try:
            cdc.check_operations(some).write.format("noop").mode("overwrite").save()
        except PySparkException as error:
            return "unknown operation: " in str(error)
        return False

    outcome = F.when(known, F.lit(fails(rows.where(known)))).otherwise(F.lit(fails(rows)))
    return rows.groupBy("op_type").agg(F.count(F.lit(1)).alias("rows")).withColumn("refused", outcome)


def stream_documents(spark: SparkSession, folder: str) -> DataFrame:
    messages = oracle_messages(table_stream(spark, f"{folder}/events.parquet"))
    root, catalogue = fresh_path(spark, "documents"), load_catalogue()
    wanted = {n: catalogue[n] for n in ("tbl_vehicle_monitor", "tbl_waybill_line")}
    feeds.start_document_feed(messages, wanted, root, fresh_path(spark, "checkpoint"), schema_prefix="SRC.",
                              available_now=True).awaitTermination()
    return _stored(spark, root, *wanted)


def row_messages(rows: DataFrame, name: str) -> DataFrame:
    """Rows of a source table as Oracle inserts."""
    table = load_catalogue()[name]
    row = F.create_map(*[part for c in table.columns if c.name in rows.columns
                         for part in (F.lit(c.source_name), F.col(c.name).cast("string"))])
    envelope = F.struct(F.lit(f"SRC.{name}").alias("table"), F.lit("I").alias("op_type"),
                        F.lit("2020-01-01 00:00:00").alias("op_ts"), F.col("id").cast("string").alias("pos"),
                        row.alias("after"))
    return rows.select(F.explode(F.array(F.to_json(envelope))).alias("value"))


def feed_to_kpi(spark: SparkSession, folder: str) -> DataFrame:
    """From a stream of change events of all ten tables through stored tables and the wide table to the KPIs."""
    derived, inbox = DerivedTables(spark, folder), fresh_path(spark, "messages")
    for name in dict.fromkeys([wide.EXPRESS_BILL.table, *[lookup.table for lookup in wide.EXPRESS_BILL.lookups]]):
        row_messages(derived(name), name).write.mode("append").option("compression", "gzip").text(inbox)
    root, catalogue = fresh_path(spark, "tables"), load_catalogue()
    feeds.start_change_feed(file_stream(spark, inbox), "oracle", root, fresh_path(spark, "checkpoint"), catalogue,
                            available_now=True, tasks=spark.sparkContext.defaultParallelism).awaitTermination()
    return summary.summarise_source(summary.EXPRESS_BILL, stored.StoredTables(spark, root, catalogue))


# --- keyed and changelog tables -----------------------------------------------------------------------------------

ACCOUNT = T.StructType().add("id", "long").add("name", "string").add("amount", "double")


def _accounts(spark: SparkSession, folder: str) -> DataFrame:
    return _read(spark, folder, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("amount"))


def _account_changes(spark: SparkSession, folder: str) -> DataFrame:
    """A change per order; every key is moved by 500, so that some accounts are new."""
    op = (F.when(F.col("o_orderstatus") == "P", "delete").when(F.col("o_orderstatus") == "O", "insert")
          .otherwise("update"))
    return _read(spark, folder, "orders").select(
        (F.col("o_custkey") + 500).alias("id"), F.col("o_orderpriority").alias("name"),
        F.col("o_totalprice").alias("amount"), op.alias("op_type"),
        F.col("o_orderdate").alias("at"), F.col("o_orderkey").alias("seq"))


def _account_versions(spark: SparkSession, folder: str) -> DataFrame:
    """All inserts and updates: keys come several times."""
    return cdc.upserts(_account_changes(spark, folder))


def _account_rows(spark: SparkSession, folder: str) -> DataFrame:
    return cdc.upserts(cdc.last_change(_account_changes(spark, folder), order=["at", "seq"])).drop("at", "seq")


def keyed_merge(spark: SparkSession, folder: str) -> DataFrame:
    return keyed.merge(_accounts(spark, folder), _account_changes(spark, folder), order=["at", "seq"])


def keyed_merge_strict(spark: SparkSession, folder: str) -> DataFrame:
    return keyed.merge(_accounts(spark, folder), _account_changes(spark, folder), order=["at", "seq"], strict=True)


def keyed_insert_only(spark: SparkSession, folder: str) -> DataFrame:
    return keyed.insert_only(_accounts(spark, folder), _account_versions(spark, folder), order=["at", "seq"])


def keyed_update_only(spark: SparkSession, folder: str) -> DataFrame:
    return keyed.update_only(_accounts(spark, folder), _account_versions(spark, folder), order=["at", "seq"])


def keyed_delete(spark: SparkSession, folder: str) -> DataFrame:
    return keyed.delete_keys(_accounts(spark, folder), _account_rows(spark, folder))


def keyed_delete_report(spark: SparkSession, folder: str) -> DataFrame:
    return keyed.delete_report(_accounts(spark, folder), _account_changes(spark, folder))


def keyed_update_columns(spark: SparkSession, folder: str) -> DataFrame:
    return keyed.update_columns(_accounts(spark, folder), _account_versions(spark, folder), ["amount"], order=["at", "seq"])


def update_by_query(spark: SparkSession, folder: str) -> DataFrame:
    return keyed.update_where(_accounts(spark, folder), F.col("amount") < 0,
                              {"amount": F.lit(0.0), "name": F.concat(F.lit("owes: "), F.col("name"))})


def keyed_table(spark: SparkSession, folder: str) -> DataFrame:
    """Three batches into a stored table, the second one twice, with a compaction in between."""
    changes = _account_changes(spark, folder)
    year = F.year("at")
    batches = [changes.where(year < 1997), changes.where(year.between(1997, 1999)), changes.where(year > 1999)]
    table = keyed.KeyedTable(spark, fresh_path(spark, "accounts"), ACCOUNT)
    table.apply(batches[0], 0, order=["at", "seq"])
    table.apply(batches[1], 1, order=["at", "seq"])
    table.apply(batches[1], 1, order=["at", "seq"])
    table.compact()
    table.apply(batches[2], 2, order=["at", "seq"])
    return table.snapshot()


def keyed_load_and_feed(spark: SparkSession, folder: str) -> DataFrame:
    """A full load, a feed's batch, an upsert, more of the feed, a compaction, another feed that starts at batch 0."""
    changes, year = _account_changes(spark, folder), F.year("at")
    table = keyed.KeyedTable(spark, fresh_path(spark, "accounts"), ACCOUNT)
    table.replace(_accounts(spark, folder).unionByName(_accounts(spark, folder).where("id % 5 = 0")))  # some keys twice
    table.apply(changes.where(year < 1996), 7, order=["at", "seq"], feed="first")
    table.upsert(_accounts(spark, folder).where("id % 3 = 0").withColumn("name", F.lit("by hand")))
    table.apply(changes.where(year.between(1996, 1998)), 8, order=["at", "seq"], feed="first")
    table.compact()
    table.apply(changes.where(year > 1998), 0, order=["at", "seq"], feed="second")
    return table.snapshot()


def _bill_table(spark: SparkSession, folder: str) -> keyed.KeyedTable:
    """The bill job with all its columns: a full load into its table, stored by day, then one day's increment on top."""
    tables = DerivedTables(spark, folder)

    def process(bills: DataFrame) -> DataFrame:
        return wide.wide_table(wide.EXPRESS_BILL, tables, bills).withColumn("day", F.coalesce("day", F.lit("none")))

    path = fresh_path(spark, wide.EXPRESS_BILL.name)

    def target(result: DataFrame) -> keyed.KeyedTable:
        return keyed.KeyedTable(spark, path, result.schema, partition_by=["day"])

    bills = tables("tbl_express_bill")
    jobs.run_job(jobs.Job("bills", process, "full", unique=True), bills, target, "1998-06-16")
    again = bills.withColumn("remark", F.concat(F.coalesce("remark", F.lit("")), F.lit("-again")))
    return jobs.run_job(jobs.Job("bills", process, "incremental", unique=True), again, target, "1998-06-16")


def job_full_and_increment(spark: SparkSession, folder: str) -> DataFrame:
    return _bill_table(spark, folder).snapshot()


def kpi_of_a_day(spark: SparkSession, folder: str) -> DataFrame:
    """The bill KPIs of one day, which read only that day of the stored table."""
    table = _bill_table(spark, folder)
    table.compact()
    return summary.summarise(summary.EXPRESS_BILL, table.snapshot().where(F.col("day") == "19980615"))


def changelog_final(spark: SparkSession, folder: str) -> DataFrame:
    changes = _account_changes(spark, folder).drop("at")
    log = changelog.to_changelog(changes.withColumnRenamed("seq", "at"), "at").drop("at")
    return changelog.final_rows(log, ["id"])


def changelog_stored(spark: SparkSession, folder: str) -> DataFrame:
    """The log in a catalog table that is made from its schema, in buckets by key, and filled in two batches; its final state."""
    log = changelog.to_changelog(_account_changes(spark, folder).drop("at"), "seq")
    name = f"quay_{uuid.uuid4().hex}_log"
    for part in ("seq < 3000", "seq >= 3000"):
        table = keyed.create_table(spark, name, log.schema, ["id"], path=fresh_path(spark, "log"))  # the second time it is there
        log.where(part).select(table.columns).write.insertInto(name)
    return changelog.final_rows(spark.table(name).drop("seq"), ["id"])


def changelog_collapsed(spark: SparkSession, folder: str) -> DataFrame:
    """The same changes as a log with cancel rows, made in two steps, and collapsed."""
    changes = _account_changes(spark, folder).drop("at")
    first = changelog.to_changelog(changes.where("seq < 3000"), "seq", key=["id"])
    later = changelog.to_changelog(changes.where("seq >= 3000"), "seq", key=["id"], before=first)
    return changelog.collapsed_rows(first.unionByName(later))


# --- words, search, audit -----------------------------------------------------------------------------------------


def word_count(spark: SparkSession, folder: str) -> DataFrame:
    return feeds.word_counts(_read(spark, folder, "documents"), "text")


def stream_word_count(spark: SparkSession, folder: str) -> DataFrame:
    counts = feeds.word_counts(table_stream(spark, f"{folder}/documents.parquet").select("text"), "text")
    table = keyed.KeyedTable(spark, fresh_path(spark, "word_count"), counts.schema, key="word")
    feeds.start_keyed_sink(counts, table, "words", fresh_path(spark, "checkpoint"),
                           available_now=True).awaitTermination()
    return table.snapshot()


def stream_word_count_windows(spark: SparkSession, folder: str) -> DataFrame:
    """Words of event properties per day, by a stream that forgets days that are over: a tenth of the events comes after all
    others, and of these only those count whose day is not over."""
    events, inbox, files = _read(spark, folder, "events"), fresh_path(spark, "inbox"), 4
    late, half = F.col("event_id") % 10 == 0, F.col("ts") < F.lit("2024-01-16")
    for part in (~late & half, ~late & ~half & (F.col("event_id") % 10 != 1), ~late & ~half & (F.col("event_id") % 10 == 1), late):
        events.where(part).select(F.col("ts").cast("timestamp").alias("ts"), "event_type", "props").repartition(files).write.mode(
            "append").option("spark.sql.parquet.outputTimestampType", "TIMESTAMP_MICROS").parquet(inbox)
    rows = table_stream(spark, inbox, files).select("ts", F.concat("event_type", F.lit(" "), "props").alias("text"))
    counts = feeds.word_counts(rows, "text", event_time="ts", late="1 hour")
    rows = counts.withColumn("key", F.concat_ws(" ", F.unix_seconds(F.col("window_start").cast("timestamp")), "word"))
    table = keyed.KeyedTable(spark, fresh_path(spark, "windows"), rows.schema, key="key")
    feeds.start_keyed_sink(rows, table, "windows", fresh_path(spark, "checkpoint"), available_now=True).awaitTermination()
    return table.snapshot().drop("key")


def stream_to_memory(spark: SparkSession, folder: str) -> DataFrame:
    """What a stream prints: the rows of every batch, kept as a view by the console's function."""
    name = f"quay_{uuid.uuid4().hex}"
    rows = table_stream(spark, f"{folder}/events.parquet").select("event_id", "event_type", "value")
    feeds.start_console(rows, name, kind="memory", checkpoint=fresh_path(spark, "checkpoint"), available_now=True).awaitTermination()
    return spark.table(name)


def rows_to_frame(spark: SparkSession, folder: str) -> DataFrame:
    """A handful of rows in memory, a hundred at most, next to a table: regions by name, with the nations of each."""
    regions = _read(spark, folder, "region").orderBy("r_regionkey").take(100)
    wanted = spark.createDataFrame([(r["r_name"], r["r_regionkey"]) for r in regions], "name string, key int")
    return (_read(spark, folder, "nation").join(wanted, F.col("n_regionkey") == F.col("key"))
            .groupBy("name").agg(F.count(F.lit(1)).alias("nations")))


def sorted_wide(spark: SparkSession, folder: str) -> DataFrame:
    """The whole wide table in the order of its time. Every row with the number of rows of its time, the place of that time's
    first and last row among those of all times, by the numbers that the rows have where they lie, and its own number in the
    day: in that order, then by id."""
    rows = stored_rows(wide.wide_table(wide.EXPRESS_BILL, DerivedTables(spark, folder), ordered=True)
                       .withColumn("_at", F.monotonically_increasing_id()), "sorted")
    times = rows.groupBy(F.col("cdt").alias("_cdt")).agg(
        F.count(F.lit(1)).alias("rows"), F.min("_at").alias("_first"), F.max("_at").alias("_last"))
    place = lambda c: F.row_number().over(Window.orderBy(c))  # noqa: E731  # a row per time, some thousands
    times = times.select("_cdt", "rows", place("_first").alias("first_place"), place("_last").alias("last_place"))
    number = F.row_number().over(Window.partitionBy(F.substring("cdt", 1, 10)).orderBy("first_place", "id"))
    return (rows.join(F.broadcast(times), F.col("cdt").eqNullSafe(F.col("_cdt"))).drop("_cdt", "_at")
            .withColumn("n", number))


def day_texts(spark: SparkSession, folder: str) -> DataFrame:
    """Which orders are of the day, and the day before, a date; both as the texts that the jobs use."""
    today, yesterday = fc.day_key("1998-06-16"), fc.day_key("1998-06-15")
    day = fc.day_of_time("o_orderdate")
    return (_read(spark, folder, "orders").select(F.when(day == today, fc.day_text("1998-06-16")).when(
        day == yesterday, fc.day_text("1998-06-15")).otherwise("other").alias("day"))
        .groupBy("day").agg(F.count(F.lit(1)).alias("orders")))


def value_rendering(spark: SparkSession, folder: str) -> DataFrame:
    """Values as the text that a store is sent."""
    names = ("o_orderdate", "o_orderpriority", "o_custkey", "o_orderstatus")
    return _read(spark, folder, "orders").select("o_orderkey", *[fc.render_text(c).alias(c) for c in names])


def csv_ingest_header(spark: SparkSession, folder: str) -> DataFrame:
    """Customers written as files that each start with the same header, and read by it."""
    path, names = fresh_path(spark, "customers.csv"), ["c_mktsegment", "c_custkey", "c_nationkey"]
    _read(spark, folder, "customer").select(*names).write.option("header", True).csv(path)
    schema = T.StructType().add("c_custkey", "long").add("c_mktsegment", "string").add("c_nationkey", "integer")
    return delimited.ingest(spark, path, schema)[0]


def search_hits(spark: SparkSession, folder: str) -> DataFrame:
    return search.hits(_read(spark, folder, "documents").select("doc_id", "lang", "text"), "text", TERMS)


def search_facets(spark: SparkSession, folder: str) -> DataFrame:
    return search.facets(_read(spark, folder, "documents"), "text", TERMS, ["lang", "source"])


def search_count(spark: SparkSession, folder: str) -> DataFrame:
    return search.count_matches(_read(spark, folder, "documents"), "text", TERMS)


def _all_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {n: _read(spark, folder, n) for n in GENERIC}


def row_audit(spark: SparkSession, folder: str) -> DataFrame:
    return audit.table_counts(_all_tables(spark, folder))


def row_audit_total(spark: SparkSession, folder: str) -> DataFrame:
    return audit.total_count(_all_tables(spark, folder))


def row_audit_distinct(spark: SparkSession, folder: str) -> DataFrame:
    return audit.distinct_total_count(_all_tables(spark, folder))


def row_audit_expected(spark: SparkSession, folder: str) -> DataFrame:
    """Keyed tables against the streams they come from: lines are more than their keys."""
    tables = DerivedTables(spark, folder)
    expected = audit.table_counts({"tbl_pkg": _read(spark, folder, "lineitem"),
                                   "tbl_waybill": _read(spark, folder, "orders"),
                                   "tbl_missing": _read(spark, folder, "nation")})
    return audit.audit({n: tables(n) for n in ("tbl_pkg", "tbl_waybill", "tbl_customer")}, expected)


# --- calendar -----------------------------------------------------------------------------------------------------


def calendar_dim(spark: SparkSession, folder: str) -> DataFrame:
    """The calendar over the range of the order dates, with the orders of each date."""
    orders = _read(spark, folder, "orders").select(F.col("o_orderdate").cast("date").alias("ordered"))
    bounds = orders.agg(F.min("ordered").alias("first"), F.max("ordered").alias("last"))
    per_day = orders.groupBy("ordered").agg(F.count(F.lit(1)).alias("orders"))
    days = cal.calendar(cal.date_range(bounds, "first", "last"))
    return days.join(per_day, F.col("date") == F.col("ordered"), "left").drop("ordered")


def date_slices(spark: SparkSession, folder: str) -> DataFrame:
    orders = _read(spark, folder, "orders")
    bounds = orders.agg(F.min("o_orderdate").alias("first"), F.max("o_orderdate").alias("last"))
    return cal.slices_between(bounds, "first", "last", 7)


def date_arithmetic(spark: SparkSession, folder: str) -> DataFrame:
    shipped = F.col("l_shipdate")
    due = F.timestamp_add("HOUR", F.lit(31) * F.col("l_linenumber"), shipped)
    rows = _read(spark, folder, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", shipped.alias("shipped"),
        F.when(F.col("l_returnflag") != "R", due).alias("due"))
    return rows.select(
        "l_orderkey", "l_partkey", "l_linenumber",
        fc.days_between("due", "shipped").alias("days"), fc.millis_between("due", "shipped").alias("millis"),
        fc.latest("due", "shipped").alias("later"), fc.earliest("due", "shipped").alias("earlier"),
        fc.shift_days("shipped", -45).alias("ordered"), fc.shift_minutes("shipped", 90).alias("loaded"),
        fc.in_range(F.lit("1998-06-01").cast("timestamp"), "shipped", "due").alias("open_in_june"),
        fc.same_week("shipped", "due").alias("same_week"))


def time_normalise(spark: SparkSession, folder: str) -> DataFrame:
    """Event times written in the layout of their event type, and read back."""
    ts, kind = F.col("ts"), F.col("event_type")
    text = (F.when(kind == "click", F.date_format(ts, "yyyy-MM-dd HH:mm:ss"))
            .when(kind == "view", F.date_format(ts, "yyyyMMddHHmmss"))
            .when(kind == "purchase", F.date_format(ts, "yyyy-MM-dd"))
            .when(kind == "signup", F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSS"))
            .when(F.col("value") > 50, F.date_format(ts, "yyyyMMddHHmmssSSS"))
            .when(F.col("value") > 20, F.concat(F.date_format(ts, "EEE MMM dd HH:mm:ss"), F.lit(" UTC 2024")))
            .otherwise(F.concat(F.lit("at "), F.date_format(ts, "HH:mm"))))
    return _read(spark, folder, "events").select(
        "event_id", fc.parse_time(text).alias("moment"), fc.from_epoch(F.unix_seconds(ts.cast("timestamp"))).alias("second"),
        fc.day_of_time(text).alias("day"))


QUERIES: dict[str, Query] = {
    "wide_express_bill": _wide(wide.EXPRESS_BILL),
    "wide_waybill": _wide(wide.WAYBILL),
    "wide_transport_record": _wide(wide.TRANSPORT_RECORD),
    "wide_branch_vehicle": _wide(wide.BRANCH_VEHICLE),
    "kpi_express_bill": _kpi(summary.EXPRESS_BILL),
    "kpi_waybill": _kpi(summary.WAYBILL),
    "kpi_transport_record": _kpi(summary.TRANSPORT_RECORD),
    "kpi_branch_vehicle": _kpi(summary.BRANCH_VEHICLE),
} | {f.__name__: f for f in (
    wide_customer, kpi_customer, sender_totals, dictionary_decode, kpi_order_daily, distinct_days, group_count,
    incremental_scan, incremental_scan_text, query_by_example, query_by_example_limit, csv_ingest, csv_ingest_header,
    cdc_oracle_apply, cdc_oracle_deletes, cdc_mysql_apply, cdc_mysql_first_row, cdc_route_counts, json_path_filter,
    stream_cdc, two_feeds, cdc_rejects, cdc_order, cdc_pass_through, cdc_unknown_operations, stream_documents, feed_to_kpi, keyed_merge, keyed_merge_strict, keyed_insert_only, keyed_update_only,
    keyed_delete,
    keyed_delete_report, keyed_update_columns, update_by_query, keyed_table, keyed_load_and_feed, job_full_and_increment,
    kpi_of_a_day, changelog_final,
    changelog_stored, changelog_collapsed, word_count, stream_word_count, stream_word_count_windows, stream_to_memory, rows_to_frame,
    sorted_wide, day_texts, value_rendering, search_hits, search_facets, search_count, row_audit,
    row_audit_total, row_audit_distinct, row_audit_expected, calendar_dim, date_slices, date_arithmetic,
    time_normalise)} | search_queries.QUERIES | change_queries.QUERIES | store_queries.QUERIES
