"""Streams into keyed tables.

One query reads the messages once and serves all tables: a batch is parsed once, kept in a folder per table, and its rows
are written per table, several tables at a time. Every write goes to the batch's own folder, so a batch that is repeated
after a failure leaves the same state.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from quayline.operators.cdc import check_tables, has_text, parse, typed_rows, where_json_path
from quayline.operators.keyed import BATCH, FEED, KeyedTable
from quayline.schemas import Table
from quayline.session import finished_folders, fresh_path, remove_folder, stream_id
from quayline.streaming.supervision import observed

TABLES_AT_A_TIME = 8
REJECTS = "rejects"
PARSED, TARGET = "parsed", "_target"  # the folder of batches in work, and the column that names its folders


def keyed_tables(spark: SparkSession, root: str, catalogue: Mapping[str, Table],
                 by_event: bool = False) -> dict[str, KeyedTable]:
    """The stored tables of a catalogue, each in its folder."""
    return {name: KeyedTable(spark, f"{root}/{name}", table.schema, table.key, by_event=by_event)
            for name, table in catalogue.items()}


def apply_batch(messages: DataFrame, batch: int, category: str, root: str, catalogue: Mapping[str, Table],
                null_numbers_as_zero: bool = False, compact_every: int = 0, tasks: int = 0, feed: str = "main",
                deletes: bool = True, by_event: bool = False) -> None:
    """Apply one batch of a feed's raw messages to the tables under ``root``; bad messages go to ``rejects``.

    With ``compact_every`` a table is compacted as soon as it has so many batches of its own to fold in. With ``tasks`` the
    messages are first spread over that many tasks, for sources that come in few pieces. Without ``deletes`` a deleted row
    stays, with its last content. With ``by_event`` an event that comes batches too late can't undo a newer one.
    """
    if tasks:
        messages = messages.repartition(tasks)
    apply_changes(check_tables(parse(messages, category), catalogue), batch, root, catalogue, null_numbers_as_zero,
                  compact_every, feed, deletes, by_event)


def apply_changes(changes: DataFrame, batch: int, root: str, catalogue: Mapping[str, Table],
                  null_numbers_as_zero: bool = False, compact_every: int = 0, feed: str = "main", deletes: bool = True,
                  by_event: bool = False) -> None:
    """``apply_batch`` for messages that are parsed and checked."""
    spark = changes.sparkSession
    # in files, not in a cache, whose blocks are built and serialized on the heap and grow with the batch
    path = f"{root}/{PARSED}/{FEED}={feed}/{BATCH}={batch}"
    try:
        # at most one folder per table of the catalogue, and one for the bad messages
        changes = changes.withColumn(TARGET, F.when(F.col("problem").isNull(), F.col("table")))
        changes.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(TARGET).parquet(path)
        changes = spark.read.schema(changes.schema).parquet(path)
        present = {r[TARGET] for r in changes.select(TARGET).distinct().collect()}
        stored = keyed_tables(spark, root, catalogue, by_event)

        def write(name: str) -> None:
            rows = typed_rows(changes.where(F.col(TARGET) == name), catalogue[name], null_numbers_as_zero)
            if not deletes:
                rows = rows.withColumn("op_type", F.lit("update"))
            stored[name].apply(rows, batch, feed=feed)
            if compact_every and stored[name].pending() >= compact_every:
                stored[name].compact()

        with ThreadPoolExecutor(TABLES_AT_A_TIME) as pool:
            list(pool.map(inheritable_thread_target(spark)(write), present - {None}))  # jobs stay part of the query
        if None in present:
            (changes.where(F.col(TARGET).isNull()).select("table", "problem", "value").write.mode("overwrite")
             .option("partitionOverwriteMode", "static").parquet(f"{root}/{REJECTS}/{FEED}={feed}/{BATCH}={batch}"))
    finally:
        remove_folder(spark, path)


def rejects(spark: SparkSession, root: str) -> DataFrame:
    """The messages of all feeds that could not be used."""
    schema = f"table string, problem string, value string, {FEED} string, {BATCH} long"
    if not finished_folders(spark, f"{root}/{REJECTS}/{FEED}=*/{BATCH}=*"):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{root}/{REJECTS}")


def start_change_feed(messages: DataFrame, category: str, root: str, checkpoint: str, catalogue: Mapping[str, Table],
                      available_now: bool = False, tasks: int = 0, name: str | None = None, **options) -> StreamingQuery:
    """Keep the tables under ``root`` up to date from a stream of raw messages; the checkpoint names the feed.

    Every batch counts its rows and rejects as it is read (``supervision.FeedMetrics``).
    """
    if tasks:
        messages = messages.repartition(tasks)
    changes = observed(check_tables(parse(messages, category), catalogue))

    def on_batch(batch: DataFrame, number: int) -> None:
        apply_changes(batch, number, root, catalogue, feed=stream_id(batch) or "main", **options)

    return _start(changes, on_batch, name or f"changes-{category}", checkpoint, available_now)


def start_document_feed(messages: DataFrame, tables: Mapping[str, Table], root: str, checkpoint: str,
                        schema_prefix: str = "", honour_deletes: bool = False,
                        available_now: bool = False, **options) -> StreamingQuery:
    """Keep searchable copies of some tables; messages of other tables are dropped before they are parsed.

    A deleted row stays searchable, with its last content, unless ``honour_deletes`` is set.
    """
    wanted = where_json_path(messages, "$.table", [schema_prefix + name for name in tables])
    return start_change_feed(wanted, "oracle", root, checkpoint, tables, available_now, deletes=honour_deletes, **options)


def start_keyed_sink(rows: DataFrame, table: KeyedTable, name: str, checkpoint: str,
                     available_now: bool = False, output_mode: str = "update") -> StreamingQuery:
    """Keep a keyed table equal to a streaming result, such as an aggregate, whose keys change once per batch."""
    def on_batch(batch: DataFrame, number: int) -> None:
        batch = batch if "op_type" in batch.columns else batch.withColumn("op_type", F.lit("update"))
        table.apply(batch, number, order=None, feed=stream_id(batch) or "main")

    return _start(rows, on_batch, name, checkpoint, available_now, output_mode)


def start_console(rows: DataFrame, name: str, lines: int = 20, kind: str = "console", checkpoint: str | None = None,
                  available_now: bool = False) -> StreamingQuery:
    """Print the rows of every batch; ``kind="memory"`` keeps them all as a temporary view of that name instead.

    What is kept lies in the shared folder, a folder per batch, which a repeated batch replaces: the driver holds no rows.
    """
    if kind == "memory":
        return _start_kept(rows, name, checkpoint, available_now)
    writer = (rows.writeStream.queryName(name).outputMode("append").format(kind)
              .option("numRows", lines).option("truncate", "false"))
    if checkpoint:
        writer = writer.option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def _start_kept(rows: DataFrame, name: str, checkpoint: str | None, available_now: bool) -> StreamingQuery:
    spark, schema = rows.sparkSession, rows.schema
    checkpoint = checkpoint or fresh_path(spark, "checkpoint")
    path = f"{checkpoint}/kept"  # with the checkpoint, so that a query that goes on from it still has them

    def show() -> None:
        folders = finished_folders(spark, f"{path}/{BATCH}=*")
        kept = spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)
        kept.createOrReplaceTempView(name)

    def on_batch(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{path}/{BATCH}={number}")
        show()

    show()
    return _start(rows, on_batch, name, checkpoint, available_now)


def _start(rows: DataFrame, on_batch: Callable[[DataFrame, int], None], name: str, checkpoint: str,
           available_now: bool, output_mode: str = "append") -> StreamingQuery:
    writer = (rows.writeStream.queryName(name).outputMode(output_mode)
              .option("checkpointLocation", checkpoint).foreachBatch(on_batch))
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def word_counts(lines: DataFrame, column: str = "value", event_time: str | None = None, late: str = "1 hour",
                window: str = "1 day") -> DataFrame:
    """How often each word occurs; words are what white space separates. Works on tables and streams.

    With ``event_time`` words are counted per ``window``, and a stream forgets a window that is ``late`` behind the newest
    event, so that its state does not grow without end.
    """
    words = F.explode(F.split(F.trim(column), r"[ \t\n\u000B\f\r]+")).alias("word")
    lines = lines.where(has_text(column))
    if event_time is None:
        return lines.select(words).groupBy("word").count()
    if lines.isStreaming:
        lines = lines.withWatermark(event_time, late)
    return (lines.select(event_time, words).groupBy(F.window(event_time, window).alias("window"), "word").count()
            .select(F.col("window.start").alias("window_start"), "word", "count"))
