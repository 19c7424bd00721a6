import os
import re

import pytest
from pyspark.sql import functions as F

from quayline.operators import cdc
from quayline.operators.keyed import KeyedTable
from quayline.schemas import load_catalogue
from quayline.session import fresh_path
from quayline.sources import streams
from quayline.streaming import feeds
from test_cdc import job, mysql, oracle

CATALOGUE = {n: t for n, t in load_catalogue().items() if n in ("tbl_job", "tbl_customer", "tbl_department")}


def put(folder, name, lines):
    """One more file of the stream, later than the ones before."""
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, name)
    with open(path, "w", encoding="utf-8") as out:
        out.write("\n".join(lines) + "\n")
    stamp = 1_600_000_000 + int(name)
    os.utime(path, (stamp, stamp))


def test_change_feed_over_several_batches(spark, rows, tmp_path):
    inbox, root, state = str(tmp_path / "in"), fresh_path(spark, "tables"), fresh_path(spark, "state")
    put(inbox, "1", [oracle(after=job(1, "a")), oracle(after=job(2, "b")), "{broken",
                     oracle("SRC.tbl_department", after={"id": 7, "dep_name": "x"}),
                     oracle("SRC.tbl_nowhere", after=job(1))])
    put(inbox, "2", [oracle(op="U", after=job(1, "a2"), pos="2"), oracle(op="D", before=job(2), pos="3")])
    put(inbox, "3", ["", oracle(op="U", after=job(1, "a3"), pos="4"), oracle(op="I", after=job(3, "c"), pos="5")])

    def run():
        feeds.start_change_feed(streams.file_stream(spark, inbox, max_files=1), "oracle", root, state, CATALOGUE,
                                available_now=True, compact_every=2).awaitTermination()
        return rows(feeds.keyed_tables(spark, root, CATALOGUE)["tbl_job"].snapshot().select("id", "jobName"))

    assert run() == [(1, "a3"), (3, "c")]
    put(inbox, "4", [oracle(op="D", before=job(1), pos="6")])
    assert run() == [(3, "c")]
    assert feeds.keyed_tables(spark, root, CATALOGUE)["tbl_department"].snapshot().count() == 1
    rejects = spark.read.parquet(f"{root}/rejects")
    assert rows(rejects.select("table", "problem")) == sorted(
        [(None, "unreadable"), ("tbl_nowhere", "unknown table")], key=repr)


def test_a_repeated_batch_changes_nothing(spark, rows):
    root = fresh_path(spark, "tables")
    first = spark.createDataFrame([(oracle(after=job(1, "a")),), (oracle(after=job(2, "b")),)], "value string")
    second = spark.createDataFrame([(oracle(op="D", before=job(1), pos="2"),), ("bad",)], "value string")
    for number, batch in ((0, first), (0, first), (1, second), (1, second)):
        feeds.apply_batch(batch, number, "oracle", root, CATALOGUE)
    assert rows(feeds.keyed_tables(spark, root, CATALOGUE)["tbl_job"].snapshot().select("id", "jobName")) == [(2, "b")]
    assert spark.read.parquet(f"{root}/rejects").count() == 1


def test_a_batch_is_kept_in_files_per_table_and_not_in_memory(spark, rows, monkeypatch):
    root, seen = fresh_path(spark, "tables"), []
    apply = KeyedTable.apply

    def watched(self, changes, *args, **options):
        plan = changes._jdf.queryExecution().executedPlan().toString()
        folders = set(re.findall(r"PartitionFilters: [^]]*_target#\d+ = (\w+)", plan))
        seen.append((folders, spark._jsparkSession.sharedState().cacheManager().isEmpty()))
        apply(self, changes, *args, **options)
        if fail:
            raise OSError("no disk")

    monkeypatch.setattr(KeyedTable, "apply", watched)
    lines = [oracle(after=job(1, "a")), oracle(after=job(2, "b")), oracle("SRC.tbl_department", after={"id": 7, "dep_name": "x"}),
             oracle("SRC.tbl_no/where=%", after=job(1)), oracle(after={"job_name": "no id"}), "{broken"]
    batch = spark.createDataFrame([(x,) for x in lines], "value string").repartition(3)
    spark.catalog.clearCache()
    for fail in (True, False):
        seen.clear()
        try:
            feeds.apply_batch(batch, 0, "oracle", root, CATALOGUE)
        except OSError:
            assert fail
        assert sorted(seen, key=repr) == [({"tbl_department"}, True), ({"tbl_job"}, True)]
        assert not os.path.exists(f"{root}/parsed/_feed=main/_batch=0")
    tables = feeds.keyed_tables(spark, root, CATALOGUE)
    assert rows(tables["tbl_job"].snapshot().select("id", "jobName")) == [(1, "a"), (2, "b")]
    assert tables["tbl_department"].snapshot().count() == 1
    assert rows(feeds.rejects(spark, root).select("table", "problem", "value")) == sorted(
        [("tbl_no/where=%", "unknown table", lines[3]), ("tbl_job", "no key", lines[4]), (None, "unreadable", lines[5])], key=repr)


def test_two_feeds_keep_their_rejects_and_a_new_checkpoint_is_applied(spark, rows, tmp_path):
    root = fresh_path(spark, "tables")
    for category, name, lines in (("oracle", "a", [oracle(after=job(1, "a")), "bad"]), ("mysql", "b", ["worse"]),
                                  ("oracle", "c", [oracle(op="U", after=job(1, "c"), pos="0"), oracle(after=job(2, "c"))])):
        put(str(tmp_path / name), "1", lines)
        feeds.start_change_feed(streams.file_stream(spark, str(tmp_path / name)), category, root, fresh_path(spark, "state"),
                                CATALOGUE, available_now=True, compact_every=1).awaitTermination()
    assert rows(feeds.rejects(spark, root).select("value")) == [("bad",), ("worse",)]
    assert rows(feeds.keyed_tables(spark, root, CATALOGUE)["tbl_job"].snapshot().select("id", "jobName")) == [(1, "c"), (2, "c")]
    assert feeds.rejects(spark, fresh_path(spark, "empty")).count() == 0


def test_a_table_touched_now_and_then_is_compacted(spark):
    root = fresh_path(spark, "tables")
    for number in range(6):
        lines = [oracle(after=job(number))] if number % 2 == 0 else [oracle("SRC.tbl_department", after={"id": 1})]
        feeds.apply_batch(spark.createDataFrame([(x,) for x in lines], "value string"), number, "oracle", root, CATALOGUE,
                          compact_every=2)
    table = feeds.keyed_tables(spark, root, CATALOGUE)["tbl_job"]
    assert table.pending() == 1 and table._generations()[-1] > 0 and table.snapshot().count() == 3


def test_word_windows_equal_batch(spark, rows, tmp_path):
    lines = spark.createDataFrame([("a b", "2020-01-01 10:00:00"), ("a", "2020-01-01 23:00:00"), ("a", "2020-01-02 00:00:00")],
                                  "value string, at string").selectExpr("value", "to_timestamp(at) AS at")
    lines.write.parquet(str(tmp_path / "in"))
    counts = feeds.word_counts(streams.table_stream(spark, str(tmp_path / "in") + "/"), event_time="at")
    query = counts.writeStream.format("memory").queryName("quay_windows").outputMode("update").option(
        "checkpointLocation", fresh_path(spark, "state")).trigger(availableNow=True).start()
    query.awaitTermination()
    found = rows(spark.table("quay_windows").selectExpr("date_format(window_start, 'd') AS d", "word", "count"))
    assert found == [("1", "a", 2), ("1", "b", 1), ("2", "a", 1)]


def test_mysql_feed(spark, rows, tmp_path):
    inbox, root = str(tmp_path / "in"), fresh_path(spark, "tables")
    put(inbox, "1", [mysql(data=[{"id": "1", "name": "a", "reg_dt": "2020-01-01 00:00:00"}, {"id": "2", "name": "b"}]),
                     mysql(data=[{"id": "1", "name": "c"}], kind="UPDATE", ts=2)])
    feeds.start_change_feed(streams.file_stream(spark, inbox), "mysql", root, fresh_path(spark, "state"), CATALOGUE,
                            available_now=True).awaitTermination()
    found = feeds.keyed_tables(spark, root, CATALOGUE)["tbl_customer"].snapshot()
    assert rows(found.select("id", "name", "regDt")) == [(1, "c", None), (2, "b", None)]


@pytest.mark.parametrize("honour, expected", [(False, [(1, "n"), (2, "b")]), (True, [(2, "b")])])
def test_document_feed(spark, rows, tmp_path, honour, expected):
    inbox, root = str(tmp_path / "in"), fresh_path(spark, "documents")
    put(inbox, "1", [oracle(after=job(1)), oracle(after=job(2, "b")), oracle("SRC.tbl_department", after={"id": 1})])
    put(inbox, "2", [oracle(op="D", before=job(1), pos="2"), "{broken"])
    table = {"tbl_job": CATALOGUE["tbl_job"]}
    feeds.start_document_feed(streams.file_stream(spark, inbox, max_files=1), table, root, fresh_path(spark, "state"),
                              schema_prefix="SRC.", honour_deletes=honour, available_now=True).awaitTermination()
    assert rows(feeds.keyed_tables(spark, root, table)["tbl_job"].snapshot().select("id", "jobName")) == expected


def test_word_count_stream_equals_batch(spark, rows, tmp_path):
    inbox = str(tmp_path / "in")
    put(inbox, "1", ["a  b", "", "   ", "b\tc"])
    put(inbox, "2", ["a a", " c"])
    counts = feeds.word_counts(streams.file_stream(spark, inbox, max_files=1))
    table = KeyedTable(spark, fresh_path(spark, "words"), counts.schema, key="word")
    feeds.start_keyed_sink(counts, table, "words", fresh_path(spark, "state"), available_now=True).awaitTermination()
    expected = [("a", 3), ("b", 2), ("c", 2)]
    assert rows(table.snapshot()) == expected
    assert rows(feeds.word_counts(spark.read.text(inbox))) == expected


def test_stream_of_changes_in_memory(spark, rows, tmp_path):
    inbox = str(tmp_path / "in")
    put(inbox, "1", [oracle(after=job(1)), oracle("SRC.tbl_department", after={"id": 1})])
    changes = cdc.parse(streams.file_stream(spark, inbox), "oracle")
    query = (cdc.typed_rows(changes, CATALOGUE["tbl_job"]).writeStream.format("memory").queryName("quay_jobs")
             .option("checkpointLocation", fresh_path(spark, "state")).trigger(availableNow=True).start())
    query.awaitTermination()
    assert rows(spark.table("quay_jobs").select("id", "jobName")) == [(1, "n")]


def test_console(spark, tmp_path, capfd):
    inbox = str(tmp_path / "in")
    put(inbox, "1", ["seen"])
    query = feeds.start_console(streams.file_stream(spark, inbox), "quay_console")
    try:
        assert query.name in [q.name for q in spark.streams.active]
        query.processAllAvailable()
    finally:
        query.stop()


def test_socket_stream_is_planned_without_connecting(spark):
    frame = streams.socket_stream(spark, "localhost", 9)
    assert frame.isStreaming and frame.columns == ["value"]


def test_a_failing_batch_fails_the_query(spark, tmp_path):
    inbox = str(tmp_path / "in")
    put(inbox, "1", ["x"])
    rows = streams.file_stream(spark, inbox).select(F.lit(1).alias("id"), F.lit("truncate").alias("op_type"))
    table = KeyedTable(spark, fresh_path(spark, "t"), rows.drop("op_type").schema)
    query = feeds.start_keyed_sink(rows, table, "failing", fresh_path(spark, "state"), available_now=True,
                                   output_mode="append")
    with pytest.raises(Exception, match="unknown operation"):
        query.awaitTermination()


def test_what_a_stream_prints_is_kept_outside_the_driver(spark, rows, tmp_path):
    inbox, state, name = str(tmp_path / "in"), fresh_path(spark, "state"), "quay_kept"

    def run():
        feeds.start_console(streams.file_stream(spark, inbox, max_files=1), name, kind="memory", checkpoint=state,
                            available_now=True).awaitTermination()

    put(inbox, "1", ["a", "b"])
    put(inbox, "2", ["a"])
    run()
    assert rows(spark.table(name)) == [("a",), ("a",), ("b",)]
    assert spark.table(name).inputFiles()  # files, not rows that the driver holds
    put(inbox, "3", ["c"])
    run()
    assert rows(spark.table(name)) == [("a",), ("a",), ("b",), ("c",)]
