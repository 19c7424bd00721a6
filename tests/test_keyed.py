import re

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import Window, functions as F

from quayline.operators import changelog, keyed
from quayline.plans.jobs import Job, run_job
from quayline.schemas import load_catalogue
from quayline.session import fresh_path

SCHEMA = "id long, name string, n int"
CHANGES = "id long, name string, n int, op_type string, seq int"


@pytest.fixture
def target(spark):
    return spark.createDataFrame([(1, "a", 1), (2, "b", 2), (3, "c", None)], SCHEMA)


def changes(spark, *rows):
    return spark.createDataFrame(rows, CHANGES)


def test_merge(spark, rows, target):
    found = keyed.merge(target, changes(
        spark, (1, "A", 10, "update", 1), (1, "AA", 11, "update", 2), (2, "b", 2, "update", 1), (2, None, None, "delete", 2),
        (4, "d", 4, "insert", 1), (5, "e", 5, "insert", 1), (5, None, None, "delete", 2), (6, None, None, "delete", 1),
        (6, "f", 6, "insert", 2)), order=["seq"])
    assert rows(found) == [(1, "AA", 11), (3, "c", None), (4, "d", 4), (6, "f", 6)]


def test_strict_merge_updates_only_what_is_there(spark, rows, target):
    found = keyed.merge(target, changes(
        spark, (1, "A", 1, "update", 1), (7, "x", 7, "update", 1), (8, "y", 8, "insert", 1), (8, "z", 8, "update", 2),
        (2, None, None, "delete", 1), (2, "again", 2, "update", 2)), order=["seq"], strict=True)
    assert rows(found) == [(1, "A", 1), (3, "c", None), (8, "z", 8)]


def test_merge_of_an_unknown_operation_fails(spark, target):
    with pytest.raises(PySparkException, match="unknown operation"):
        keyed.merge(target, changes(spark, (1, "A", 1, "upsert", 1)), order=["seq"]).collect()


def test_single_purpose_merges(spark, rows, target):
    new = spark.createDataFrame([(3, "C", 3), (4, "D", 4)], SCHEMA)
    assert rows(keyed.insert_only(target, new)) == [(1, "a", 1), (2, "b", 2), (3, "c", None), (4, "D", 4)]
    assert rows(keyed.update_only(target, new)) == [(1, "a", 1), (2, "b", 2), (3, "C", 3)]
    assert rows(keyed.delete_keys(target, new)) == [(1, "a", 1), (2, "b", 2)]
    assert rows(keyed.delete_report(target, new)) == [(1, 1)]
    assert rows(keyed.update_columns(target, spark.createDataFrame([(1, "z", None)], SCHEMA), ["n"])) == \
        [(1, "a", None), (2, "b", 2), (3, "c", None)]


def test_small_changes_do_not_shuffle_a_large_table(spark):
    path = fresh_path(spark, "large")
    spark.range(200_000).selectExpr("id", "uuid() AS name", "1 AS n").write.parquet(path)
    small = fresh_path(spark, "small")
    changes(spark, (5, "x", 1, "update", 1)).write.parquet(small)
    few = spark.read.parquet(small)
    merged = keyed.merge(spark.read.parquet(path), few)
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
    assert merged.count() == 200_000


@pytest.mark.parametrize("partition_by", [[], ["name"]])
def test_table_life(spark, rows, partition_by):
    table = keyed.KeyedTable(spark, fresh_path(spark, "t"), spark.createDataFrame([], SCHEMA).schema,
                             partition_by=partition_by)
    assert rows(table.snapshot()) == []
    table.apply(changes(spark, (1, "a", 1, "insert", 1), (2, "b", 2, "insert", 1)), 0, order=["seq"])
    table.apply(changes(spark, (1, "z", 3, "update", 1), (2, None, None, "delete", 1)), 1, order=["seq"])
    state = [(1, "z", 3)]
    assert rows(table.snapshot()) == state
    again = changes(spark, (1, "z", 3, "update", 1), (2, None, None, "delete", 1))
    for _ in range(2):  # replay, before and after a compaction
        table.apply(again, 1, order=["seq"])
        assert rows(table.snapshot()) == state
        table.compact()
        assert rows(table.snapshot()) == state and table.pending() == 0
    with pytest.raises(ValueError, match="batch 0 of feed main"):  # another checkpoint would begin again
        table.apply(changes(spark, (2, "b", 2, "insert", 1)), 0, order=["seq"])
    table.apply(changes(spark, (2, "back", 5, "insert", 1)), 2, order=["seq"])
    table.upsert(spark.createDataFrame([(3, "c", 3)], SCHEMA))
    assert rows(table.snapshot()) == [(1, "z", 3), (2, "back", 5), (3, "c", 3)]
    table.replace(spark.createDataFrame([(9, "i", 9)], SCHEMA))
    assert rows(table.snapshot()) == [(9, "i", 9)]


def test_feeds_jobs_and_compaction_lose_nothing(spark, rows):
    table = keyed.KeyedTable(spark, fresh_path(spark, "t"), spark.createDataFrame([], SCHEMA).schema)
    for batch in range(3):
        table.apply(changes(spark, (batch, "stream", batch, "insert", 1)), batch, order=["seq"], feed="a")
    table.upsert(spark.createDataFrame([(1, "job", 1), (7, "job", 7)], SCHEMA))
    table.apply(changes(spark, (2, "later", 2, "update", 1)), 3, order=["seq"], feed="a")
    state = [(0, "stream", 0), (1, "job", 1), (2, "later", 2), (7, "job", 7)]
    assert rows(table.snapshot()) == state
    table.compact()
    table.apply(changes(spark, (8, "b", 8, "insert", 1)), 0, order=["seq"], feed="b")  # a new checkpoint
    assert rows(table.snapshot()) == [*state, (8, "b", 8)]
    table.replace(spark.createDataFrame([(9, "all", 9)], SCHEMA))
    assert rows(table.snapshot()) == [(9, "all", 9)]
    table.apply(changes(spark, (1, "after", 1, "insert", 1)), 4, order=["seq"], feed="a")
    assert rows(table.snapshot()) == [(1, "after", 1), (9, "all", 9)]
    with pytest.raises(ValueError, match="not a name"):
        table.apply(changes(spark, (1, "x", 1, "insert", 1)), 0, feed="a/b")


def _move(spark, old, new):
    hadoop = spark._jvm.org.apache.hadoop.fs
    hadoop.Path(old).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).rename(
        hadoop.Path(old), hadoop.Path(new))


def test_an_unfinished_batch_is_not_read(spark, rows):
    table = keyed.KeyedTable(spark, fresh_path(spark, "t"), spark.createDataFrame([], SCHEMA).schema)
    table.apply(changes(spark, (1, "a", 1, "insert", 1)), 0, order=["seq"])
    table.apply(changes(spark, (1, "half", 1, "update", 1)), 1, order=["seq"])
    folder = f"{table.path}/changes/_base=0/_feed=main/_batch=1/_arrival=2"
    _move(spark, f"{folder}/_SUCCESS", f"{folder}/_started")
    assert rows(table.snapshot()) == [(1, "a", 1)]
    table.apply(changes(spark, (1, "whole", 1, "update", 1)), 1, order=["seq"])
    assert rows(table.snapshot()) == [(1, "whole", 1)]


def test_missing_markers_raise(spark):
    table = keyed.KeyedTable(spark, fresh_path(spark, "t"), spark.createDataFrame([], SCHEMA).schema)
    spark.conf.set("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    try:
        with pytest.raises(RuntimeError, match="marksuccessfuljobs"):
            table.apply(changes(spark, (1, "a", 1, "insert", 1)), 0, order=["seq"])
        with pytest.raises(RuntimeError, match="marksuccessfuljobs"):
            table.snapshot()
    finally:
        spark.conf.unset("mapreduce.fileoutputcommitter.marksuccessfuljobs")


def test_keys_stay_unique(spark, rows, target):
    new = spark.createDataFrame([(3, "C", 3), (3, "D", 4), (4, "E", 5), (4, "E", 5)], SCHEMA)
    assert rows(keyed.insert_only(target, new, order=["n"])) == [(1, "a", 1), (2, "b", 2), (3, "c", None), (4, "E", 5)]
    assert rows(keyed.update_only(target, new)) == [(1, "a", 1), (2, "b", 2), (3, "D", 4)]
    assert rows(keyed.update_columns(target, new, ["n"])) == [(1, "a", 1), (2, "b", 2), (3, "c", 4)]


def test_catalog_ddl(spark):
    ddl = keyed.create_table_ddl("quay_job", load_catalogue()["tbl_job"].schema)
    assert ddl == ("CREATE TABLE IF NOT EXISTS quay_job (`id` bigint NOT NULL, `jobName` string, `jobLevel` bigint, "
                   "`cdt` string, `udt` string, `remark` string) USING parquet CLUSTERED BY (`id`) INTO 3 BUCKETS")


def test_catalog_table_is_made_once(spark):
    for _ in range(2):
        assert keyed.create_table(spark, "quay_job", load_catalogue()["tbl_job"].schema).count() == 0
    facts = {r["col_name"]: r["data_type"] for r in spark.sql("DESCRIBE EXTENDED quay_job").collect()}
    assert facts["Num Buckets"] == "3" and facts["Bucket Columns"] == "[`id`]" and facts["jobLevel"] == "bigint"
    spark.sql("DROP TABLE quay_job")


def test_catalog_merge_needs_a_catalog_that_merges(spark, target):
    target.createOrReplaceTempView("quay_target")
    with pytest.raises(PySparkException, match="MERGE INTO"):
        keyed.merge_into(changes(spark, (1, "A", 1, "update", 1)).drop("seq"), "quay_target")


def test_changelog(spark, rows):
    log = changelog.to_changelog(changes(
        spark, (1, "a", 1, "insert", 1), (1, "b", 1, "update", 2), (2, "c", 2, "insert", 1), (2, "c", 2, "delete", 1),
        (3, "d", 3, "delete", 1), (3, "d", 3, "insert", 2)), "seq").drop("seq")
    assert log.schema["sign"].dataType.simpleString() == "tinyint"
    assert log.schema["version"].dataType.simpleString() == "bigint"
    assert rows(changelog.final_rows(log, ["id"])) == [(1, "b", 1), (3, "d", 3)]


def test_collapsed_log_equals_the_final_rows(spark, rows):
    all_changes = [(1, "a", 1, "insert", 1), (1, "b", 1, "update", 2), (2, "c", 2, "insert", 3), (2, None, None, "delete", 4),
                   (3, None, None, "delete", 5), (3, "d", 3, "insert", 6), (1, "b", 1, "update", 7), (4, None, None, "delete", 8)]
    expected = [(1, "b", 1), (3, "d", 3)]
    for cut in range(len(all_changes) + 1):
        first, later = (spark.createDataFrame(c, CHANGES) for c in (all_changes[:cut], all_changes[cut:]))
        log = changelog.to_changelog(first, "seq", key=["id"])
        log = log.unionByName(changelog.to_changelog(later, "seq", key=["id"], before=log))
        assert rows(changelog.collapsed_rows(log)) == expected
        assert {r["sign"] for r in log.collect()} == {1, -1}


def test_changelog_types(spark):
    frame = spark.createDataFrame([], "word string, total int, price decimal(10,2), at timestamp, opType string")
    assert changelog.store_columns(frame.schema) == {
        "word": "String", "total": "Int32", "price": "Decimal(10, 2)", "at": "DateTime", "sign": "Int8", "version": "Int64"}


def test_job_modes(spark, rows):
    source = spark.createDataFrame([(1, "a", "2020-01-01 10:00:00"), (2, "b", "2020-01-02 00:00:00"),
                                    (3, "c", "2020-01-03 00:00:00")], "id long, name string, cdt string")
    path = fresh_path(spark, "job")

    def target(result):
        return keyed.KeyedTable(spark, path, result.schema)

    def upper(df):
        return df.selectExpr("id", "upper(name) AS name")

    assert rows(run_job(Job("j", upper), source, target, "2020-01-03").snapshot()) == [(1, "A"), (2, "B"), (3, "C")]
    changed = source.selectExpr("id", "concat(name, '2') AS name", "cdt")
    assert rows(run_job(Job("j", upper, "incremental"), changed, target, "2020-01-03").snapshot()) == \
        [(1, "A"), (2, "B2"), (3, "C")]
    with pytest.raises(ValueError):
        run_job(Job("j", upper, "sometimes"), source, target, "2020-01-03")
    with pytest.raises(PySparkException):
        run_job(Job("j", lambda df: df.selectExpr("id", "raise_error('broken') AS name")), source, target, "2020-01-03")


def test_a_day_of_a_stored_table_reads_one_day(spark, rows):
    table = keyed.KeyedTable(spark, fresh_path(spark, "t"), spark.createDataFrame([], SCHEMA).schema, partition_by=["name"])
    table.replace(spark.createDataFrame([(i, f"d{i % 5}", i) for i in range(50)], SCHEMA))
    day = table.snapshot().where("name = 'd3'")
    plan = day._jdf.queryExecution().executedPlan().toString()
    filters = re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", plan)
    assert filters and "= d3" in filters[1]
    assert day.count() == 10


def test_the_row_before_of_a_hot_key(spark, rows):
    """A key with most of the rows is looked at in blocks, and every row still has the one before it."""
    data = [(None if i % 50 == 0 else 1 if i % 3 else i % 7, i * 37 % 1009, f"v{i}") for i in range(900)]
    df = spark.createDataFrame(data, "id long, seq long, name string")
    df = df.unionByName(spark.createDataFrame([(1, -1, None)], df.schema))
    found = changelog.with_row_before(df, ["id"], ["seq"], ["seq", "name"], "back", blocks=8)
    expected = df.withColumn("back", F.lag(F.struct("seq", "name")).over(Window.partitionBy("id").orderBy("seq")))
    assert found.columns == expected.columns and rows(found) == rows(expected)
    blocks = spark.read.parquet(found.inputFiles()[0].rsplit("/", 1)[0]).groupBy("id", "_block").count()
    assert blocks.where("id = 1").count() > 3 and blocks.agg({"count": "max"}).first()[0] < 400
    assert rows(changelog.with_row_before(df, ["id"], ["seq"], ["seq", "name"], "back")) == rows(expected)
    assert changelog.with_row_before(df.limit(0), ["id"], ["seq"], ["seq"], "back").collect() == []
