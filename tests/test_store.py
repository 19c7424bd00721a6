"""Buckets, ranges, drifting fields, supervision and SQL functions: plans and cases that the queries do not show."""

import json
import re

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from quayline.checks import store_queries as sq
from quayline.checks.derived import DerivedTables
from quayline.operators.drift import unknown_fields
from quayline.operators.joins import widen
from quayline.operators.ranges import RangeTable, equal_ranges
from quayline.plans import sql, wide
from quayline.schemas import load_catalogue
from quayline.session import fresh_path
from quayline.sources.streams import file_stream
from quayline.streaming import feeds, supervision

CATALOGUE = load_catalogue()


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def folders_read(spark, df):
    """How many folders the one scan of a frame reads."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        again = df.select("*")
        again.collect()
        leaves = again._jdf.queryExecution().executedPlan().collectLeaves()
        return sum(leaves.apply(i).metrics().apply("numPartitions").value() for i in range(leaves.size()))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_tables_in_buckets_are_joined_as_they_lie(spark, folder):
    tables = sq.bucketed_tables(spark, folder)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        names = ["id", "cname", "ename", "caddress", "dot_id"]
        as_it_lies = plan_of(widen(wide.EXPRESS_BILL, tables, columns=names, co_located=tables.keys))
        shuffled = plan_of(widen(wide.EXPRESS_BILL, tables, columns=names))
        # bills by their number and parcels by theirs: neither side of this join moves
        by_number = sq.BucketedTables(spark, tables.prefix + "n_", {"tbl_express_bill": "expressNumber", "tbl_pkg": "pwBill"})
        for name in by_number.keys:
            by_number.write(name, DerivedTables(spark, folder)(name), buckets=8)
        parcels = by_number("tbl_express_bill").join(by_number("tbl_pkg"), F.col("expressNumber") == F.col("pwBill"), "left")
        both = plan_of(parcels.groupBy("expressNumber").agg(F.count("pwBill")))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(64 << 20))
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "SortMergeJoin" in as_it_lies and "SortMergeJoin" in both and "Exchange" not in both

    def moved(plan):
        """Tables with an exchange between their scan and what first joins or groups them."""
        out, above = set(), []  # the lines above in the tree, with their depth
        for line in plan.splitlines():
            depth = re.search(r"[*A-Za-z]", line).start() if re.search(r"[*A-Za-z]", line) else 0
            above = [*[x for x in above if x[0] < depth], (depth, line)]
            if "FileScan" in line:
                steps = [text for _, text in above[-2::-1]]
                end = next((i for i, text in enumerate(steps) if "Join" in text or "Aggregate" in text), len(steps))
                if any("Exchange" in text for text in steps[:end]):
                    out.add(re.search(r"_(tbl_\w+)\[", line).group(1))
        return out

    dimensions = {"tbl_customer", "tbl_courier", "tbl_address", "tbl_pkg", "tbl_consumer_address_map"}
    assert not moved(as_it_lies) & dimensions and moved(as_it_lies) == {"tbl_express_bill"}
    assert {"tbl_customer", "tbl_courier", "tbl_address"} <= moved(shuffled)
    assert as_it_lies.count("Exchange hashpartitioning") < shuffled.count("Exchange hashpartitioning") / 1.5


def test_ranges_are_even_however_skewed_the_key(spark, folder):
    orders = sq.skewed_orders(spark, "/root/testdata/sf0.01")
    table, number = equal_ranges(spark, orders, "id", 12), orders.count()
    sizes = [r["rows"] for r in table.ranges().collect()]
    assert len(sizes) == 12 and sum(sizes) == number and max(sizes) < 1.5 * number / 12 and min(sizes) > number / 24
    assert table.ranges().where("low = 77 and high = 77").count() >= 2  # a third of the rows is split
    assert folders_read(spark, table.lookup([901])) == 1 and "901" in plan_of(table.lookup([901])).split("PushedFilters")[1]
    assert 4 <= folders_read(spark, table.lookup([77])) <= 6 and folders_read(spark, table.between(900, 901)) <= 2
    assert table.lookup([77]).count() == orders.where("id = 77").count()
    assert table.lookup([]).count() == table.lookup([10 ** 9]).count() == 0


def test_ranges_of_texts_versions_and_empty_tables(spark, rows):
    df = spark.createDataFrame([(c, i) for i, c in enumerate("ba" * 20 + "z")] + [(None, 99)], "name string, n long")
    table = RangeTable(spark, fresh_path(spark, "r"), df.schema, "name")
    with pytest.raises(ValueError):
        table.snapshot()
    table.replace(df, 4)
    assert rows(table.snapshot()) == rows(df) and rows(table.lookup(["z", None])) == rows(df.where("name = 'z' or name is null"))
    assert rows(table.between("b", "y")) == rows(df.where("name = 'b'"))
    before = table.snapshot()
    table.replace(df.where("name = 'z'"), 3)
    assert rows(before) == rows(df) and table.snapshot().count() == 1
    table.vacuum()
    assert table.snapshot().count() == 1 and len(table._versions()) == 1
    table.replace(df.limit(0), 3)
    assert table.snapshot().collect() == [] == table.lookup(["a"]).collect()


def test_unknown_fields_of_both_tools(spark, rows):
    def oracle(**envelope):
        return json.dumps({"table": "SRC.tbl_job", "op_type": "U", "op_ts": "t", "pos": "1", **envelope})

    lines = [oracle(after={"id": 1, "job_name": "x", "new": 1}), oracle(after={"id": 2, "new": 2.5, "jobName": "y"}),
             oracle(before={"id": 3, "old": None}), oracle(after=None, before={"id": 4, "old": [1, "a"]}), oracle(after={"id": 5}),
             oracle(after={"id": 6, "x": 1}, table="SRC.tbl_nowhere"), "", None, "{", "[1]", "7", oracle(after=[1]), oracle(after="text")]
    messages = spark.createDataFrame([(x,) for x in lines], "value string")
    found = rows(unknown_fields(messages, "oracle", CATALOGUE))
    assert [(t, f, n) for t, f, _, n in found] == [("tbl_job", "new", 2), ("tbl_job", "old", 2)]
    assert found[0][2].startswith("DECIMAL") and found[1][2].startswith("ARRAY")
    mysql = [json.dumps({"table": "crm_customer", "type": "INSERT", "data": d}) for d in (
        [{"id": "1", "vip": True}, {"id": "2", "vip": None}], [], None, "text", [{"id": 3, "vip": False, "gone": "x"}], [7])]
    messages = spark.createDataFrame([(x,) for x in mysql], "value string")
    assert rows(unknown_fields(messages, "mysql", CATALOGUE)) == [("tbl_customer", "gone", "STRING", 1), ("tbl_customer", "vip", "BOOLEAN", 3)]
    assert unknown_fields(messages.limit(0), "mysql", CATALOGUE).collect() == []
    with pytest.raises(ValueError):
        unknown_fields(messages, "audit", CATALOGUE)


def job_lines(spark, inbox, *numbers):
    lines = [json.dumps({"table": "SRC.tbl_job", "op_type": "I", "op_ts": "t", "pos": str(n), "after": {"id": n}}) for n in numbers]
    spark.createDataFrame([(x,) for x in [*lines, "{broken"]], "value string").coalesce(1).write.mode("append").text(inbox)


def test_batches_report_rows_and_rejects_once(spark):
    inbox, seen = fresh_path(spark, "in"), []
    job_lines(spark, inbox, 1, 2, 3)
    job_lines(spark, inbox, 4)
    metrics = supervision.watch(spark, on_batch=lambda *line: seen.append(line))
    try:
        query = feeds.start_change_feed(file_stream(spark, inbox, 1), "oracle", fresh_path(spark, "t"), fresh_path(spark, "c"),
                                        CATALOGUE, available_now=True, name="jobs", tasks=3, compact_every=1)
        assert supervision.await_first(spark, [query]) is query
        metrics.wait_for(query)
    finally:
        spark.streams.removeListener(metrics)
    assert sorted((b, r, j) for _, _, b, r, j in metrics.batches) == [(0, 4, 1), (1, 2, 1)]
    assert seen == metrics.batches and {x["feed"] for x in metrics.frame(spark).collect()} == {"jobs"}


def test_a_failing_feed_ends_the_wait_with_its_error_and_the_others(spark, monkeypatch):
    inboxes = [fresh_path(spark, "in") for _ in range(2)]
    for inbox in inboxes:
        job_lines(spark, inbox, 1)
    metrics = supervision.watch(spark)
    try:
        good = feeds.start_change_feed(file_stream(spark, inboxes[0]), "oracle", fresh_path(spark, "t"), fresh_path(spark, "c"),
                                       CATALOGUE, name="good")
        good.processAllAvailable()
        assert good.isActive
        bad = feeds._start(file_stream(spark, inboxes[1]), lambda batch, n: (_ for _ in ()).throw(RuntimeError("disk on fire")),
                           "bad", fresh_path(spark, "c"), False)
        with pytest.raises(StreamingQueryException, match="disk on fire"):
            supervision.await_first(spark, [good, bad], poll=1)
        assert not good.isActive and not bad.isActive
        metrics.wait_for(bad)
        assert "disk on fire" in metrics.ended[str(bad.id)]
    finally:
        spark.streams.removeListener(metrics)
        for query in spark.streams.active:
            query.stop()
        spark.streams.resetTerminated()
    with pytest.raises(ValueError):
        supervision.await_first(spark, [])


def test_sql_functions_see_through_to_the_fact(spark, folder, rows):
    names = sql.register(spark, DerivedTables(spark, folder))
    sql.register(spark, DerivedTables(spark, folder))  # again, in place of the first
    assert len(names) == 8 and spark.table("tbl_customer_detail").count() == 150
    one = spark.sql("SELECT * FROM kpi_express_bill('19980615')")
    assert rows(one) == rows(spark.sql("SELECT * FROM kpi_express_bill() WHERE id = '19980615'")) and one.count() <= 1
    lines = plan_of(spark.sql("SELECT id, cname FROM wide_express_bill('19980615')")).splitlines()
    filtered = next(i for i, line in enumerate(lines) if "Filter" in line and "19980615" in line)
    assert "FileScan" in lines[filtered + 1] or "ColumnarToRow" in lines[filtered + 1] and "Join" not in lines[filtered + 1]
    for name in names:
        assert spark.sql(f"SELECT * FROM {name}() LIMIT 1").count() == 1
