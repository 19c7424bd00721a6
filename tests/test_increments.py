"""Increments of wide tables and KPIs against a rebuild, and what their plans read."""

import pytest
from pyspark.sql import functions as F

from quayline.checks import change_queries as cq
from quayline.checks.derived import DerivedTables
from quayline.operators.keyed import KeyedTable
from quayline.plans import increments, summary, wide
from quayline.session import fresh_path

CHANGES = {
    "tbl_waybill_detail": {
        "tbl_warehouse": ("id % 3 = 0", {"name": "'old'"}), "tbl_company_warehouse_map": ("id % 5 = 0", {"companyId": "105"}),
        "tbl_route": ("id = 4", {"startStation": "'nowhere'"}), "tbl_transport_record": ("id % 17 = 0", {"swId": "swId + 1"}),
        "tbl_codes": ("type = 16", {"codeDesc": "'kind'"}), "tbl_waybill": ("id % 23 = 0", {"eid": "3", "cid": "NULL"})},
    "tbl_warehouse_detail": {
        "tbl_express_bill": ("id % 19 = 0", {"cid": "cid + 1"}), "tbl_consumer_sender_info": ("id % 29 = 0", {"ciid": "ciid + 1"}),
        "tbl_push_warehouse": ("id % 31 = 0", {"warehouseId": "warehouseId + 1"}), "tbl_dot": ("id % 13 = 0", {"id": "id + 5000"})},
    "tbl_dot_transport_tool_detail": {
        "tbl_transport_tool": ("id % 7 = 0", {"id": "id + 900000", "brand": "'gone'"}),
        "tbl_dot_transport_tool": ("id % 37 = 0", {"transportToolId": "transportToolId + 1", "dotId": "1"}),
        "tbl_company": ("id % 2 = 0", {"companyTel": "'1'"})},
}


@pytest.mark.parametrize("name", sorted(CHANGES))
def test_changes_of_any_table_equal_a_rebuild(spark, folder, rows, name):
    job, tables, other, changed = wide.JOBS[name], DerivedTables(spark, folder), {}, {}
    for table, (which, values) in CHANGES[name].items():
        other[table], changed[table] = cq.altered(tables(table), F.expr(which), {c: F.expr(v) for c, v in values.items()})
    store, rebuilt = cq.wide_store(spark, job, cq.overlay(tables, other)), rows(wide.wide_table(job, tables))
    before = rows(store.snapshot())
    changes = increments.wide_changes(job, tables, changed)
    store.apply(changes, 0, order=None)
    assert before != rebuilt == rows(store.snapshot())


def test_changes_that_reach_nothing(spark, folder):
    tables, job = DerivedTables(spark, folder), wide.EXPRESS_BILL
    nobody = tables("tbl_courier").limit(1).withColumn("id", F.lit(-5).cast("long"))
    assert increments.wide_changes(job, tables, {"tbl_courier": nobody}).collect() == []
    assert increments.wide_changes(job, tables, {"tbl_route": tables("tbl_route")}).collect() == []  # not one of its tables
    assert increments.wide_changes(job, tables, {}).collect() == []


def test_the_fact_is_filtered_and_not_shuffled(spark, folder):
    tables, job = DerivedTables(spark, folder), wide.EXPRESS_BILL
    keys = increments.stored(tables("tbl_courier").where("id = 3").select(F.col("id").cast("string").alias("_wanted")))
    facts = increments._among(tables(job.table), increments._normal("eid"), keys)
    plan = facts._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
    assert 0 < facts.count() < tables(job.table).count() / 50


def test_only_the_touched_days_are_read(spark, folder):
    stored = cq.stored_by_day(spark, folder)
    days = increments.stored(spark.createDataFrame([("19980615",), ("19970101",), (None,)], "day string"))
    found = increments.kpis_of_days(summary.EXPRESS_BILL, stored, days)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        again = increments.kpis_of_days(summary.EXPRESS_BILL, stored, days)
        ids = {r["id"] for r in again.collect()}
        leaves = again._jdf.queryExecution().executedPlan().collectLeaves()
        scans = [leaves.apply(i) for i in range(leaves.size()) if "day" in leaves.apply(i).toString() and "dynamicpruning" in leaves.apply(i).toString()]
        read = [scan.metrics().apply("numPartitions").value() for scan in scans]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert read == [len(ids)] and ids <= {"19980615", "19970101"} and stored.select("day").distinct().count() > 100
    whole = {tuple(r) for r in summary.summarise(summary.EXPRESS_BILL, stored).collect()}
    assert {tuple(r) for r in found.collect()} <= whole


def wide_rows(spark, *rows):
    return spark.createDataFrame(rows, "id long, day string, type int, dot_id long, order_channel_id long, order_terminal_type string")


@pytest.mark.parametrize("by_day", [False, True])
def test_kpi_state_by_hand(spark, rows, by_day):
    job = summary.EXPRESS_BILL
    first = wide_rows(spark, (1, "a", 1, None, 1, "x"), (2, "a", 1, 5, 1, None), (3, "a", 2, 5, 1, "x"), (4, "b", 1, 1, 1, "x"), (5, None, 1, 1, 1, "x"))
    state = increments.KpiState(job, first, fresh_path(spark, "kpi"), by_day)
    state.load(first)
    assert rows(state.kpis.snapshot()) == rows(summary.summarise(job, first))
    # a row moves to a new day, one goes with its day, one gets a value instead of NULL
    before = wide_rows(spark, (2, "a", 1, 5, 1, None), (4, "b", 1, 1, 1, "x"), (1, "a", 1, None, 1, "x"))
    after = wide_rows(spark, (2, "c", 1, 5, 1, None), (1, "a", 1, 7, 1, "null"))
    touched = state.change(before, after, 0)
    assert {r["day"] for r in touched.collect()} == {"a", "b", "c"}
    now = wide_rows(spark, (2, "c", 1, 5, 1, None), (1, "a", 1, 7, 1, "null"), (3, "a", 2, 5, 1, "x"), (5, None, 1, 1, 1, "x"))
    assert rows(state.kpis.snapshot()) == rows(summary.summarise(job, now))
    assert state.counts.snapshot().where("n <= 0").count() == 0
    # nothing changes, then everything goes
    assert state.change(after, after, 1).collect() == []
    state.change(now, now.limit(0), 2)
    assert state.kpis.snapshot().collect() == [] == state.counts.snapshot().collect()


@pytest.mark.parametrize("job", list(summary.JOBS.values()), ids=list(summary.JOBS))
def test_counts_give_the_same_kpis(spark, folder, rows, job):
    source = increments.stored(wide.wide_table(job.source, DerivedTables(spark, folder)))
    assert rows(increments.kpis_of_counts(job, increments.group_counts(job, source))) == rows(summary.summarise(job, source))


EVENT = "id long, name string, event_time string, event_pos struct<length: int, text: string>, event_partition long, event_offset long, row_no int, op_type string"


def test_late_events_do_not_undo_newer_ones(spark, rows):
    def batch(*lines):
        return spark.createDataFrame([(i, n, t, (len(p), p), 0, 0, 0, op) for i, n, t, p, op in lines], EVENT)

    schema = spark.createDataFrame([], "id long, name string").schema
    table = KeyedTable(spark, fresh_path(spark, "late"), schema, by_event=True)
    table.replace(spark.createDataFrame([(1, "loaded"), (9, "loaded")], schema))
    table.apply(batch((1, "new", "2020-01-03", "30", "update"), (2, "b", "2020-01-03", "31", "insert"), (3, None, "2020-01-05", "50", "delete")), 0)
    assert rows(table.snapshot()) == [(1, "new"), (2, "b"), (9, "loaded")]
    late = batch((1, "old", "2020-01-02", "20", "update"), (2, None, "2020-01-04", "40", "delete"), (3, "zombie", "2020-01-01", "10", "insert"))
    table.apply(late, 1)
    table.apply(late, 1)
    assert rows(table.snapshot()) == [(1, "new"), (9, "loaded")]
    table.compact()
    table.apply(batch((2, "old", "2020-01-03", "39", "update"), (3, "back", "2020-01-06", "60", "insert"), (9, None, "2020-01-01", "9", "delete")), 2)
    assert rows(table.snapshot()) == [(1, "new"), (3, "back")]
    # two events of one moment: the position decides, whatever its length
    table.apply(batch((1, "at 9", "2020-01-07", "9", "update")), 3)
    table.apply(batch((1, "at 10", "2020-01-07", "10", "update")), 4)
    table.apply(batch((1, "at 8", "2020-01-07", "8", "update")), 5)
    assert rows(table.snapshot()) == [(1, "at 10"), (3, "back")]
    # marks stay over compactions until they are forgotten
    table.compact()
    assert table._state(table._generations()[-1], []).where("op_type = 'delete'").count() == 2
    table.apply(batch((4, "d", "2020-01-08", "1", "insert")), 6)
    table.compact(forget_before="2020-01-02")
    assert [r["id"] for r in table._state(table._generations()[-1], []).where("op_type = 'delete'").collect()] == [2]
    assert rows(table.snapshot()) == [(1, "at 10"), (3, "back"), (4, "d")]


SMALL = "id long, name string, op_type string"


def test_keys_stored_once(spark, rows):
    schema = spark.createDataFrame([], "id long, name string").schema
    table = KeyedTable(spark, fresh_path(spark, "t"), schema)
    table.upsert(spark.createDataFrame([(1, "b"), (1, "a"), (2, None)], schema))
    assert rows(table.snapshot()) == [(1, "b"), (2, None)]
    table.replace(spark.createDataFrame([(1, "x"), (1, "y"), (3, "z")], schema))
    assert rows(table.snapshot()) == [(1, "y"), (3, "z")]
    versions = spark.createDataFrame([(3, "late", 2), (3, "zz", 1)], "id long, name string, seq int")
    table.upsert(versions, order=["seq"])
    assert rows(table.snapshot()) == [(1, "y"), (3, "late")]


def test_listings_do_not_grow_with_the_table(spark, rows, monkeypatch):
    from quayline.operators import keyed
    listed, find = [], keyed.finished_folders
    monkeypatch.setattr(keyed, "finished_folders", lambda s, p: listed.append((p, found := find(s, p))) or found)
    schema = spark.createDataFrame([], "id long, name string").schema
    table = KeyedTable(spark, fresh_path(spark, "t"), schema)
    for number in range(24):
        table.apply(spark.createDataFrame([(number % 5, f"v{number}", "update")], SMALL).coalesce(1), number, order=None)
        if number % 6 == 5:
            table.compact()
    listed.clear()
    assert rows(table.snapshot()) == sorted(((n % 5, f"v{n}") for n in range(19, 24)), key=repr)
    assert max(len(found) for p, found in listed if "/changes/" in p) <= 12 and table.feed_batches("main")[-1] == 23
    table.vacuum()
    assert rows(table.snapshot()) == sorted(((n % 5, f"v{n}") for n in range(19, 24)), key=repr)
    assert len(find(spark, f"{table.path}/base/_arrival=*")) == 2
    with pytest.raises(ValueError):
        table.apply(spark.createDataFrame([(1, "x", "update")], SMALL), 3, order=None)
    table.apply(spark.createDataFrame([(1, "other", "update")], SMALL), 23, order=None)  # a repeat of what the base holds
    assert (1, "other") not in rows(table.snapshot())


def test_keys_as_text_without_casts_that_fail_on_words(spark):
    from pyspark.sql import functions as F
    from quayline.plans.increments import _normal
    texts = [None, "", "EB17", "2", "02", " 2 ", "+2", "-2", "1.5", "1e3", "1L", "é", "99999999999999999999", "0x1f", "2\t", "\u0000" + "3"]
    found = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    old = F.coalesce(F.col("t").try_cast("bigint").cast("string"), F.col("t"))
    assert found.where(~_normal("t").eqNullSafe(old)).collect() == []
    assert spark.range(3).where(_normal("id") != F.col("id").cast("string")).collect() == []
    plan = found.select(_normal("t"))._jdf.queryExecution().optimizedPlan().toString()
    assert "[A-Za-z]" in plan  # words don't reach the cast, which would raise for each of them
