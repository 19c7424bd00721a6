import json

import pytest
from pyspark.errors import PySparkException

from quayline.operators import cdc
from quayline.schemas import load_catalogue

CATALOGUE = load_catalogue()


def messages(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def oracle(table="SRC.tbl_job", op="I", before=None, after=None, ts="2020-02-02 10:00:00", pos="1"):
    return json.dumps({"table": table, "op_type": op, "op_ts": ts, "pos": pos, "before": before, "after": after})


def job(i, name="n", level=1):
    return {"id": i, "job_name": name, "job_level": level, "cdt": "2020-02-02 10:00:00"}


def jobs_of(spark, *texts, **options):
    changes = cdc.check_tables(cdc.parse(messages(spark, *texts), "oracle"), CATALOGUE)
    return cdc.typed_rows(changes, CATALOGUE["tbl_job"], **options)


def test_catalogue_has_every_table_with_matching_columns():
    assert len(CATALOGUE) == 51
    job_table = CATALOGUE["tbl_job"]
    assert job_table.schema.simpleString() == \
        "struct<id:bigint,jobName:string,jobLevel:bigint,cdt:string,udt:string,remark:string>"
    assert job_table.stored_schema["job_level"].dataType.simpleString() == "bigint"
    assert not job_table.schema["id"].nullable


def test_every_table_of_the_catalogue_is_routed(spark):
    texts = [oracle(f"SRC.{t.name}", after={c.source_name: "7" for c in t.columns}) for t in CATALOGUE.values()]
    changes = cdc.check_tables(cdc.parse(messages(spark, *texts), "oracle"), CATALOGUE).persist()
    assert changes.where("problem is not null").count() == 0
    for table in CATALOGUE.values():
        row = cdc.typed_rows(changes, table).first()
        assert [row[c.name] for c in table.columns] == [7 if c.type.typeName() in ("long", "integer", "double") else "7"
                                                        for c in table.columns]


def test_blank_null_broken_and_unknown_messages(spark, rows):
    changes = cdc.check_tables(cdc.parse(messages(
        spark, None, "", "   ", '{"table": "SRC.tb', oracle("SRC.tbl_nowhere", after=job(1)), oracle(after=None),
        oracle(after=job(5)), oracle(after={"job_name": "x"}), oracle(after=job("one"))), "oracle"), CATALOGUE)
    assert rows(changes.select("table", "problem")) == sorted([("tbl_job", "no key")] * 2 + [
        (None, "unreadable"), ("tbl_nowhere", "unknown table"), ("tbl_job", "no row"), ("tbl_job", None)], key=repr)
    kept = {r["problem"]: r["value"] for r in changes.collect()}
    assert kept[None] is None and kept["unreadable"] == '{"table": "SRC.tb'


def test_operations_and_the_row_of_a_delete(spark, rows):
    found = jobs_of(spark, oracle(op="I", after=job(1)), oracle(op="U", before=job(2, "old"), after=job(2, "new")),
                    oracle(op="D", before=job(3, "gone")), oracle(op="?", after=job(4)))
    assert rows(found.select("id", "jobName", "op_type")) == [
        (1, "n", "insert"), (2, "new", "update"), (3, "gone", "delete"), (4, "n", "insert")]


def test_missing_extra_and_unreadable_fields(spark, rows):
    texts = [oracle(after={"id": 1, "job_name": "a", "surplus": 1}), oracle(after=job(2, "b", "high")),
             oracle(after={"job_name": "no key"}), oracle(after={"id": "3", "jobName": "camel"})]
    assert rows(jobs_of(spark, *texts).select("id", "jobName", "jobLevel")) == [
        (1, "a", None), (2, "b", None), (3, "camel", None)]
    zeros = jobs_of(spark, *texts, null_numbers_as_zero=True).select("id", "jobLevel")
    assert rows(zeros) == [(1, 0), (2, 0), (3, 0)]


def test_last_change_wins_by_time_then_position(spark, rows):
    found = cdc.last_change(jobs_of(
        spark,
        oracle(op="U", after=job(1, "first"), pos="9"), oracle(op="U", after=job(1, "second"), pos="10"),
        oracle(op="U", after=job(2), pos="1"), oracle(op="D", before=job(2), pos="2"),
        oracle(op="D", before=job(3), pos="1"), oracle(op="I", after=job(3, "again"), pos="2"),
        oracle(op="I", after=job(4, "late"), ts="2020-02-02 10:00:01", pos="1"), oracle(after=job(4), pos="99")))
    assert rows(cdc.upserts(found).select("id", "jobName")) == [(1, "second"), (3, "again"), (4, "late")]
    assert rows(cdc.deletes(found)) == [(2,)]


def test_last_change_merges_in_each_task_before_the_shuffle(spark):
    plan = cdc.last_change(jobs_of(spark, oracle(after=job(1))))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("partial_max") == 1 and plan.count("Exchange") == 1


def mysql(table="crm_customer", data=(), kind="INSERT", ts=1, i=1):
    return json.dumps({"table": table, "type": kind, "ts": ts, "id": i, "data": list(data) if data is not None else None})


def test_mysql_rows(spark, rows):
    texts = [mysql(data=[{"id": "1", "name": "a"}, {"id": "2", "name": "b"}]), mysql(data=[]),
             mysql("crm_address", [{"id": "3"}, {"id": "4"}], "UPDATE"), mysql("shop_crm_x", [{"id": "5"}], "DELETE"),
             "{broken"]
    changes = cdc.check_tables(cdc.parse(messages(spark, *texts), "mysql"), CATALOGUE)
    assert rows(changes.select("table", "op_type", "row_no", "problem")) == sorted([
        ("tbl_customer", "insert", 0, None), ("tbl_customer", "insert", 1, None),
        ("tbl_address", "update", 0, None), ("tbl_address", "update", 1, None),
        ("shop_crm_x", "delete", 0, "unknown table"), (None, "insert", 0, "unreadable")], key=repr)
    first = cdc.parse_mysql(messages(spark, *texts), first_row_only=["tbl_customer"])
    assert first.where("table = 'tbl_customer'").count() == 1
    assert first.where("table = 'tbl_address'").count() == 2
    assert first.where("problem = 'unreadable'").count() == 1


def test_unknown_category_passes_through(spark, rows):
    raw = messages(spark, "a", "b")
    assert cdc.parse(raw, "other") is raw


def test_json_path_filter(spark, rows):
    texts = [oracle("SRC.tbl_a", after=job(1)), oracle("SRC.tbl_b", after=job(1)), "no json", None]
    assert cdc.where_json_path(messages(spark, *texts), "$.table", ["SRC.tbl_a"]).count() == 1


def test_unknown_operation_fails(spark):
    frame = spark.createDataFrame([(1, "insert"), (2, "truncate")], "id long, op_type string")
    with pytest.raises(PySparkException, match="unknown operation: truncate"):
        cdc.check_operations(frame).collect()


def test_one_third_of_the_changes_on_one_key(spark):
    changes = spark.range(30_000).selectExpr("if(id % 3 = 0, 0, id) AS id", "id AS seq", "'update' AS op_type")
    last = cdc.last_change(changes, order=["seq"])
    assert last.count() == changes.select("id").distinct().count()
    assert last.where("id = 0").first()["seq"] == 29_997


def test_positions_of_any_length_decide(spark, rows):
    digits = ["9", "10", "00000000000000000000000000000011", "1" * 21, "1" * 20 + "2", "9" * 19]
    order = sorted(range(len(digits)), key=lambda i: int(digits[i]))
    for a, b in zip(order, order[1:]):
        for pair in ((a, b), (b, a)):
            found = cdc.last_change(jobs_of(spark, *[oracle(after=job(1, str(i)), pos=digits[i]) for i in pair]))
            assert rows(found.select("jobName")) == [(str(b),)]


def test_the_topic_partition_comes_before_the_offset(spark, rows):
    messages = spark.createDataFrame([(oracle(after=job(1, "a")), 1, 5), (oracle(after=job(1, "b")), 2, 1)],
                                     "value string, partition int, offset long")
    found = cdc.last_change(cdc.typed_rows(cdc.parse(messages, "oracle"), CATALOGUE["tbl_job"]))
    assert rows(found.select("jobName")) == [("b",)]


def test_mysql_messages_without_usable_rows_are_problems(spark, rows):
    texts = [mysql(data=None), '{"table": "crm_customer", "type": "INSERT", "data": 7}',
             '{"table": "crm_customer", "type": "INSERT", "data": "x"}', mysql(data=[]), mysql(data=[{"id": "1"}]),
             '{"table": "crm_customer", "isDdl": true, "data": null, "type": "ALTER"}', "{half"]
    changes = cdc.check_tables(cdc.parse(messages(spark, *texts), "mysql"), CATALOGUE)
    assert rows(changes.select("problem")) == sorted([("no row",)] * 3 + [(None,), ("unreadable",)], key=repr)


def test_a_catalogue_that_does_not_parse_raises():
    from quayline.schemas import parse_catalogue
    assert list(parse_catalogue("# note\n\nt\n  id bigint id NUMBER(19,0)\n")) == ["t"]
    for bad in ("t\n  id bigint id", "  id bigint id NUMBER(19,0)", "t\n  id number id NUMBER(19,0)", "a b", "t\n", "t\n  id bigint id X\nt\n"):
        with pytest.raises(ValueError):
            parse_catalogue(bad)
