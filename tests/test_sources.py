import datetime as dt
import os

import pytest
from pyspark.sql import functions as F, types as T

from quayline.functions import calendar, columns as fc
from quayline.operators import audit, search
from quayline.schemas import load_catalogue
from quayline.session import fresh_path, shared_dir
from quayline.sources import delimited, external, tables




def write(folder, **files):
    os.makedirs(folder, exist_ok=True)
    for name, text in files.items():
        with open(os.path.join(folder, name + ".csv"), "w", encoding="utf-8", newline="") as out:
            out.write(text)


def test_ragged_files(spark, rows, tmp_path):
    folder = str(tmp_path / "in")
    head = "id,name,type,code,code_desc,code_type,state,cdt,udt"
    write(folder,
          a=f"﻿{head}\r\n1, north ,2,7, x,NUMBER,1,2020/2/14 18:19,2020-02-14 18:19:05\r\n2,,,,,,,,\r\n",
          b=f'{head}\n3,"q",,c, ,t,1,,\n4,a,1,c,d,t,1,2020/2/14 1:02,2020/2/14 1:02,extra\n5,a,many,c\n6,a,1,c,d,t,1,x\n\n')
    good, bad = delimited.ingest_table(spark, folder, load_catalogue()["tbl_codes"])
    t = dt.datetime
    assert rows(good) == [
        (1, "north", 2, "7", "x", "NUMBER", 1, t(2020, 2, 14, 18, 19), t(2020, 2, 14, 18, 19, 5)),
        (2, None, None, None, None, None, None, None, None),
        (3, '"q"', 0, "c", None, "t", 1, None, None)]
    assert rows(bad.select(F.substring("line", 1, 2), "problem")) == [
        ("4,", "too many values"), ("5,", "unreadable value"), ("6,", "unreadable value")]


def test_header_order_and_missing_columns(spark, rows, tmp_path):
    folder = str(tmp_path / "in")
    write(folder, a="b,a\n1,2\n")
    good, _ = delimited.ingest(spark, folder, T.StructType().add("a", "integer").add("b", "string").add("c", "double"))
    assert rows(good) == [(2, "1", None)]


def test_incremental_scan_is_pushed_down(spark, folder):
    events = spark.read.parquet(f"{folder}/events.parquet")
    scan = tables.day_before(events, "2024-01-31", "ts")
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts" in plan and "LessThan(ts" in plan


def test_incremental_scan_edges(spark, rows):
    df = spark.createDataFrame([("2020-01-01 00:00:00",), ("2020-01-01 23:59:59",), ("2020-01-02 00:00:00",),
                                ("2019-12-31 23:59:59",), (None,)], "cdt string")
    assert tables.day_before(df, "2020-01-02").count() == 2
    assert tables.day_before(df.select(F.col("cdt").cast("timestamp").alias("cdt")), dt.date(2020, 1, 2)).count() == 2
    assert tables.load_fact(df, "full", "2020-01-02").count() == 5


def test_query_by_example(spark, rows):
    df = spark.createDataFrame([(1, "a", True, 1.5), (2, "a", False, 1.5), (3, "b", False, 2.0)],
                               "id long, s string, flag boolean, x double")
    assert rows(tables.query_by_example(df, {"id": 0, "s": "a", "x": 0.0})) == [(1, "a", 1.5), (2, "a", 1.5)]
    assert rows(tables.query_by_example(df, {"id": None, "flag": False})) == [(2, False), (3, False)]
    assert rows(tables.query_by_example(df, {"id": 0, "s": ""}, limit=1, order=["id"])) == [(1, "a")]
    assert [tables.is_set(v) for v in (None, 0, -1, 2, 0.0, "", "x", False, dt.date(2020, 1, 1))] == \
        [False, False, False, True, False, False, True, True, True]


def test_external_types_and_scan_options():
    assert [external.spark_type(t) for t in (
        "UInt64", "FixedString(8)", "Nullable(Int32)", "Decimal(18, 2)", "DateTime('UTC')", "Array(String)", "Point")] == \
        ["bigint", "string", "int", "decimal(18,2)", "timestamp", "string", "void"]
    options = external.scan_options("jdbc:x", "t", {"a": "UInt8", "b": "Point"}, "a", (0, 100), 8, fetchsize="100")
    assert options == {"url": "jdbc:x", "dbtable": "t", "customSchema": "`a` int, `b` string", "fetchsize": "100",
                       "partitionColumn": "a", "lowerBound": "0", "upperBound": "100", "numPartitions": "8"}
    with pytest.raises(ValueError):
        external.scan_options("jdbc:x", "t", partition_column="a")


def test_search(spark, rows):
    docs = spark.createDataFrame([(1, "The cat and THE the", "en"), (2, "theatre; bathe", "en"), (3, "thé the.", "fr"),
                                  (4, None, "fr"), (5, "a+b", None)], "id long, text string, lang string")
    assert rows(search.hits(docs, "text", ["the"]).select("id", "text")) == [
        (1, "<em>The</em> cat and <em>THE</em> <em>the</em>"), (3, "thé <em>the</em>.")]
    assert rows(search.hits(docs, "text", ["the"], limit=1, order=["id"]).select("id")) == [(1,)]
    assert rows(search.hits(docs, "text", ["a+b"]).select("id")) == [(5,)]
    assert rows(search.facets(docs, "text", ["the", "b"], ["lang"])) == sorted(
        [("total", None, 3), ("lang", "en", 1), ("lang", "fr", 1), ("lang", None, 1)], key=repr)
    assert search.count_matches(docs, "text", ["none"]).first()["total"] == 0


def test_audit(spark, rows):
    frames = {"a": spark.range(3), "b": spark.range(3), "c": spark.range(5)}
    assert rows(audit.table_counts(frames)) == [("a", 3), ("b", 3), ("c", 5)]
    assert audit.total_count(frames).first()["total"] == 11
    assert audit.distinct_total_count(frames).first()["total"] == 8
    expected = spark.createDataFrame([("a", 3), ("c", 6), ("d", 1)], "table_name string, cnt long")
    assert rows(audit.audit(frames, expected)) == [("a", 3, 3, 0), ("b", 3, None, 3), ("c", 5, 6, -1), ("d", None, 1, -1)]


def test_calendar_edges(spark):
    days = spark.createDataFrame([(dt.date(2019, 12, 29),), (dt.date(2020, 1, 1),), (dt.date(2020, 5, 31),),
                                  (dt.date(1900, 3, 4),)], "date date")
    found = {r["date"]: r for r in calendar.calendar(days).collect()}
    new_years_week = found[dt.date(2019, 12, 29)]
    assert new_years_week["week_label"] == "2019年第01周"  # the week that holds January 1st
    assert new_years_week["week_begin"] == dt.datetime(2019, 12, 23)  # weeks as spans run from Monday
    assert new_years_week["week_day_1"] == dt.date(2019, 12, 30)
    assert found[dt.date(2020, 1, 1)]["week_label"] == "2020年第01周"
    late = found[dt.date(2020, 5, 31)]
    assert (late["quarter_first_month"], late["quarter_month_day"]) == (4, dt.date(2020, 5, 1))
    assert late["leap_year"] and not found[dt.date(1900, 3, 4)]["leap_year"]
    assert late["grid_first_sunday"] == dt.date(2020, 4, 26)
    assert late["month_end"] == dt.datetime(2020, 5, 31, 23, 59, 59, 999000)


def test_slices(spark, rows):
    months = spark.createDataFrame([(dt.date(2021, 2, 10),)], "month date")
    found = [r["slice"].day for r in calendar.month_slices(months, 9).orderBy("slice").collect()]
    assert found == [1, 10, 19, 28]
    bounds = spark.createDataFrame([(dt.date(2020, 12, 31), dt.date(2021, 1, 1))], "a date, b date")
    assert calendar.slices_between(bounds, "a", "b", 30).count() == 4


def test_times(spark):
    texts = ["2020-02-14 18:19:00", "20200214181900", "20200214181900123", "2020-02-14", "20200214",
             "2020-02-14 18:19:00.123", "Fri Feb 14 18:19:00 UTC 2020", "soon", "2020-02-30", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    base, day = dt.datetime(2020, 2, 14, 18, 19), dt.datetime(2020, 2, 14)
    assert [r[0] for r in df.select(fc.parse_time("t")).collect()] == [
        base, base, base.replace(microsecond=123000), day, day, base.replace(microsecond=123000), base,
        None, None, None, None]


def test_date_columns(spark):
    row = spark.range(1).select(
        fc.day_text("2020-03-01").alias("today"), fc.day_text("2020-03-01", -1).alias("yesterday"),
        fc.day_key("2020-03-01", -1).alias("key"), fc.latest(F.lit(None).cast("int"), F.lit(3)).alias("latest"),
        fc.in_range(F.lit(1), F.lit(None).cast("int"), F.lit(2)).alias("in_range"),
        fc.same_week(F.lit(dt.date(2020, 3, 1)), F.lit(dt.date(2020, 3, 7))).alias("same"),
        fc.same_week(F.lit(dt.date(2020, 2, 29)), F.lit(dt.date(2020, 3, 1))).alias("other"),
        fc.render_text(F.lit(" x ")).alias("text")).first()
    assert tuple(row) == ("2020-03-01", "2020-02-29", "20200229", 3, False, True, False, "x")


def test_shared_folder(spark):
    assert fresh_path(spark, "x") != fresh_path(spark, "x")
    assert fresh_path(spark, "x").startswith(shared_dir(spark).rstrip("/"))
