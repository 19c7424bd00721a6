import random

import pytest
from pyspark.sql import functions as F

from quayline.operators.kpi import customer_snapshot, distinct_days, group_count, stats_of_group_counts
from quayline.plans import summary
from quayline.checks.derived import DerivedTables

SCHEMA = "day string, id long, a string, b long"


def loop_form(df, keys, total):
    """The same figures, a day and a key at a time."""
    found = []
    for (day,) in df.select("day").where("day is not null").distinct().collect():
        rows = df.where(F.col("day") == day)
        line = [day, rows.count() if total == "*" else rows.where(f"{total} is not null").count()]
        for key in keys.values():
            sizes = [r["count"] for r in rows.groupBy(key).count().collect()]
            line += [max(sizes), min(sizes), float(int(sum(sizes) / len(sizes) + 0.5))]
        found.append(tuple(line))
    return sorted(found)


def test_null_groups_equal_counts_halves_and_days(spark, rows):
    df = spark.createDataFrame(
        [("1", 1, "x", 1), ("1", 2, "x", None), ("1", None, None, None),  # sizes 2 and 1: 1.5 rounds up
         ("2", 4, "x", 1), ("2", 5, "y", 1),                               # equal sizes
         ("3", 6, None, None),                                             # only a NULL group
         (None, 7, "x", 1)], SCHEMA)
    found = rows(stats_of_group_counts(df, {"A": "a", "B": "b"}, total="id"))
    assert found == [("1", 2, 2, 1, 2.0, 2, 1, 2.0), ("2", 2, 1, 1, 1.0, 2, 2, 2.0), ("3", 1, 1, 1, 1.0, 1, 1, 1.0)]
    assert found == loop_form(df, {"A": "a", "B": "b"}, "id")


@pytest.mark.parametrize("seed", range(3))
def test_random_rows_with_a_hot_group(spark, rows, seed):
    rng = random.Random(seed)
    data = [(rng.choice(["1", "2", None]), rng.choice([None, i]),
             "hot" if rng.random() < 0.34 else rng.choice([None, "a", "b", "c"]), rng.choice([None, 1, 2, 3, 4, 5]))
            for i in range(rng.randint(1, 200))]
    df = spark.createDataFrame(data, SCHEMA)
    assert rows(stats_of_group_counts(df, {"A": "a", "B": "b"}, total="id")) == loop_form(df, {"A": "a", "B": "b"}, "id")


def test_rows_or_ids_and_sums(spark, rows):
    df = spark.createDataFrame([("1", None, "x", 1), ("1", 2, "y", 1)], SCHEMA)
    assert stats_of_group_counts(df, {"A": "a"}, total="*").first()["total"] == 2
    assert stats_of_group_counts(df, {"A": "a"}, total="id").first()["total"] == 1
    assert rows(stats_of_group_counts(df, {"A": "a"}, sums=True)) == [("1", 2, 1, 1, 1.0)]


def test_no_rows(spark):
    assert stats_of_group_counts(spark.createDataFrame([], SCHEMA), {"A": "a"}).count() == 0


def test_one_scan_and_group_sized_shuffles(spark, folder):
    orders = spark.read.parquet(f"{folder}/orders.parquet").withColumn("day", F.date_format("o_orderdate", "yyyyMMdd"))
    kpis = stats_of_group_counts(orders, {"P": "o_orderpriority", "S": "o_orderstatus"})
    plan = kpis._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange hashpartitioning") == 2
    assert plan.count("partial_count") == 1 and "partial_max" in plan
    assert "ReadSchema: struct<o_orderstatus:string,o_orderdate:timestamp_ntz,o_orderpriority:string>" in plan


@pytest.mark.parametrize("job", summary.JOBS.values(), ids=lambda j: j.name)
def test_kpis_of_the_stored_table_equal_kpis_of_the_sources(spark, folder, rows, job):
    from quayline.plans.wide import wide_table
    tables = DerivedTables(spark, folder)
    assert rows(summary.summarise(job, wide_table(job.source, tables))) == rows(summary.summarise_source(job, tables))


def snapshot(spark, rows, as_of="2021-03-10"):
    df = spark.createDataFrame(rows, "regdt string, last_sender_cdt string, first_sender_id long, totalCount long, "
                                     "totalAmount double")
    return customer_snapshot(df, as_of).first()


def test_snapshot_boundaries(spark):
    idle = {9: "2021-03-01", 10: "2021-02-28", 89: "2020-12-11", 90: "2020-12-10", 179: "2020-09-12",
            180: "2020-09-11", 181: "2020-09-10", 269: "2020-06-14", 270: "2020-06-13"}
    found = snapshot(spark, [(None, day + " 12:00:00", 1, 2, 10.5) for day in idle.values()] + [(None,) * 5])
    assert (found["customerCount"], found["activeCustomerCount"]) == (10, 1)
    assert found["preserveRate"] == 0.5
    assert (found["sleepCustomerCount"], found["loseCustomerCount"]) == (3, 1)
    assert (found["customerBillCount"], found["customerAvgAmount"], found["avgCustomerBillCount"]) == (9, 5.25, 2.0)
    assert found["id"] == "20210310"


def test_snapshot_registrations(spark):
    days = ["2021-03-09 08:00:00", "2021-03-10 00:00:00", "2021-03-01 00:00:00", "2021-02-28 23:59:59", None, "2021-03-10"]
    found = snapshot(spark, [(d, None, None, None, None) for d in days])
    assert found["additionCustomerCount"] == 1
    assert found["monthOfNewCustomerCount"] == 3  # a registration later today is not counted yet


def test_snapshot_of_nothing(spark):
    found = snapshot(spark, [])
    assert found["customerCount"] == 0 and found["preserveRate"] is None and found["customerAvgAmount"] is None


def test_small_aggregates(spark, rows):
    df = spark.createDataFrame([("1", 1, "x", 1), ("1", 1, None, 1), (None, 1, "x", 1)], SCHEMA)
    assert rows(distinct_days(df)) == [("1",)]
    assert rows(group_count(df, "a")) == [("x", 2), (None, 0)]
