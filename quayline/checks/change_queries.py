"""Tables that follow their sources: increments of wide tables and KPIs, late events, touched days, with their SQL.

Each query starts from an earlier state, which the module makes from the present one, and takes in the changes; the SQL is
that of the present state.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from quayline.checks import messages
from quayline.checks.derived import DerivedTables
from quayline.operators.joins import Tables
from quayline.operators.keyed import KeyedTable
from quayline.operators.kpi import distinct_days
from quayline.plans import increments, summary, wide
from quayline.schemas import load_catalogue
from quayline.session import fresh_path
from quayline.streaming import feeds

BILLS = "tbl_express_bill"


def overlay(tables: Tables, other: Mapping[str, DataFrame]) -> Tables:
    """``tables`` with some of them in another version."""
    return lambda name: other[name] if name in other else tables(name)


def altered(rows: DataFrame, which: Column, values: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """An earlier version of ``rows``, in which the rows ``which`` had other values; and what changed since, old and new."""
    kinds = {f.name: f.dataType for f in rows.schema}
    old = rows.where(which).withColumns({c: v.cast(kinds[c]) for c, v in values.items()})
    return rows.where(~which).unionByName(old), old.unionByName(rows.where(which))


def earlier_bills(bills: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Two earlier versions of the bills, and what changed after each: a seventh was missing, an eleventh was of another day
    and channel, and some were there that are no more, which go in the second step."""
    new, moved = F.col("id") % 7 == 0, (F.col("id") % 11 == 0) & (F.col("id") % 7 != 0)
    gone = bills.where("id % 13 = 0").withColumn("id", -F.col("id"))
    there = bills.where(~new)
    first, changed = altered(there, moved, {"cdt": F.concat(F.lit("1996-02-29"), F.substring("cdt", 11, 30)),
                                            "orderChannelId": F.col("orderChannelId") % 3, "eid": F.col("eid") + 1})
    return first.unionByName(gone), changed.unionByName(bills.where(new)), bills.unionByName(gone), gone


def wide_store(spark: SparkSession, job, tables: Tables) -> KeyedTable:
    """A wide table stored under its key."""
    rows = wide.wide_table(job, tables)
    store = KeyedTable(spark, fresh_path(spark, job.name), rows.schema)
    store.replace(rows, unique=True)
    return store


def _two_steps(spark: SparkSession, folder: str) -> tuple[KeyedTable, increments.KpiState]:
    tables, job = DerivedTables(spark, folder), wide.EXPRESS_BILL
    first, changed, second, gone = earlier_bills(tables(BILLS))
    store = wide_store(spark, job, overlay(tables, {BILLS: first}))
    state = increments.KpiState(summary.EXPRESS_BILL, store.snapshot(), fresh_path(spark, "kpi"))
    state.load(store.snapshot())
    for batch, (now, rows) in enumerate([(second, changed), (tables(BILLS), gone)]):
        changes = increments.stored(increments.wide_changes(job, overlay(tables, {BILLS: now}), {BILLS: rows}), "changes")
        before = store.snapshot().join(changes.select("id"), "id", "left_semi")
        after = changes.where("op_type = 'update'")
        for _ in range(2):  # a batch that is repeated counts once
            state.change(before, after, batch)
        store.apply(changes, batch, order=None)
    return store, state


def kpi_incremental(spark: SparkSession, folder: str) -> DataFrame:
    """The bill KPIs after inserts, updates, deletes and bills that change their day, from differences alone."""
    return _two_steps(spark, folder)[1].kpis.snapshot()


def wide_increment(spark: SparkSession, folder: str) -> DataFrame:
    """The stored wide table after the same changes of its fact."""
    return _two_steps(spark, folder)[0].snapshot()


def wide_delta(spark: SparkSession, folder: str) -> DataFrame:
    """The bill table after changes of nine of its ten dimensions, near ones and far ones."""
    tables, ids = DerivedTables(spark, folder), F.col("id")
    other, changed = {}, {}
    for name, which, values in (
            ("tbl_courier", ids % 5 == 0, {"name": F.concat(F.lit("once "), "name")}),
            ("tbl_customer", ids % 41 == 0, {"name": F.lit("nobody"), "type": F.col("type") + 1}),
            ("tbl_consumer_address_map", ids % 43 == 0, {"addressId": F.col("addressId") + 7}),
            ("tbl_address", ids % 47 == 0, {"detailAddr": F.lit("moved")}),
            ("tbl_pkg", ids % 53 == 0, {"pwDotId": F.col("pwDotId") + 1, "pwBill": F.concat(F.lit("EB"), (ids + 1).cast("string"))}),
            ("tbl_dot", ids % 7 == 3, {"dotName": F.lit("closed"), "id": ids + 100_000}),
            ("tbl_company_dot_map", ids % 11 == 4, {"companyId": F.lit(101)}),
            ("tbl_company", ids == 103, {"companyName": F.lit("before the merger")}),
            ("tbl_codes", ids.isin(1802, 1702), {"codeDesc": F.lit("old text")})):
        other[name], changed[name] = altered(tables(name), which, values)
    store = wide_store(spark, wide.EXPRESS_BILL, overlay(tables, other))
    store.apply(increments.wide_changes(wide.EXPRESS_BILL, tables, changed), 0, order=None)
    return store.snapshot()


def cdc_late_events(spark: SparkSession, folder: str) -> DataFrame:
    """Events that come in any order, up to two batches late, deletes among them, with a compaction in between; and the
    messages that could not be used."""
    rows, root = messages.oracle_messages(spark.read.parquet(f"{folder}/events.parquet")), fresh_path(spark, "tables")
    names, catalogue = ("tbl_vehicle_monitor", "tbl_waybill_line"), load_catalogue()
    batch = F.pmod(F.xxhash64("value"), F.lit(3))
    for number in range(3):
        feeds.apply_batch(rows.where(batch == number), number, "oracle", root, catalogue, compact_every=2, by_event=True)
    tables = feeds.keyed_tables(spark, root, catalogue, by_event=True)
    return messages.with_rejects({n: tables[n].snapshot() for n in names}, feeds.rejects(spark, root))


def stored_by_day(spark: SparkSession, folder: str) -> DataFrame:
    """The bill table in folders of its days."""
    path = fresh_path(spark, "by_day")
    rows = wide.wide_table(wide.EXPRESS_BILL, DerivedTables(spark, folder))
    rows.hint("rebalance", "day").write.partitionBy("day").parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def kpi_touched_days(spark: SparkSession, folder: str) -> DataFrame:
    """The bill KPIs of the days on which some bills changed; only these days are read."""
    changed = DerivedTables(spark, folder)(BILLS).where("id % 97 = 0").select(
        F.regexp_replace(F.substring("cdt", 1, 10), "-", "").alias("day"))
    return increments.kpis_of_days(summary.EXPRESS_BILL, stored_by_day(spark, folder),
                                   increments.stored(distinct_days(changed), "days"))


QUERIES = {f.__name__: f for f in (
    kpi_incremental, wide_increment, wide_delta, cdc_late_events, kpi_touched_days)}


def oracles(others: Mapping[str, str]) -> dict[str, str]:
    """The SQL of the present state, as other queries have it."""
    return {
        "kpi_incremental": others["kpi_express_bill"],
        "wide_increment": others["wide_express_bill"],
        "wide_delta": others["wide_express_bill"],
        "cdc_late_events": others["cdc_oracle_apply"],
        "kpi_touched_days": f"""
            SELECT * FROM ({others["kpi_express_bill"]}) WHERE id IN (
                SELECT strftime(o_orderdate, '%Y%m%d') FROM orders WHERE o_orderkey % 97 = 0)""",
    }
