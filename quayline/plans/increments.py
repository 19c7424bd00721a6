"""Keeping wide tables and KPIs up to date at the cost of what has changed.

**Wide tables.** A changed row of a dimension reaches the facts that look it up, directly or over other dimensions. The
keys under which it was and is found go up the lookups, table by table, until they are keys of facts; only those facts are
joined again, each dimension first reduced to what they look up. Sets of keys are stored before they are used, so that the
planner knows their size and broadcasts the small ones: a fact table is scanned and filtered, not shuffled.

**KPIs.** Largest, smallest and average group sizes cannot be corrected by a difference, but the group sizes can. They are
the state: a row for every day, key and value, stored under these three. Old versions of changed wide rows count down, new
ones count up, and the KPIs are made again from the sizes of the days that were touched.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from quayline.operators.joins import Lookup, Tables, WideJob, widen
from quayline.operators.keyed import KeyedTable
from quayline.plans.summary import SummaryJob, summarise
from quayline.session import fresh_path

TOTAL = "total"


def stored(df: DataFrame, name: str = "keys") -> DataFrame:
    """``df`` written and read again: its size is known, and it is not made twice."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _among(df: DataFrame, column: Column, keys: DataFrame) -> DataFrame:
    """The rows of ``df`` whose ``column`` is one of ``keys``."""
    return df.join(keys, column.cast("string") == F.col("_wanted"), "left_semi")


def _keys(df: DataFrame, column: str) -> DataFrame:
    return df.select(_normal(column).alias("_wanted")).where(F.col("_wanted").isNotNull())


def _normal(column: str) -> Column:
    # as text, as codes are numbers in some tables and texts in others; '02' and '2' are one code
    text = F.col(column).cast("string")
    # a cast that fails costs an exception, many times what a row costs else; a text with letters is no number
    number = F.when(~text.rlike("[A-Za-z]"), F.col(column).try_cast("bigint"))
    return F.coalesce(number.cast("string"), text)


def reached(job: WideJob, tables: Tables, changed: Mapping[str, DataFrame]) -> DataFrame:
    """The keys (``_wanted``, as text) of the rows of a wide table that changed rows of its tables can have an influence on.

    ``changed`` has for a table the rows that changed, as they were and as they are; ``tables`` gives the tables as they are.
    """
    key = job.key or "id"
    found = [_keys(changed[job.table], key)] if job.table in changed else []
    at: dict[str, list[DataFrame]] = {}  # for each role the keys under which something has changed
    parent = {lookup.role: lookup for lookup in job.lookups}
    for lookup in reversed(job.lookups):  # the dimensions furthest from the fact first
        rows = at.get(lookup.role, [])
        if lookup.table in changed:
            mine = changed[lookup.table]
            if lookup.code_type is not None:
                mine = mine.where(F.col("type") == lookup.code_type)
            rows = [*rows, _keys(mine, lookup.key)]
        if not rows:
            continue
        wanted = stored(_union(rows).distinct())
        role, column = lookup.to.split(".")
        if role == job.role:
            found.append(_keys(_among(tables(job.table), _normal(column), wanted), key))
        else:
            up = parent[role]
            at.setdefault(role, []).append(_keys(_among(tables(up.table), _normal(column), wanted), up.key))
    if not found:
        return tables(job.table).sparkSession.createDataFrame([], "_wanted string")
    return stored(_union(found).distinct())


def _union(parts: list[DataFrame]) -> DataFrame:
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def reduced(job: WideJob, tables: Tables, facts: DataFrame) -> Tables:
    """The tables of a job with only the rows that ``facts`` look up, where a table is looked up by one column."""
    rows: dict[str, DataFrame] = {job.role: facts}
    by_table: dict[str, list[Lookup]] = {}
    for lookup in job.lookups:
        by_table.setdefault(lookup.table, []).append(lookup)
    wanted: dict[str, list[DataFrame]] = {}
    for lookup in job.lookups:
        role, column = lookup.to.split(".")
        mine = stored(_keys(rows[role], column).distinct())
        wanted.setdefault(lookup.table, []).append(mine)
        rows[lookup.role] = _among(tables(lookup.table), _normal(lookup.key), mine)
    made: dict[str, DataFrame] = {}

    def table(name: str) -> DataFrame:
        if name not in made:
            lookups, made[name] = by_table.get(name, []), tables(name)
            if lookups and len({lookup.key for lookup in lookups}) == 1 and lookups[0].code_type is None:
                made[name] = _among(tables(name), _normal(lookups[0].key), _union(wanted[name]))
        return made[name]

    return table


def wide_changes(job: WideJob, tables: Tables, changed: Mapping[str, DataFrame]) -> DataFrame:
    """What changes in a wide table: its rows anew with ``op_type`` update, and deletes of rows that are no more.

    A row that comes out as it was is among the updates. Keys are numbers.
    """
    key, touched = job.key or "id", reached(job, tables, changed)
    facts = _among(tables(job.table), _normal(key), touched)
    rows = stored(widen(job, reduced(job, tables, stored(facts, "facts")), facts, nested=False), "rows")
    gone = touched.join(rows.select(F.col("id").cast("string").alias("_wanted")), "_wanted", "left_anti").select(
        F.col("_wanted").cast(rows.schema["id"].dataType).alias("id"), F.lit("delete").alias("op_type"))
    return rows.withColumn("op_type", F.lit("update")).unionByName(gone, allowMissingColumns=True)


# --- KPIs ---------------------------------------------------------------------------------------------------------


def group_counts(job: SummaryJob, rows: DataFrame, sign: int = 1) -> DataFrame:
    """The size of every group of a KPI job: ``day``, ``label``, ``value`` and ``n``, which ``sign`` counts up or down.

    One row per group leaves a task, whatever the number of rows.
    """
    groups = [F.struct(F.lit(label).alias("label"), F.col(column).cast("string").alias("value"), F.lit(sign).alias("n"))
              for label, column in job.keys.items()]
    if job.total is not None:
        counted = F.lit(sign) if job.total == "*" else F.when(F.col(job.total).isNotNull(), sign).otherwise(0)
        groups.append(F.struct(F.lit(TOTAL).alias("label"), F.lit(None).cast("string").alias("value"), counted.alias("n")))
    return (rows.where(F.col("day").isNotNull()).select("day", F.inline(F.array(*groups)))
            .groupBy("day", "label", "value").agg(F.sum("n").alias("n")))


def count_changes(job: SummaryJob, before: DataFrame, after: DataFrame) -> DataFrame:
    """By how much the groups change where ``after`` takes the place of ``before``; groups that stay are left out."""
    return (group_counts(job, before, -1).unionByName(group_counts(job, after)).groupBy("day", "label", "value")
            .agg(F.sum("n").alias("n")).where(F.col("n") != 0))


def kpis_of_counts(job: SummaryJob, counts: DataFrame) -> DataFrame:
    """The KPI rows of some days from the sizes of their groups; equal to ``summarise`` of the same rows."""
    stats: list[Column] = []
    if job.total is not None:
        stats.append(F.coalesce(F.sum(F.when(F.col("label") == TOTAL, F.col("n"))), F.lit(0)).alias(TOTAL))
    for label in job.keys:
        size = F.when(F.col("label") == label, F.col("n"))
        if job.sums:
            stats.append(F.sum(size).alias(f"sum{label}Total"))
        stats += [F.max(size).alias(f"max{label}Total"), F.min(size).alias(f"min{label}Total"),
                  F.round(F.avg(size), 0).alias(f"avg{label}Total")]
    return counts.groupBy(F.col("day").alias("id")).agg(*stats)


class KpiState:
    """The group sizes and the KPI rows of a job, stored under a folder and changed by differences.

    ``by_day`` stores the sizes in a folder per day, which pays where a day has many groups.
    """

    def __init__(self, job: SummaryJob, source: DataFrame, path: str, by_day: bool = False):
        spark, self.job = source.sparkSession, job
        empty = group_counts(job, source)
        self.counts = KeyedTable(spark, f"{path}/counts", self._keyed(empty).schema,
                                  partition_by=["day"] if by_day else [])
        self.kpis = KeyedTable(spark, f"{path}/kpis", kpis_of_counts(job, empty).schema)

    @staticmethod
    def _keyed(counts: DataFrame) -> DataFrame:
        # NULL is a value of its own, and no text is taken for it
        key = F.to_json(F.struct("day", "label", "value"))
        return counts.select(key.alias("id"), "day", "label", "value", "n")

    def load(self, rows: DataFrame) -> None:
        """Start anew from all wide rows."""
        self.counts.replace(self._keyed(group_counts(self.job, rows)), unique=True)
        self.kpis.replace(kpis_of_counts(self.job, self.counts.snapshot()), unique=True)

    def change(self, before: DataFrame, after: DataFrame, batch: int, feed: str = "main") -> DataFrame:
        """Take in the differences of one batch of a feed, and return the days that it touched. The batch may be repeated."""
        pending = self.counts.feed_batches(feed)
        if pending and max(pending) >= batch:  # these differences are counted; the KPIs may not be
            differences = self.counts.changes_of(feed, batch).select("day").distinct()
        else:
            moved = stored(self._keyed(count_changes(self.job, before, after)), "moved")
            days = moved.select("day").distinct()
            old = self.counts.snapshot(days).select("id", F.col("n").alias("_old"))
            new = (F.coalesce(F.col("_old"), F.lit(0)) + F.col("n")).alias("n")
            rows = moved.join(old, "id", "left").select("id", "day", "label", "value", new)
            op = F.when(F.col("n") == 0, "delete").otherwise("update")
            self.counts.apply(rows.withColumn("op_type", op), batch, order=None, feed=feed)
            differences = days
        days = stored(differences, "days")
        fresh = stored(kpis_of_counts(self.job, self.counts.snapshot(days).join(days, "day", "left_semi")), "fresh")
        gone = days.select(F.col("day").alias("id")).join(fresh.select("id"), "id", "left_anti")
        self.kpis.apply(fresh.withColumn("op_type", F.lit("update")).unionByName(
            gone.withColumn("op_type", F.lit("delete")), allowMissingColumns=True), batch, order=None, feed=feed)
        return days


def kpis_of_days(job: SummaryJob, wide: DataFrame, days: DataFrame, day: str = "day") -> DataFrame:
    """The KPIs of some days from a wide table stored by day: only the folders of these days are read.

    ``days`` is a table, of the days that an increment touched for example. The planner turns it into a filter on the folders
    while the job runs (dynamic partition pruning).
    """
    # a comparison, as the planner prunes only by tables that have a condition
    wanted = days.select(F.col(day).alias("_day")).where(F.col("_day") > "").distinct()
    return summarise(job, wide.join(wanted, F.col("day") == F.col("_day"), "left_semi"))
