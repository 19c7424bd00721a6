"""Statistics of group counts per day, and the customer snapshot."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from quayline.functions.columns import as_date, money


def stats_of_group_counts(df: DataFrame, keys: Mapping[str, str], day: str = "day", total: str | None = None,
                          sums: bool = False) -> DataFrame:
    """For every day and every key: the largest, smallest and average size of the groups that key makes of the day.

    ``keys`` maps an output label to a column; each gives ``max<Label>Total``, ``min<Label>Total`` and
    ``avg<Label>Total`` (and ``sum<Label>Total``). ``total`` names a column whose non-null values are counted per day,
    ``"*"`` counts rows. NULL is a group of its own; rows without a day are left out.

    All days and keys are counted in one scan: one grouping set per key, so each task first merges its rows into one
    per (day, key value), and only group counts are shuffled. Which key a row belongs to comes from ``grouping_id``,
    because a NULL in a key column may also be a NULL group.
    """
    labels = list(keys)
    columns = [keys[label] for label in labels]
    rows = df.where(F.col(day).isNotNull()).select(
        F.col(day).alias("_day"), *[F.col(c).alias(f"_k{i}") for i, c in enumerate(columns)],
        *([F.col(total).alias("_total")] if total not in (None, "*") else []))
    names = [f"_k{i}" for i in range(len(columns))]
    sets = [[F.col("_day"), F.col(name)] for name in names]
    measures = [F.count(F.lit(1)).alias("_n")]
    if total is not None:
        measures.append((F.count(F.lit(1)) if total == "*" else F.count("_total")).alias("_t"))
    counts = (rows.groupingSets(sets, F.col("_day"), *[F.col(n) for n in names])
              .agg(F.grouping_id().alias("_set"), *measures))

    # grouping_id has one bit per grouping column, the first column highest; a set bit means "not grouped by".
    all_bits = (1 << len(names)) - 1
    key_set = [all_bits ^ (1 << (len(names) - 1 - i)) for i in range(len(names))]

    stats: list[Column] = []
    if total is not None:
        stats.append(F.sum(F.when(F.col("_set") == key_set[0], F.col("_t"))).alias("total"))
    for label, set_id in zip(labels, key_set):
        size = F.when(F.col("_set") == set_id, F.col("_n"))
        if sums:
            stats.append(F.sum(size).alias(f"sum{label}Total"))
        stats += [F.max(size).alias(f"max{label}Total"),
                  F.min(size).alias(f"min{label}Total"),
                  F.round(F.avg(size), 0).alias(f"avg{label}Total")]
    return counts.groupBy(F.col("_day").alias("id")).agg(*stats)


def customer_snapshot(customers: DataFrame, as_of: dt.date | str) -> DataFrame:
    """The ten customer figures of one date, in one aggregate over the customer wide table. Rates of nothing are NULL."""
    as_of = as_date(as_of)
    today = F.lit(as_of)
    idle = F.datediff(today, F.col("last_sender_cdt").try_cast("date"))
    registered = F.col("regdt").cast("string")
    has_bill = F.col("first_sender_id").isNotNull()
    figures = customers.agg(
        F.count(F.lit(1)).alias("customerCount"),
        F.count_if(F.date_format(F.col("regdt").try_cast("timestamp"), "yyyy-MM-dd")
                   == str(as_of - dt.timedelta(days=1))).alias("additionCustomerCount"),
        F.count_if(idle < 180).alias("_kept"),
        F.count_if(idle < 10).alias("activeCustomerCount"),
        # The upper bound is a text, so a registration later on the same day is not counted yet.
        F.count_if(registered.between(str(as_of.replace(day=1)), str(as_of))).alias("monthOfNewCustomerCount"),
        F.count_if(idle.between(90, 180)).alias("sleepCustomerCount"),
        F.count_if(idle >= 270).alias("loseCustomerCount"),
        F.count_if(has_bill).alias("customerBillCount"),
        F.sum(F.when(has_bill, F.col("totalCount"))).alias("_bills"),
        F.sum(F.when(has_bill, money("totalAmount"))).alias("_amount"),
    )
    return figures.select(
        F.lit(as_of.strftime("%Y%m%d")).alias("id"),
        "customerCount",
        "additionCustomerCount",
        F.try_divide(F.col("_kept").cast("double"), F.col("customerCount")).alias("preserveRate"),
        "activeCustomerCount",
        "monthOfNewCustomerCount",
        "sleepCustomerCount",
        "loseCustomerCount",
        "customerBillCount",
        F.try_divide(F.col("_amount").cast("double"), F.col("_bills")).alias("customerAvgAmount"),
        F.try_divide(F.col("_bills").cast("double"), F.col("customerBillCount")).alias("avgCustomerBillCount"),
    )


def distinct_days(df: DataFrame, day: str = "day") -> DataFrame:
    """The days present, as a table."""
    return df.select(day).where(F.col(day).isNotNull()).distinct()


def group_count(df: DataFrame, column: str, name: str = "total") -> DataFrame:
    """Rows per value; a NULL value counts nothing, as ``count(column)`` does."""
    return df.groupBy(column).agg(F.count(column).alias(name))
