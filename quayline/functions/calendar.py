"""Calendar tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from quayline.functions.columns import sunday_of


def calendar(dates: DataFrame, column: str = "date") -> DataFrame:
    """The calendar facts of every date in ``dates``: one row in, one row out."""
    day = F.col(column)

    def begin(unit: str, shift: str | None = None) -> Column:
        at = F.date_trunc(unit, day)
        return at + F.expr(shift) if shift else at

    def end(next_begin: Column) -> Column:
        return next_begin - F.expr("INTERVAL '0.001' SECOND")

    quarter_begin = F.trunc(day, "quarter")
    next_new_year = F.make_date(F.year(day) + 1, F.lit(1), F.lit(1))
    new_year = F.make_date(F.year(day), F.lit(1), F.lit(1))
    # Weeks run from Sunday; the week that holds the next January 1st is already week 1.
    week = F.when(sunday_of(day) == sunday_of(next_new_year), F.lit(1)).otherwise(
        (F.datediff(sunday_of(day), sunday_of(new_year)) / 7).cast("int") + 1)
    return dates.select(
        day.alias("date"),
        begin("day").alias("day_begin"), end(begin("day", "INTERVAL 1 DAY")).alias("day_end"),
        F.date_sub(day, 1).alias("yesterday"), F.date_add(day, 1).alias("tomorrow"),
        begin("week").alias("week_begin"), end(begin("week", "INTERVAL 7 DAYS")).alias("week_end"),
        begin("week", "INTERVAL -7 DAYS").alias("last_week_begin"), end(begin("week")).alias("last_week_end"),
        begin("month").alias("month_begin"), end(begin("month", "INTERVAL 1 MONTH")).alias("month_end"),
        begin("month", "INTERVAL -1 MONTH").alias("last_month_begin"), end(begin("month")).alias("last_month_end"),
        begin("year").alias("year_begin"), end(begin("year", "INTERVAL 1 YEAR")).alias("year_end"),
        ((F.quarter(day) - 1) * 3 + 1).alias("quarter_first_month"),
        # the same day of the month, which may run over into the second month
        F.date_add(quarter_begin, F.dayofmonth(day) - 1).alias("quarter_month_day"),
        (F.dayofyear(F.make_date(F.year(day), F.lit(12), F.lit(31))) == 366).alias("leap_year"),
        F.date_format(day, "EEEE").alias("weekday"),
        F.format_string("%d年第%02d周", F.year(day), week).alias("week_label"),
        F.trunc(day, "month").alias("month_first"),
        sunday_of(F.trunc(day, "month")).alias("grid_first_sunday"),
        *[F.date_add(sunday_of(day), n).alias(f"week_day_{n}") for n in range(7)],
    )


def date_range(bounds: DataFrame, start: str, end: str) -> DataFrame:
    """Every date from ``start`` to ``end`` of each row of ``bounds``."""
    return bounds.select(F.explode(F.sequence(F.col(start).cast("date"), F.col(end).cast("date"),
                                              F.expr("INTERVAL 1 DAY"))).alias("date"))


def month_slices(months: DataFrame, k: int, column: str = "month") -> DataFrame:
    """For each month: its 1st, every ``k`` days from there while before the last day, and the last day."""
    first = F.trunc(F.col(column), "month")
    last = F.last_day(first)
    steps = F.sequence(first, F.date_sub(last, 1), F.expr(f"INTERVAL {int(k)} DAYS"))
    return months.select(first.alias("month"), F.explode(F.concat(steps, F.array(last))).alias("slice"))


def slices_between(bounds: DataFrame, start: str, end: str, k: int) -> DataFrame:
    """``month_slices`` for every month from ``start`` to ``end``."""
    months = bounds.select(F.explode(F.sequence(F.trunc(F.col(start), "month"), F.trunc(F.col(end), "month"),
                                                F.expr("INTERVAL 1 MONTH"))).alias("month"))
    return month_slices(months, k)
