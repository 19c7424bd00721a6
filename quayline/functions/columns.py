"""Column helpers shared by the jobs. All of them are built-in expressions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F

# The text layouts a date-time may have, by their length in characters.
LAYOUT_BY_LENGTH = {
    19: "yyyy-MM-dd HH:mm:ss",
    14: "yyyyMMddHHmmss",
    17: "yyyyMMddHHmmssSSS",
    10: "yyyy-MM-dd",
    8: "yyyyMMdd",
    23: "yyyy-MM-dd HH:mm:ss.SSS",
}
# Fixed value: the layout a date-time has when it was printed by a JVM.
PRINTED_LAYOUT = "MMM dd HH:mm:ss yyyy"
PRINTED_PATTERN = r"^[A-Za-z]{3} ([A-Za-z]{3} \d{2} \d{2}:\d{2}:\d{2}) [A-Z]{3,4} (\d{4})$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def day_of_text(c: Column | str) -> Column:
    """``2020-02-14 18:19:00`` (text) to ``20200214``, by cutting the text."""
    return F.regexp_replace(F.substring(_col(c), 1, 10), "-", "")


def day_of_time(c: Column | str) -> Column:
    """The day of a timestamp, or of a text that reads as one, as ``yyyyMMdd``; NULL where it does not."""
    return F.date_format(_col(c).try_cast("timestamp"), "yyyyMMdd")


def as_date(value: dt.date | str) -> dt.date:
    return value if isinstance(value, dt.date) else dt.date.fromisoformat(value)


def day_text(as_of: dt.date | str, shift: int = 0) -> Column:
    """Today (``shift=0``), yesterday (``-1``) ... as ``yyyy-MM-dd``, relative to a given date."""
    return F.date_format(F.lit(as_date(as_of) + dt.timedelta(days=shift)), "yyyy-MM-dd")


def day_key(as_of: dt.date | str, shift: int = 0) -> Column:
    """The same as ``yyyyMMdd``."""
    return F.date_format(F.lit(as_date(as_of) + dt.timedelta(days=shift)), "yyyyMMdd")


def money(c: Column | str, exact: bool = True) -> Column:
    """An amount ready to be summed: exact decimals, or plain doubles."""
    return _col(c).cast("decimal(18,2)" if exact else "double")


def parse_time(c: Column | str) -> Column:
    """A text in any of the known layouts, as a timestamp. NULL, not the present time, where none fits."""
    c = _col(c)
    parsed = F.when(c.rlike(PRINTED_PATTERN),
                    F.try_to_timestamp(F.regexp_replace(c, PRINTED_PATTERN, "$1 $2"), F.lit(PRINTED_LAYOUT)))
    for length, layout in LAYOUT_BY_LENGTH.items():
        text = c
        if layout.endswith("ssSSS"):  # the parser finds the fraction only behind a point
            text, layout = F.concat(F.substring(c, 1, length - 3), F.lit("."), F.substring(c, -3, 3)), layout[:-3] + ".SSS"
        parsed = parsed.when(F.length(c) == length, F.try_to_timestamp(text, F.lit(layout)))
    return parsed


def from_epoch(c: Column | str) -> Column:
    """Whole seconds since 1970 as a timestamp."""
    return F.timestamp_seconds(_col(c).cast("bigint"))


def render_text(c: Column | str) -> Column:
    """A value as the text a sink expects: trimmed strings, ``yyyy-MM-dd HH:mm:ss`` times, real NULLs."""
    return F.trim(_col(c).cast("string"))


# --- date arithmetic on columns ---------------------------------------------------------------------------------


def days_between(later: Column | str, earlier: Column | str) -> Column:
    return F.datediff(_col(later), _col(earlier))


def millis_between(later: Column | str, earlier: Column | str) -> Column:
    return F.unix_millis(_col(later).cast("timestamp")) - F.unix_millis(_col(earlier).cast("timestamp"))


def latest(*cols: Column | str) -> Column:
    """The largest of the values that are not NULL."""
    return F.greatest(*map(_col, cols))


def earliest(*cols: Column | str) -> Column:
    return F.least(*map(_col, cols))


def shift_days(c: Column | str, days: int) -> Column:
    return F.date_add(_col(c).cast("date"), days)


def shift_minutes(c: Column | str, minutes: int) -> Column:
    return F.timestamp_add("MINUTE", F.lit(minutes), _col(c))


def in_range(c: Column | str, start: Column | str, end: Column | str) -> Column:
    """Both ends included; false, not NULL, where an end is missing."""
    return F.coalesce(_col(c).between(_col(start), _col(end)), F.lit(False))


def sunday_of(c: Column | str) -> Column:
    """The Sunday that begins the week of a date."""
    day = _col(c).cast("date")
    return F.date_sub(day, F.dayofweek(day) - 1)


def same_week(a: Column | str, b: Column | str) -> Column:
    """Whether two dates fall in one week that runs from Sunday to Saturday."""
    return sunday_of(a) == sunday_of(b)
