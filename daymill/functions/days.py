"""Day keys, report windows and time conversions."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daymill.functions.values import col

OPEN_END = dt.date(9999, 12, 31)
REPORT_WINDOWS = (1, 7, 30)


def as_date(value: str | dt.date) -> dt.date:
    """Accepts a date, ``yyyy-MM-dd`` or ``yyyyMMdd``."""
    if isinstance(value, dt.date):
        return value
    return dt.date.fromisoformat(value)


def window_start(as_of: str | dt.date, days: int) -> dt.date:
    """First day of the window of ``days`` days that ends on ``as_of``."""
    return as_date(as_of) - dt.timedelta(days=days - 1)


def within(day: str | Column, as_of: str | dt.date, days: int) -> Column:
    return col(day).between(F.lit(window_start(as_of, days)), F.lit(as_date(as_of)))


def in_windows(df: DataFrame, as_of: str | dt.date, days=REPORT_WINDOWS, day: str = "dt") -> DataFrame:
    """Repeat each row once per window it falls in, as column ``recent_days``.

    The widest window is an ordinary filter, so it reaches the scan before
    the rows are repeated.
    """
    label = F.explode(
        F.filter(
            F.array(*[F.lit(n) for n in sorted(days)]),
            lambda n: F.datediff(F.lit(as_date(as_of)), F.col(day)) < n,
        )
    )
    return df.where(within(day, as_of, max(days))).withColumn("recent_days", label)


Days = tuple[str | dt.date, str | dt.date]


def window_days(as_of: str | dt.date, days: Sequence[int] = REPORT_WINDOWS) -> Days:
    """First and last day that windows of ``days`` days ending on ``as_of`` need."""
    return window_start(as_of, max(days)), as_date(as_of)


def raw_within(
    raw: str | Column, days: Days | None, unit: str = "timestamp", later: dt.timedelta = dt.timedelta(0), most: dt.timedelta | None = None
) -> Column:
    """Bounds on a raw time column for rows whose day lies in ``days``: the day expression turned around.

    The day is that of the raw value (a timestamp, or epoch ``millis`` or ``seconds``) plus ``later``, or plus something
    from ``later`` to ``most``; then the bounds let some rows too many pass and the day itself has to be tested too.
    Only constants are computed, so both bounds reach the statistics of a scan.  A null passes no bound; without
    ``days`` every row passes.
    """
    if days is None:
        return F.lit(True)
    start = dt.datetime.combine(as_date(days[0]), dt.time()) - (most if most is not None else later)
    end = dt.datetime.combine(as_date(days[1]), dt.time()) + dt.timedelta(days=1) - later
    low, high = (F.lit(at.isoformat(sep=" ")).cast("timestamp") for at in (start, end))
    if unit != "timestamp":
        epoch = {"millis": F.unix_millis, "seconds": F.unix_seconds}[unit]
        low, high = epoch(low), epoch(high)
    return (col(raw) >= low) & (col(raw) < high)


def millis_to_timestamp(c: str | Column) -> Column:
    """Epoch milliseconds, possibly as text; unreadable values give null."""
    return F.timestamp_millis(col(c).try_cast("bigint"))


def seconds_to_timestamp(c: str | Column) -> Column:
    return F.timestamp_seconds(col(c).try_cast("bigint"))


def seconds_between(start: str | Column, end: str | Column) -> Column:
    return F.unix_timestamp(col(end)) - F.unix_timestamp(col(start))


def hours_between(start: str | Column, end: str | Column) -> Column:
    return seconds_between(start, end) / F.lit(3600.0)


def iso_week(c: str | Column) -> Column:
    """``yyyy-ww`` with the ISO week-year, so that the turn of the year is whole."""
    return F.concat(
        F.extract(F.lit("YEAROFWEEK"), col(c)).cast("string"),
        F.lit("-"),
        F.lpad(F.weekofyear(col(c)).cast("string"), 2, "0"),
    )


def day_range(df: DataFrame, first: str | Column, last: str | Column, name: str = "day") -> DataFrame:
    """One row per day between two dates of a row, as a ``yyyyMMdd`` integer."""
    days = F.explode(F.sequence(col(first), col(last)))
    return df.withColumn(name, days).withColumn(name, F.date_format(name, "yyyyMMdd").cast("int"))
