"""Date and time helpers, all on TIMESTAMP_NTZ so no session time zone leaks in.

The segmentation's clock is an explicit ``as_of`` literal; every edge derived
from it is a constant expression that Catalyst folds before execution.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ntz(ts: str) -> Column:
    """A TIMESTAMP_NTZ literal from 'YYYY-MM-DD[ HH:MM:SS[.ffffff]]' text."""
    return F.lit(ts).cast("timestamp_ntz")


def months_before(ts: Column, months: int) -> Column:
    """``ts`` moved back by calendar months; keeps the time of day and clamps
    to the month end (06-30 minus 4 months is 02-29)."""
    return F.timestamp_add("MONTH", F.lit(-months), ts)


def days_before(ts: Column, days: int) -> Column:
    """``ts`` moved back by whole days, keeping the time of day."""
    return F.timestamp_add("DAY", F.lit(-days), ts)


def day_start(ts: Column) -> Column:
    """Midnight of the calendar day of ``ts``: a date compared with a
    timestamp counts as its midnight."""
    return F.to_date(ts).cast("timestamp_ntz")


def day_within(ts: Column, lo: Column, hi: Column) -> Column:
    """``day_start(ts) BETWEEN lo AND hi`` written on the raw column: the edges
    become constant days, so nothing is computed per row and the reader can
    prune on the range."""
    first = F.when(day_start(lo) == lo, day_start(lo)).otherwise(
        F.timestamp_add("DAY", F.lit(1), day_start(lo)))
    return (ts >= first) & (ts < F.timestamp_add("DAY", F.lit(1), day_start(hi)))


def days_between(start: Column, end: Column) -> Column:
    """Calendar-day boundaries crossed from ``start`` to ``end`` (not whole
    24-hour spans: 23:00 to 01:00 next day is 1)."""
    return F.date_diff(end, start)


def calendar_day_range(ts: Column, first_day: str, last_day: str) -> Column:
    """``to_date(ts) BETWEEN first_day AND last_day`` written on the raw
    column, so that the Parquet reader can prune on it."""
    return (ts >= ntz(first_day)) & (
        ts < F.timestamp_add("DAY", F.lit(1), ntz(last_day))
    )
