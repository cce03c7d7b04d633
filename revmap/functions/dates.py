"""Month arithmetic. Every result stays a DATE, so that a filter on a DATE
column folds to a literal and reaches the Parquet scan or prunes partitions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_date(value: str | dt.date | Column) -> Column:
    """A DATE column from a date, an ISO text or a column."""
    return value.cast("date") if isinstance(value, Column) else F.lit(value).cast("date")


def month_start(day: str | dt.date | Column) -> Column:
    """First day of the month of ``day``."""
    return F.trunc(as_date(day), "MM")


def prior_month(as_of: str | dt.date | Column, months_back: int = 1) -> Column:
    """First day of the month that lies ``months_back`` months before ``as_of``."""
    return F.trunc(F.add_months(as_date(as_of), -months_back), "MM")


def yyyymm(day: str | dt.date | Column) -> Column:
    """Calendar year and month as text, e.g. 202512."""
    return F.date_format(as_date(day), "yyyyMM")


def prior_month_value(as_of: str | dt.date, months_back: int = 1) -> dt.date:
    """:func:`prior_month` on the driver, for file names and scan ranges."""
    day = dt.date.fromisoformat(as_of) if isinstance(as_of, str) else as_of
    months = day.year * 12 + day.month - 1 - months_back
    return dt.date(months // 12, months % 12 + 1, 1)


def run_stamp(run_ts: dt.datetime | str | None) -> Column:
    """The time a report was made; pass ``run_ts`` to make it reproducible."""
    return F.current_timestamp() if run_ts is None else F.lit(run_ts).cast("timestamp")
