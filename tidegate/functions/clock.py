"""Time helpers. Log timestamps are zone-free UTC (``timestamp_ntz``)."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

EPOCH = datetime(1970, 1, 1)


def _second_of_day(ts: Column) -> Column:
    return F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)


def seconds_between(start: Column | str, end: Column | str) -> Column:
    """Second boundaries crossed from start to end (00.9 -> 01.1 is 1, not 0)."""
    a = F.col(start) if isinstance(start, str) else start
    b = F.col(end) if isinstance(end, str) else end
    return (F.datediff(b, a) * 86400 + _second_of_day(b) - _second_of_day(a)).cast("int")


def iso_utc(ts: Column | str) -> Column:
    """ISO text with seven fractional digits and a trailing Z."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'0Z'")


def timestamp_literal(value: datetime | date, data_type: T.DataType | None = None) -> Column:
    """A UTC point in time as a literal of the column's own type.

    The literal must carry the column's type: comparing ``timestamp_ntz`` with a
    zoned literal casts the column, which loses the scan filter and depends on the
    session zone.
    """
    if not isinstance(value, datetime):
        value = datetime(value.year, value.month, value.day)
    if isinstance(data_type, T.TimestampType):
        return F.timestamp_micros(F.lit((value - EPOCH) // timedelta(microseconds=1)))
    ntz = F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")
    return ntz.cast("date") if isinstance(data_type, T.DateType) else ntz
