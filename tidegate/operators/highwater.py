"""High-water-mark capture and load windows on a modified-time column."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.functions.clock import EPOCH, timestamp_literal
from tidegate.functions.text import quoted
from tidegate.operators.projection import by_name


def _is_zoned(df: DataFrame, mark: str) -> bool:
    return isinstance(by_name(df.schema)[mark.lower()].dataType, T.TimestampType)


def top_of(df: DataFrame, mark: str) -> Column:
    """The largest mark as an aggregate: microseconds where the column has a zone, else zone-free."""
    top = F.max(quoted(mark))
    return F.unix_micros(top) if _is_zoned(df, mark) else top.cast("timestamp_ntz")


def as_utc(top: datetime | int | None) -> datetime | None:
    """A value of ``top_of`` as zone-free UTC."""
    return EPOCH + timedelta(microseconds=top) if isinstance(top, int) else top


def _inside(df: DataFrame, mark: str, last: datetime | None) -> Column:
    c = F.col(quoted(mark))
    return c.isNotNull() if last is None else c > timestamp_literal(last, by_name(df.schema)[mark.lower()].dataType)


def capture_window(df: DataFrame, mark: str, last: datetime | None) -> tuple[datetime | None, int]:
    """Largest mark of the whole source as zone-free UTC, and how many rows the window has.

    The window ends at the largest mark, so its rows are those whose mark lies above ``last``:
    both values come from one single-column scan with map-side partial results.
    """
    inside = F.count(F.when(_inside(df, mark, last), 1))
    row = df.agg(top_of(df, mark).alias("top"), inside.alias("rows")).first()
    return as_utc(row["top"]), row["rows"]


def capture(df: DataFrame, mark: str) -> datetime | None:
    """Largest mark of the whole source, or None when there is none."""
    return capture_window(df, mark, None)[0]


def window(
    df: DataFrame, mark: str, last: datetime | None, captured: datetime | None
) -> DataFrame:
    """Rows with ``last < mark <= captured``; a NULL mark never loads.

    Both ends are literals, so they reach the scan as pushed filters and can skip
    row groups and partitions.
    """
    if captured is None:
        return df.filter(F.lit(False))
    c, data_type = F.col(quoted(mark)), by_name(df.schema)[mark.lower()].dataType
    inside = c <= timestamp_literal(captured, data_type)
    if last is not None:
        inside = (c > timestamp_literal(last, data_type)) & inside
    return df.filter(inside)


# --- counts taken by the read that stages the rows --------------------------------


@dataclass(frozen=True)
class ObservedRead:
    """Rows to be staged, and what the job that writes them sees of the source.

    The figures belong to the one job that runs on ``frame``; they are there when it has ended.
    Each attempt makes its own, and a task that ran twice counts once.
    """

    frame: DataFrame
    seen: Observation
    captured: datetime | None = None  # the mark, where it was fixed before the read

    @property
    def rows(self) -> int:
        return self.seen.get["rows"]

    @property
    def mark(self) -> datetime | None:
        return self.captured if self.captured is not None else as_utc(self.seen.get.get("top"))

    @property
    def null_marks(self) -> int | None:
        return self.seen.get.get("null_marks")


def observed_rows(df: DataFrame) -> ObservedRead:
    """All rows, counted while they are read."""
    seen = Observation()
    return ObservedRead(df.observe(seen, F.count("*").alias("rows")), seen)


def observed_window(df: DataFrame, mark: str, last: datetime | None) -> ObservedRead:
    """The rows above ``last`` of a source that does not change while it is read.

    One read gives the largest mark of the whole source, the rows of the window that ends there, and
    the rows that have no mark and so never load. As the window has no other end than the largest
    mark, its rows are those above ``last``.
    """
    seen = Observation()
    inside = _inside(df, mark, last)
    figures = {"top": top_of(df, mark), "rows": F.count_if(inside), "null_marks": F.count_if(F.col(quoted(mark)).isNull())}
    return ObservedRead(df.observe(seen, *[c.alias(name) for name, c in figures.items()]).filter(inside), seen)


def bounded_window(df: DataFrame, mark: str, last: datetime | None, captured: datetime | None) -> ObservedRead:
    """The rows between two marks of which the upper one was captured before; counted while they are read.

    The filter stands below the count, so both marks reach the scan and skip files and row groups.
    """
    read = observed_rows(window(df, mark, last, captured))
    return ObservedRead(read.frame, read.seen, captured)
