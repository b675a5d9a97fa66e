"""Date dimension and joins on the date part of a timestamp."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

DRILL = ["Year", "QuarterNo", "MonthNo", "Day"]


def date_dimension(df: DataFrame, ts: str) -> DataFrame:
    """Every day from the first day of the earliest year to the last of the latest."""
    bounds = df.agg(F.min(F.year(ts)).alias("y0"), F.max(F.year(ts)).alias("y1"))
    days = F.sequence(F.make_date("y0", F.lit(1), F.lit(1)), F.make_date("y1", F.lit(12), F.lit(31)))
    dates = bounds.filter(F.col("y0").isNotNull()).select(F.explode(days).alias("Date"))
    return with_date_parts(dates)


def with_date_parts(days: DataFrame) -> DataFrame:
    d = F.col("Date")
    return days.select(
        "*",
        F.year(d).alias("Year"),
        F.quarter(d).alias("QuarterNo"),
        F.concat(F.lit("Qtr "), F.quarter(d).cast("string")).alias("Quarter"),
        F.month(d).alias("MonthNo"),
        F.date_format(d, "MMMM").alias("Month"),
        F.dayofmonth(d).alias("Day"),
    )


def daily_counts(df: DataFrame, ts: str, alias: str) -> DataFrame:
    """Rows per calendar day of ``ts``; rows without a timestamp belong to no day."""
    return (
        df.filter(F.col(ts).isNotNull())
        .groupBy(F.to_date(ts).alias("Date"))
        .agg(F.count("*").alias(alias))
    )


def by_date(df: DataFrame, ts: str, calendar: DataFrame, alias: str) -> DataFrame:
    """Rows per calendar day, days without rows kept as zero.

    The log is counted per day before it meets the calendar, so the join is day-sized
    and a busy day weighs no more than an idle one.
    """
    zero = F.coalesce(F.col(alias), F.lit(0).cast("bigint"))
    return calendar.join(daily_counts(df, ts, alias), "Date", "left").withColumn(alias, zero)


def related_days(df: DataFrame, timestamps: dict[str, str], alias: str) -> DataFrame:
    """Rows per day and relationship: one pass over ``df`` counts all its timestamps."""
    pairs = [F.struct(F.lit(name).alias("relationship"), F.to_date(ts).alias("Date")) for name, ts in timestamps.items()]
    days = df.select(F.inline(F.array(*pairs))).filter(F.col("Date").isNotNull())
    return days.groupBy("relationship", "Date").agg(F.count("*").alias(alias))


def fill_days(days: DataFrame, alias: str) -> DataFrame:
    """The missing days of whole years, as zero, for each relationship of ``related_days``.

    Every day brings the gap up to the next one, the first and last also the rest of their
    year; nothing is read a second time for the bounds. The window sorts days, not log rows.
    """
    order = Window.partitionBy("relationship").orderBy("Date")
    day = F.col("Date")
    begin = F.when(F.lag("Date").over(order).isNull(), F.trunc(day, "year")).otherwise(day)
    last = F.make_date(F.year(day), F.lit(12), F.lit(31))
    end = F.coalesce(F.date_sub(F.lead("Date").over(order), 1), last)
    spread = days.withColumns({"_begin": begin, "_end": end}).withColumn("_day", F.explode(F.sequence("_begin", "_end")))
    count = F.when(F.col("_day") == day, F.col(alias)).otherwise(F.lit(0).cast("bigint"))
    return spread.select("relationship", F.col("_day").alias("Date"), count.alias(alias))


def calendar_rollup(df: DataFrame, ts: str, alias: str) -> DataFrame:
    """Counts on every level of the Year > Quarter > Month > Day hierarchy.

    Days are counted first; the rollup then expands days, not log rows.
    """
    days = with_date_parts(daily_counts(df, ts, "_n"))
    return days.rollup(*DRILL).agg(F.sum("_n").alias(alias))
