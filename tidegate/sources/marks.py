"""The largest mark of a source, asked of the source itself before anything is staged.

Parquet files keep the largest value of every column per row group in their footers, and a
database answers ``MAX`` from an index. Either way no data column travels.

A footer answer is used as a hint only. Spark looks footer statistics up by the column's place in
the schema, so in a folder whose files order their columns differently it may give another
column's; and it pushes no ``MAX`` of timestamps, so these are read as the numbers they are
stored as, whose unit the schema does not tell. A second scan with ``mark >= hint`` as pushed filter
reads the row groups at the top alone: if it meets a row, the largest mark it meets is the
source's. If it meets none the hint was wrong, and the column is scanned.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.functions.clock import EPOCH, timestamp_literal
from tidegate.functions.text import quoted
from tidegate.operators.highwater import as_utc, top_of
from tidegate.operators.projection import by_name

# what lets the parquet reader answer aggregates from footers: its second version, and the switch
FOOTERS = {"spark.sql.sources.useV1SourceList": "", "spark.sql.parquet.aggregatePushdown": "true"}


@dataclass(frozen=True)
class Marks:
    """Of a whole source: the largest mark as zone-free UTC, the rows, and those without a mark."""

    top: datetime | None
    rows: int
    null_marks: int


def plain_marks(df: DataFrame, mark: str) -> Marks:
    """By one scan of the mark column."""
    row = _measured(df, mark).first()
    return Marks(as_utc(row["top"]), row["rows"], row["null_marks"])


def _measured(df: DataFrame, mark: str) -> DataFrame:
    return df.agg(top_of(df, mark).alias("top"), F.count("*").alias("rows"), F.count_if(F.col(quoted(mark)).isNull()).alias("null_marks"))


def footer_aggregate(spark: SparkSession, path: str, schema: T.StructType, mark: str) -> DataFrame:
    """One row (top, rows) from parquet footers; ``top`` as stored.

    The plan lives in a session of its own, because its settings change how all files are read.
    """
    session = spark.newSession()
    for name, value in FOOTERS.items():
        session.conf.set(name, value)
    stored = T.StructType(
        [
            T.StructField(f.name, T.LongType()) if f.name.lower() == mark.lower() and _is_instant(f) else f
            for f in schema.fields
        ]
    )
    return session.read.schema(stored).parquet(path).agg(F.max(quoted(mark)).alias("top"), F.count("*").alias("rows"))


def _is_instant(field: T.StructField) -> bool:
    return isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType))


def _hint(value, field: T.StructField) -> datetime | None:
    """The stored value as a time, taken for microseconds; wrong hints are found out by the scan."""
    if isinstance(value, date):
        return datetime(value.year, value.month, value.day)
    try:
        return EPOCH + timedelta(microseconds=value) if _is_instant(field) and value is not None else None
    except OverflowError:
        return None


def footer_marks(df: DataFrame, path: str, mark: str) -> Marks:
    """By the footers of the parquet files under ``path``, which ``df`` reads."""
    field = by_name(df.schema)[mark.lower()]
    if not (_is_instant(field) or isinstance(field.dataType, T.DateType)):
        return plain_marks(df, mark)
    try:
        known = footer_aggregate(df.sparkSession, path, df.schema, field.name).first()
    except Exception as error:  # a row group without statistics, as where all marks are null
        if "aggregatePushdown" not in str(error):
            raise
        return plain_marks(df, mark)
    hint = _hint(known["top"], field)
    if hint is None:
        return plain_marks(df, mark)
    c = F.col(quoted(mark))
    row = _measured(df.filter((c >= timestamp_literal(hint, field.dataType)) | c.isNull()), mark).first()
    if row["top"] is None:
        return plain_marks(df, mark)
    return Marks(as_utc(row["top"]), known["rows"], row["null_marks"])
