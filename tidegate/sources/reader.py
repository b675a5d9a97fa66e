"""Source connections: any ``schema.table`` named in the configuration, as a DataFrame.

A DataFrame fixes its file listing when it is made, so one object serves the mark capture
and the staging read of a load and both see the same input.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from typing import Protocol

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.functions.text import quoted
from tidegate.operators.fingerprint import Declared, declared_type, render_type
from tidegate.operators.highwater import as_utc
from tidegate.sources.marks import Marks, footer_marks
from tidegate.state.vocabulary import LoadError

_ABSENT = {"TABLE_OR_VIEW_NOT_FOUND", "PATH_NOT_FOUND", "SCHEMA_NOT_FOUND"}


class Connection(Protocol):
    """``read`` is required. A connection may also have ``marks(df, schema, table, mark) -> Marks``,
    which asks the source for its largest mark before rows are read; others have it observed
    while rows are staged. And it may have ``declared(spark, schema, table) -> list[Declared]``, for
    what a DataFrame's schema does not tell of the columns."""

    def read(self, spark: SparkSession, schema: str, table: str) -> DataFrame: ...


@dataclass(frozen=True)
class CatalogTables:
    """Tables of the session catalog, or of a named one."""

    catalog: str | None = None

    def read(self, spark: SparkSession, schema: str, table: str) -> DataFrame:
        parts = [p for p in (self.catalog, schema, table) if p]
        return spark.table(".".join(quoted(p) for p in parts))


@dataclass(frozen=True)
class ParquetFolder:
    """``<root>/<schema>/<table>`` folders of parquet files."""

    root: str

    def read(self, spark: SparkSession, schema: str, table: str) -> DataFrame:
        return spark.read.parquet(f"{self.root}/{schema}/{table}")

    def marks(self, df: DataFrame, schema: str, table: str, mark: str) -> Marks:
        return footer_marks(df, f"{self.root}/{schema}/{table}", mark)


def _load_jdbc(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    return spark.read.format("jdbc").options(**options).load()


@dataclass(frozen=True)
class JdbcDatabase:
    """Tables of a database. Marks, counts and the bounds of a split read are asked of the database.

    ``partitioning[schema, table]`` is either the name of a numeric, date or timestamp column, by
    whose smallest and largest value the read is split into ``partitions`` ranges, or the reader's
    own options (partitionColumn, lowerBound, upperBound, numPartitions). A table that is not
    named is read by one task. ``load`` makes a DataFrame of reader options. Column declarations come from
    the information schema, unless the database has none.
    """

    url: str
    properties: Mapping[str, str] = field(default_factory=dict)
    partitioning: Mapping[tuple[str, str], Mapping[str, str] | str] = field(default_factory=dict)
    partitions: int = 64
    information_schema: bool = True
    load: Callable[[SparkSession, Mapping[str, str]], DataFrame] = _load_jdbc

    def options(self, schema: str, table: str) -> dict[str, str]:
        split = self.partitioning.get((schema, table), {})
        given = {} if isinstance(split, str) else {k: str(v) for k, v in split.items()}
        return {"url": self.url, "dbtable": _sql_name(schema, table), **self.properties, **given}

    def _ask(self, spark: SparkSession, query: str) -> DataFrame:
        """The answer to a query that the database runs."""
        return self.load(spark, {"url": self.url, **self.properties, "query": query})

    def bounds_query(self, schema: str, table: str, column: str) -> str:
        return f"SELECT MIN({_sql_name(column)}) AS low, MAX({_sql_name(column)}) AS high FROM {_sql_name(schema, table)}"

    def marks_query(self, schema: str, table: str, mark: str) -> str:
        c = _sql_name(mark)
        return f"SELECT MAX({c}) AS top, COUNT(*) AS all_rows, COUNT({c}) AS marked FROM {_sql_name(schema, table)}"

    def columns_query(self, schema: str, table: str) -> str:
        """The information schema's row of every column."""
        own, name = (part.replace("'", "''") for part in (schema, table))
        return (
            "SELECT column_name, data_type, character_maximum_length, numeric_precision, numeric_scale, datetime_precision, "
            f"is_nullable FROM information_schema.columns WHERE table_schema = '{own}' AND table_name = '{name}'"
        )

    def declared(self, spark: SparkSession, schema: str, table: str) -> list[Declared]:
        """Length, precision, scale of times and nullability; one row per column of one table."""
        if not self.information_schema:
            return []
        return [
            Declared(name, declared_type(kind, length, precision, scale, time_scale), nullable.upper() == "YES")
            for name, kind, length, precision, scale, time_scale, nullable in self._ask(spark, self.columns_query(schema, table)).collect()
        ]

    def read(self, spark: SparkSession, schema: str, table: str) -> DataFrame:
        options, split = self.options(schema, table), self.partitioning.get((schema, table))
        if isinstance(split, str):
            # as text in the session's zone, which is how the reader takes bounds
            bounds = self._ask(spark, self.bounds_query(schema, table, split))
            low, high = bounds.select(F.col("low").cast("string"), F.col("high").cast("string")).first()
            if low != high:
                options |= {"partitionColumn": split, "lowerBound": low, "upperBound": high, "numPartitions": str(self.partitions)}
        return self.load(spark, options)

    def marks(self, df: DataFrame, schema: str, table: str, mark: str) -> Marks:
        """Fixed before staging: rows written to the database later have to wait for the next load."""
        answer = self._ask(df.sparkSession, self.marks_query(schema, table, mark))
        zoned = isinstance(answer.schema["top"].dataType, T.TimestampType)
        top = F.unix_micros("top") if zoned else F.col("top").cast("timestamp_ntz")
        found = answer.select(top.alias("top"), "all_rows", "marked").first()
        return Marks(as_utc(found["top"]), int(found["all_rows"]), int(found["all_rows"] - found["marked"]))


def _sql_name(*parts: str) -> str:
    return ".".join('"' + p.replace('"', '""') + '"' for p in parts)


@dataclass(frozen=True)
class Frames:
    """Named DataFrames, made when read."""

    frames: Mapping[tuple[str, str], Callable[[], DataFrame]]

    def read(self, spark: SparkSession, schema: str, table: str) -> DataFrame:
        make = self.frames.get((schema, table))
        if make is None:
            raise LoadError(50012)
        return make()


@dataclass(frozen=True)
class Sources:
    """Connections by the reference a configuration row names."""

    spark: SparkSession
    connections: Mapping[str, Connection]
    default: Connection = CatalogTables()

    def _connection(self, reference: str | None) -> Connection:
        if reference is not None and reference not in self.connections:
            raise LoadError(None, f"Unknown connection reference {reference!r}.")
        return self.default if reference is None else self.connections[reference]

    def declared(self, schema: str, table: str, reference: str | None = None) -> list[Declared]:
        """The columns of a table as its connection declares them, where it does."""
        ask = getattr(self._connection(reference), "declared", None)
        return ask(self.spark, schema, table) if ask else []

    def marks(self, df: DataFrame, schema: str, table: str, mark: str, reference: str | None = None) -> Marks | None:
        """The marks of a table that was read as ``df``, where its connection can tell them."""
        ask = getattr(self._connection(reference), "marks", None)
        return ask(df, schema, table, mark) if ask else None

    def read(self, schema: str, table: str, reference: str | None = None) -> DataFrame:
        connection = self._connection(reference)
        try:
            return connection.read(self.spark, schema, table)
        except AnalysisException as error:
            if error.getCondition() in _ABSENT:
                raise LoadError(50012) from error
            raise


def column_catalog(spark: SparkSession, tables: Mapping[str, DataFrame]) -> DataFrame:
    """Ordered column metadata of many tables as a frame: (table, ordinal, name, type, nullable)."""
    rows = [
        (name, i, f.name, render_type(f), f.nullable)
        for name, df in tables.items()
        for i, f in enumerate(df.schema.fields, start=1)
    ]
    return spark.createDataFrame(
        rows, "table string, ordinal int, name string, type string, nullable boolean"
    )
