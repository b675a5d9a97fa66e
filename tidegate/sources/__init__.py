"""Where configured source tables are read from."""

from tidegate.sources.reader import (
    CatalogTables,
    Frames,
    JdbcDatabase,
    ParquetFolder,
    Sources,
    column_catalog,
)
from tidegate.sources.marks import Marks

__all__ = [
    "CatalogTables",
    "Frames",
    "JdbcDatabase",
    "Marks",
    "ParquetFolder",
    "Sources",
    "column_catalog",
]
