"""Approved-column projection and additive schema evolution."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.functions.text import quoted


def by_name(schema: T.StructType) -> dict[str, T.StructField]:
    """Fields under their lower-cased names: column names match without case."""
    return {f.name.lower(): f for f in schema.fields}


def project(df: DataFrame, approved: Iterable[str]) -> DataFrame:
    """Exactly the approved columns, in approved order."""
    return df.select([F.col(quoted(c)).alias(c) for c in approved])


def evolve(target: T.StructType, incoming: T.StructType) -> T.StructType:
    """Target fields unchanged, plus incoming fields it lacks, all nullable."""
    known = by_name(target)
    extra = [f for f in incoming.fields if f.name.lower() not in known]
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in [*target.fields, *extra]])


def align(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Shape ``df`` to ``schema``: cast to the pinned types, typed NULL where absent."""
    have = by_name(df.schema)
    columns = []
    for field in schema.fields:
        found = have.get(field.name.lower())
        source = F.lit(None) if found is None else F.col(quoted(found.name))
        if found is None or found.dataType != field.dataType:
            source = source.cast(field.dataType)
        columns.append(source.alias(field.name))
    return df.select(columns)
