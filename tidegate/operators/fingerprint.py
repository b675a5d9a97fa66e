"""Schema fingerprints, drift between column sets, and compatibility.

One table's schema is driver metadata, so :func:`fingerprint` works on a StructType.
The set-based forms take a frame with one row per (config, column) and serve a catalog
of any size in one aggregate.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.functions.text import concat0, sha256_hex
from tidegate.state import vocabulary as v

# the declared length of char and varchar columns survives in this field metadata key
DECLARED_TYPE = "__CHAR_VARCHAR_TYPE_STRING"


@dataclass(frozen=True)
class Fingerprint:
    columns: list[str]
    definition: str
    hash: str


@dataclass(frozen=True)
class Declared:
    """A column as its source declares it; a DataFrame's types know no scale of times and lose lengths."""

    name: str
    type: str
    nullable: bool


def declared_type(
    kind: str, length: int | None = None, precision: int | None = None, scale: int | None = None, time_scale: int | None = None
) -> str:
    """One text for the columns in which an information schema describes a type."""
    kind = kind.lower()
    if length is not None:
        return f"{kind}({'max' if length < 0 else length})"
    if kind in ("decimal", "numeric"):
        return f"{kind}({precision},{scale or 0})" if precision is not None else kind
    if time_scale is not None and kind != "date":
        return f"{kind}({time_scale})"
    return kind


def render_type(field: T.StructField) -> str:
    return (field.metadata or {}).get(DECLARED_TYPE) or field.dataType.simpleString()


def _escape(name: str) -> str:
    return name.replace("\\", "\\\\").replace(":", "\\:").replace("|", "\\|")


def fingerprint(schema: T.StructType, charset: str = "utf-8", declared: list[Declared] | None = None) -> Fingerprint:
    """Columns in order, ``name:type:nullable`` joined by ``|``, and its SHA-256.

    What the source declares of a column goes before what the DataFrame says of it.
    """
    known = {d.name.lower(): d for d in declared or []}
    columns = [
        known.get(f.name.lower()) or Declared(f.name, render_type(f), f.nullable) for f in schema.fields
    ]
    definition = "|".join(
        f"{_escape(f.name)}:{d.type}:{int(d.nullable)}" for f, d in zip(schema.fields, columns)
    )
    digest = hashlib.sha256(definition.encode(charset)).hexdigest().upper()
    return Fingerprint(schema.fieldNames(), definition, digest)


def fingerprint_columns(
    columns: DataFrame, keys: list[str], charset: str = "UTF-8"
) -> DataFrame:
    """The same fingerprint for every table of a column catalog.

    ``columns`` has the keys plus ordinal, name, type and optionally nullable. A group
    is one table's column list, so it is bounded by the width of a table.
    """
    nullable = F.col("nullable").cast("int") if "nullable" in columns.columns else F.lit(1)
    name = F.regexp_replace("name", r"([\\:|])", r"\\$1")
    entry = concat0(name, F.lit(":"), F.col("type"), F.lit(":"), nullable)
    ordered = F.sort_array(F.collect_list(F.struct(F.col("ordinal"), entry.alias("entry"))))
    definition = F.array_join(F.transform(ordered, lambda c: c["entry"]), "|")
    return columns.groupBy(*keys).agg(definition.alias("SchemaDefinition")).withColumn(
        "SchemaHash", sha256_hex("SchemaDefinition", charset)
    )


def missing_names(approved: list[str], current: list[str]) -> list[str]:
    """Approved names the current schema lacks (names match without case)."""
    have = {c.lower() for c in current}
    return [c for c in approved if c.lower() not in have]


def compatibility(approved: list[str], current: list[str]) -> str:
    """Only names decide: a retyped column still allows the old projection."""
    return v.BREAKING if missing_names(approved, current) else v.OLD_PROJECTION_SAFE


def _sides(columns: DataFrame) -> DataFrame:
    """One row per (config, column) with both sides' type and ordinal; a side names a column once."""

    def side(name: str, prefix: str) -> DataFrame:
        return columns.filter(F.col("side") == name).select(
            "ConfigId",
            F.lower("name").alias("name"),
            F.col("type").alias(f"{prefix}_type"),
            F.col("ordinal").alias(f"{prefix}_ordinal"),
        )

    return side("approved", "old").join(side("current", "new"), ["ConfigId", "name"], "full_outer")


def schema_diff(columns: DataFrame) -> DataFrame:
    """Changed columns per config: added, removed, retyped or moved."""
    change = (
        F.when(F.col("old_ordinal").isNull(), "added")
        .when(F.col("new_ordinal").isNull(), "removed")
        .when(F.col("old_type") != F.col("new_type"), "retyped")
        .when(F.col("old_ordinal") != F.col("new_ordinal"), "moved")
    )
    return (
        _sides(columns)
        .withColumn("change", change)
        .filter(F.col("change").isNotNull())
        .select(
            "ConfigId", "name", "change", "old_type", "new_type", "old_ordinal", "new_ordinal"
        )
    )


def missing_columns(columns: DataFrame) -> DataFrame:
    """Per config: number of approved columns gone, and what that means for the load."""
    gone = F.col("old_ordinal").isNotNull() & F.col("new_ordinal").isNull()
    per_config = _sides(columns).groupBy("ConfigId").agg(F.count(F.when(gone, 1)).alias("Missing"))
    verdict = F.when(F.col("Missing") > 0, v.BREAKING).otherwise(v.OLD_PROJECTION_SAFE)
    return per_config.withColumn("Compatibility", verdict)
