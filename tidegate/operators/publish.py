"""Publish operators as pure DataFrame transformations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.functions.text import quoted
from tidegate.operators.gates import key_profile
from tidegate.operators.keys import key_column
from tidegate.operators.projection import align, by_name, evolve
from tidegate.state.vocabulary import LoadError


def overwrite(target: DataFrame, stage: DataFrame) -> DataFrame:
    """Replace all rows; columns the stage no longer carries stay, as NULL."""
    return align(stage, evolve(target.schema, stage.schema))


def _keys(df: DataFrame, keys: list[str], collation: str | None = None) -> DataFrame:
    """Each key once. Map tasks drop repeats, so a key that fills a third of the rows does
    not fill one join task; the join then uses the same partitioning."""
    return df.select([key_column(df, k, collation).alias(k) for k in keys]).distinct()


def _without(df: DataFrame, others: DataFrame, key: str, collation: str | None) -> DataFrame:
    """Rows whose key is not among ``others`` (of the same key column)."""
    if collation is None:
        return df.join(others, key, "left_anti")
    own = key_column(df, key, collation)
    renamed = others.select(F.col(quoted(key)).alias("_other"))
    return df.join(renamed, own == F.col("_other"), "left_anti")


def unpublished(stage: DataFrame, target: DataFrame, key: str, collation: str | None = None) -> DataFrame:
    """Staged rows whose key the target lacks; a NULL key is never found."""
    return _without(stage, _keys(target, [key], collation), key, collation)


def survivors(
    target: DataFrame, stage: DataFrame, key: str, small_stage: bool = False, collation: str | None = None
) -> DataFrame:
    """Target rows whose key is not staged.

    The staged side is reduced to its key. ``small_stage`` asks for a broadcast and is
    only for callers that have measured the staged keys; otherwise the join strategy
    is left to the optimizer and adaptive execution, which splits a skewed target side.
    """
    if small_stage:
        staged = F.broadcast(stage.select(key_column(stage, key, collation).alias(key)))
    else:
        staged = _keys(stage, [key], collation)
    return _without(target, staged, key, collation)


def upsert(target: DataFrame, stage: DataFrame, key: str, collation: str | None = None) -> DataFrame:
    """Keyed replace: surviving target rows plus every staged row, schemas aligned."""
    schema = evolve(target.schema, stage.schema)
    staged = align(stage, schema)
    # key first in the join output, so select by schema order again
    kept = align(survivors(target, staged, key, collation=collation), schema)
    return kept.unionByName(staged)


def require_unique_key(source: DataFrame, key: str, collation: str | None = None) -> DataFrame:
    """Fail when a key repeats: a merge may touch each target row once. A NULL key matches nothing."""
    name = by_name(source.schema)[key.lower()].name
    known = source.filter(F.col(quoted(name)).isNotNull())
    repeated = key_profile(known, name, collation).first()["duplicate_keys"]
    if repeated:
        raise LoadError(None, f"Merge source has {repeated} repeated key value(s) in {key}.")
    return source


def merge(target: DataFrame, source: DataFrame, key: str, collation: str | None = None) -> DataFrame:
    """Match on key: update the source's columns; no match: insert.

    Columns that only the target has keep their values in matched rows and are NULL in new ones.
    A matched row takes the source's spelling of the key, as it takes its other columns.
    """
    require_unique_key(source, key, collation)
    old, new = by_name(target.schema), by_name(source.schema)
    ours = key_column(target, old[key.lower()].name, collation, F.col("_t"))
    match = ours == key_column(source, new[key.lower()].name, collation, F.col("_s"))
    sides = target.select(F.struct("*").alias("_t")).join(
        source.select(F.struct("*").alias("_s")), match, "full_outer"
    )

    def value(field: T.StructField):
        kept, given = old.get(field.name.lower()), new.get(field.name.lower())
        before = F.lit(None) if kept is None else F.col("_t")[kept.name]
        if given is None:
            return before
        return F.when(F.col("_s").isNotNull(), F.col("_s")[given.name].cast(field.dataType)).otherwise(before)

    schema = evolve(target.schema, source.schema)
    return sides.select([value(f).cast(f.dataType).alias(f.name) for f in schema.fields])


def insert_absent(existing: DataFrame, new: DataFrame, key: list[str] | str) -> DataFrame:
    """The new rows whose natural key does not exist yet."""
    keys = [key] if isinstance(key, str) else list(key)
    return new.join(_keys(existing, keys), keys, "left_anti").select([F.col(quoted(c)) for c in new.columns])
