"""Control-table lookups and the latest-by-key fold."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LOOKUP_COLUMNS = [
    "ConfigId",
    "SourceSchema",
    "SourceTable",
    "TargetSchema",
    "TargetTable",
    "LoadType",
    "WatermarkColumn",
    "PrimaryKeyColumn",
    "RetryCount",
    "RetryIntervalSeconds",
]


def enabled_configs(config: DataFrame) -> DataFrame:
    """The rows a run loads, in ConfigId order."""
    return config.filter(F.col("Load") == "Yes").select(LOOKUP_COLUMNS).orderBy("ConfigId")


def latest_by(
    df: DataFrame, keys: Iterable[str], order_col: str, value_cols: Iterable[str]
) -> DataFrame:
    """The values of the row with the highest ``order_col`` per key."""
    keys, value_cols = list(keys), list(value_cols)
    found = newest_rows(df, keys, order_col)
    return found.select(*keys, *[c for c in value_cols if c not in keys])


def newest_rows(df: DataFrame, keys: list[str], order_col: str) -> DataFrame:
    """The row with the highest ``order_col`` per key; ``order_col`` is unique.

    Only numbers are aggregated, so it is done by hashing and on the map side first: a key
    that holds a large share of the log shuffles one number per map task, and no text is
    sorted. The rows are then fetched by their unique number.
    """
    newest = df.groupBy(*keys).agg(F.max(order_col).alias("_newest")).select("_newest")
    return df.join(newest, F.col(order_col) == F.col("_newest"), "left_semi")


def latest_pending_request(requests: DataFrame) -> DataFrame:
    """The one pending request with the highest id over all configurations."""
    return (
        requests.filter(F.col("Status") == "PENDING")
        .orderBy(F.desc("SchemaChangeRequestId"))
        .limit(1)
    )


def evidence(df: DataFrame, label: str, id_col: str, descending: bool = True) -> DataFrame:
    """A whole log under an evidence label, ordered by id."""
    order = F.desc(id_col) if descending else F.asc(id_col)
    return df.select(F.lit(label).alias("Evidence"), "*").orderBy(order)
