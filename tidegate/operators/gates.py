"""Reconciliation gates: key profiles and long-form check rows.

A profile of integer keys in a dense range shuffles bitmaps. Any other is one shuffle of the key column alone, with counts combined on the map
side first, so a key that repeats in a third of all rows costs one row per map task.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.functions.text import quoted
from tidegate.operators.keys import key_column
from tidegate.state import vocabulary as v


def _total(amount: Column) -> Column:
    return F.coalesce(F.sum(amount), F.lit(0).cast("bigint"))


def key_profile(df: DataFrame, key: str, collation: str | None = None) -> DataFrame:
    """One row: rows, duplicate_keys (key groups above one), null_keys, key_bytes.

    NULL keys form one group, so several of them count as one duplicate.
    """
    k = F.col("k")
    data_type = df.schema[key].dataType
    if isinstance(data_type, (T.StringType, T.BinaryType)):
        width = F.coalesce(F.octet_length(k), F.lit(0)) + 16
    else:  # a nested key has no measured size, so it counts as too large for any broadcast
        nested = isinstance(data_type, (T.StructType, T.ArrayType, T.MapType, T.VariantType))
        width = F.lit(1 << 40 if nested else 16)
    groups = df.groupBy(key_column(df, key, collation).alias("k")).agg(F.count("*").alias("n"))
    return groups.agg(
        _total(F.col("n")).alias("rows"),
        F.count(F.when(F.col("n") > 1, 1)).alias("duplicate_keys"),
        _total(F.when(k.isNull(), F.col("n"))).alias("null_keys"),
        _total(F.col("n") * width).alias("key_bytes"),
    )


# --- integer keys: uniqueness from bitmaps ----------------------------------------

PAGE = 32768  # keys of one bitmap, which has a bit for each
_INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_ROW_BYTES = 16  # of a key and its count, as the plain profile shuffles them


@dataclass(frozen=True)
class KeyRange:
    """Rows, smallest and largest key, as the job that wrote the rows saw them, and in how many files they lie."""

    rows: int
    low: int | None
    high: int | None
    files: int


def key_range_columns(df: DataFrame, key: str) -> dict[str, Column]:
    """What a writing job has to observe for a ``KeyRange``; nothing where the key is no integer."""
    if not isinstance(df.schema[key].dataType, _INTEGERS):
        return {}
    return {"low": F.min(quoted(key)).cast("bigint"), "high": F.max(quoted(key)).cast("bigint")}


def bitmaps_pay(found: KeyRange) -> bool:
    """Whether bitmaps of every file's keys are fewer bytes than the keys, were every file to hit every page."""
    if found.low is None:
        return False
    pages = found.high // PAGE - found.low // PAGE + 2
    return found.files * pages * (PAGE // 8) <= found.rows * _ROW_BYTES


def integer_profile(df: DataFrame, key: str) -> DataFrame:
    """One row: rows, distinct_keys, null_keys. Bitmaps are shuffled, a page of keys in each; no keys are."""
    k = F.col(quoted(key)).cast("bigint")
    pages = df.groupBy(F.bitmap_bucket_number(k).alias("page")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(k)).alias("bits"), F.count("*").alias("n")
    )
    known = F.col("page").isNotNull()
    return pages.agg(
        _total(F.col("n")).alias("rows"),
        _total(F.when(known, F.bitmap_count("bits"))).alias("distinct_keys"),
        _total(F.when(~known, F.col("n"))).alias("null_keys"),
    )


def measured_profile(df: DataFrame, key: str, found: KeyRange | None = None, collation: str | None = None) -> Row:
    """The row of ``key_profile``, by the cheaper way.

    As many different keys as rows prove that none repeats; otherwise the plain profile counts
    which do. Bitmaps are tried where the key's range is known and dense enough for them.
    """
    if found is not None and bitmaps_pay(found):
        p = integer_profile(df, key).first()
        if p["distinct_keys"] == p["rows"] - p["null_keys"]:
            return Row(
                rows=p["rows"],
                duplicate_keys=int(p["null_keys"] > 1),
                null_keys=p["null_keys"],
                key_bytes=p["rows"] * _ROW_BYTES,
            )
    return key_profile(df, key, collation).first()


def reconcile(
    stage: DataFrame, target: DataFrame, key: str, bucket: Column | None = None, collation: str | None = None
) -> DataFrame:
    """Compare staged with published keys in one shuffle, without a join.

    Both key columns are tagged, stacked and counted per key. A staged row is missing
    when no target row carries its key; a NULL key is always missing. With ``bucket``
    (a function of the key) the result has one row per bucket instead of one in all.
    """
    k = F.col("k")

    def tagged(df: DataFrame, staged: int) -> DataFrame:
        return df.select(
            key_column(df, key, collation).alias("k"),
            F.lit(staged).cast("bigint").alias("s"),
            F.lit(1 - staged).cast("bigint").alias("t"),
        )

    both = tagged(stage, 1).unionAll(tagged(target, 0))
    counts = both.groupBy("k").agg(F.sum("s").alias("s"), F.sum("t").alias("t"))
    totals = [
        _total(F.col("s")).alias("stage_rows"),
        _total(F.col("t")).alias("target_rows"),
        F.count(F.when(F.col("t") > 1, 1)).alias("duplicate_keys"),
        _total(F.when(k.isNull(), F.col("t"))).alias("null_keys"),
        _total(F.when(k.isNull() | (F.col("t") == 0), F.col("s"))).alias("missing_keys"),
    ]
    if bucket is None:
        return counts.agg(*totals)
    return counts.groupBy(bucket.alias("bucket")).agg(*totals)


def check_rows(one_row: DataFrame, stage: str, specs: list[tuple[str, Column, Column]]) -> DataFrame:
    """Unfold (check, expected, actual) triples of a one-row frame into check rows."""
    rows = [
        F.struct(
            F.lit(stage).alias("GateStage"),
            F.lit(name).alias("CheckName"),
            expected.cast("string").alias("ExpectedValue"),
            actual.cast("string").alias("ActualValue"),
            F.when(expected == actual, v.PASS).otherwise(v.FAIL).alias("Result"),
            F.lit(v.DETAILS[stage, name]).alias("Details"),
        )
        for name, expected, actual in specs
    ]
    return one_row.select(F.inline(F.array(*rows)))


def gate1_specs(source: Column, rows: Column, duplicates: Column, nulls: Column, missing: Column):
    zero = F.lit(0)
    return [
        (v.SOURCE_STAGE_ROW_COUNT, source, rows),
        (v.DUPLICATE_PRIMARY_KEY, zero, duplicates),
        (v.NULL_PRIMARY_KEY, zero, nulls),
        (v.APPROVED_SCHEMA, zero, missing),
    ]


def gate2_specs(
    staged: Column, rows: Column, duplicates: Column, nulls: Column, missing: Column, full: bool
):
    zero = F.lit(0)
    specs = [
        (v.STAGE_KEYS_PUBLISHED, zero, missing),
        (v.DUPLICATE_PRIMARY_KEY, zero, duplicates),
        (v.NULL_PRIMARY_KEY, zero, nulls),
    ]
    return [*specs, (v.FULL_ROW_COUNT, staged, rows)] if full else specs


def gate1(
    source_window: DataFrame, stage: DataFrame, key: str, missing: int = 0, collation: str | None = None
) -> DataFrame:
    """Four pre-publish checks of a staged window."""
    source = source_window.agg(F.count("*").alias("source_rows"))
    # two one-row frames folded by an aggregate: no join, one job
    both = key_profile(stage, key, collation).unionByName(source, allowMissingColumns=True)
    names = ["source_rows", "rows", "duplicate_keys", "null_keys"]
    profile = both.agg(*[F.max(n).alias(n) for n in names])
    specs = gate1_specs(*[F.col(n) for n in names], F.lit(missing))
    return check_rows(profile, v.GATE_1, specs)


def gate2(
    stage: DataFrame, target: DataFrame, key: str, full: bool, collation: str | None = None
) -> DataFrame:
    """Post-publish checks: three for an upsert, four for a full replace."""
    names = ["stage_rows", "target_rows", "duplicate_keys", "null_keys", "missing_keys"]
    specs = gate2_specs(*[F.col(n) for n in names], full)
    return check_rows(reconcile(stage, target, key, collation=collation), v.GATE_2, specs)


def gate1_of(
    spark: SparkSession, source: int, rows: int, duplicates: int, nulls: int, missing: int
) -> DataFrame:
    """Gate 1 of counts that are known already."""
    specs = gate1_specs(*map(F.lit, (source, rows, duplicates, nulls, missing)))
    return check_rows(spark.sql("SELECT 1 AS one"), v.GATE_1, specs)


def gate2_of(
    spark: SparkSession, staged: int, rows: int, duplicates: int, nulls: int, missing: int, full: bool
) -> DataFrame:
    """Gate 2 of counts that are known already."""
    specs = gate2_specs(*map(F.lit, (staged, rows, duplicates, nulls, missing)), full)
    return check_rows(spark.sql("SELECT 1 AS one"), v.GATE_2, specs)


def any_failed(checks: DataFrame | list[Row]) -> bool:
    """Whether a gate stops the load; of its check rows, or of those already at hand."""
    if isinstance(checks, DataFrame):
        return not checks.filter(F.col("Result") == v.FAIL).isEmpty()
    return any(row["Result"] == v.FAIL for row in checks)
