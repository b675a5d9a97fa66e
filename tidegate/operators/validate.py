"""Configuration and log rules. Each returns (rule, offending); zero means it holds."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.state import vocabulary as v


def _counts(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Rows that break each rule, all rules of one table in a single pass."""
    sums = [F.count(F.when(bad, 1)).alias(f"r{i}") for i, bad in enumerate(rules.values())]
    rows = [
        F.struct(F.lit(name).alias("rule"), F.col(f"r{i}").alias("offending"))
        for i, name in enumerate(rules)
    ]
    return df.agg(*sums).select(F.inline(F.array(*rows)))


def _repeated(df: DataFrame, rule: str, keys: list[str]) -> DataFrame:
    """Key groups with more than one row."""
    groups = df.groupBy(*keys).agg(F.count("*").alias("n"))
    return groups.agg(
        F.lit(rule).alias("rule"), F.count(F.when(F.col("n") > 1, 1)).alias("offending")
    )


def _lost(rows: str) -> Column:
    """A child key's rows when it has no parent; a NULL key refers to nothing and is allowed."""
    return F.when(F.col("_has_key") & F.col("_parent").isNull(), F.col(rows)).otherwise(0)


def _per_parent(groups: DataFrame, parent: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """All rules of a log that is grouped by its parent's key: one pass, each key joined once."""
    key = parent.columns[0]
    known = parent.distinct().withColumn("_parent", F.lit(True))
    joined = groups.join(known, key, "left").withColumn("_has_key", F.col(key).isNotNull())
    totals = [F.coalesce(F.sum(bad), F.lit(0)).cast("bigint").alias(name) for name, bad in rules.items()]
    rows = [F.struct(F.lit(name).alias("rule"), F.col(name).alias("offending")) for name in rules]
    return joined.agg(*totals).select(F.inline(F.array(*rows)))


def _outside(column: str, *allowed: str) -> Column:
    return F.col(column).isNull() | ~F.col(column).isin(*allowed)


def _stack(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def validate_config(config: DataFrame) -> DataFrame:
    """Rules of the configuration table, with the three scenario assertions."""
    per_row = {
        "LOAD_DOMAIN": _outside("Load", v.YES, v.NO),
        "LOAD_TYPE_DOMAIN": _outside("LoadType", v.FULL, v.WATERMARK),
        "WATERMARK_NEEDS_COLUMN": (F.col("LoadType") == v.WATERMARK)
        & F.col("WatermarkColumn").isNull(),
    }

    def absent(code: int, load: str) -> DataFrame:
        have = F.count(F.when(F.col("Load") == load, 1))
        return config.agg(
            F.lit(str(code)).alias("rule"),
            F.when(have == 0, 1).otherwise(0).cast("bigint").alias("offending"),
        )

    invalid = {"51003": per_row["WATERMARK_NEEDS_COLUMN"]}
    return _stack(
        [
            _counts(config, {**per_row, **invalid}),
            _repeated(config, "UNIQUE_SOURCE", ["SourceSchema", "SourceTable"]),
            absent(51001, v.YES),
            absent(51002, v.NO),
        ]
    )


def validate_logs(
    config: DataFrame,
    runs: DataFrame,
    attempts: DataFrame,
    checks: DataFrame,
    requests: DataFrame,
    history: DataFrame,
) -> DataFrame:
    """Uniqueness, reference and domain rules of the audit and approval logs."""
    cfg, attempt = "ConfigId", "TableLoadAuditId"
    configs, ids = config.select(cfg), attempts.select(attempt)
    by_version = history.groupBy(cfg, "SchemaVersion").agg(F.count("*").alias("n"))
    return _stack(
        [
            _repeated(runs, "UNIQUE_RUN", ["AdfPipelineRunId"]),
            _repeated(checks, "UNIQUE_CHECK", ["ReconciliationResultId"]),
            _per_parent(
                by_version.groupBy(cfg).agg(F.sum("n").alias("n"), F.count_if(F.col("n") > 1).alias("twice")),
                configs,
                {"VERSION_CONFIG": _lost("n"), "UNIQUE_VERSION": F.col("twice")},
            ),
            _per_parent(
                requests.groupBy(cfg).agg(
                    F.count("*").alias("n"),
                    F.count_if(F.col("Status") == v.PENDING).alias("open"),
                    F.count_if(_outside("Status", v.PENDING, v.APPROVED, v.REJECTED)).alias("odd"),
                ),
                configs,
                {
                    "REQUEST_CONFIG": _lost("n"),
                    "ONE_PENDING_REQUEST": (F.col("open") > 1).cast("bigint"),
                    "REQUEST_STATUS_DOMAIN": F.col("odd"),
                },
            ),
            _per_parent(
                attempts.groupBy(cfg).agg(F.count("*").alias("n")), configs, {"ATTEMPT_CONFIG": _lost("n")}
            ),
            _per_parent(
                checks.groupBy(attempt).agg(
                    F.count("*").alias("n"), F.count_if(_outside("Result", v.PASS, v.WARNING, v.FAIL)).alias("odd")
                ),
                ids,
                {"CHECK_ATTEMPT": _lost("n"), "RESULT_DOMAIN": F.col("odd")},
            ),
        ]
    )
