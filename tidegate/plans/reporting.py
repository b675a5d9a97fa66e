"""Reporting marts: one function per view, log DataFrames in, the view's columns out.

Small control frames carry no broadcast hint: adaptive execution broadcasts them by
measured size and splits skewed log sides. Where a log meets two tables, the narrower log
is widened first, so the largest log crosses the network once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.functions.clock import seconds_between
from tidegate.functions.text import object_name, quotename
from tidegate.operators.attempts import attempt_numbers
from tidegate.state import vocabulary as v


def _source():
    return object_name("SourceSchema", "SourceTable").alias("SourceObject")


def _target():
    return object_name("TargetSchema", "TargetTable").alias("TargetObject")


def _duration():
    return seconds_between("StartedUtc", "CompletedUtc").alias("DurationSeconds")


def _named_configs(config: DataFrame) -> DataFrame:
    return config.select("ConfigId", _source())


def _run_starts(runs: DataFrame) -> DataFrame:
    return runs.select("AdfPipelineRunId", F.col("StartedUtc").alias("RunStartedUtc"))


def pipeline_health(config: DataFrame, requests: DataFrame, attempts: DataFrame) -> DataFrame:
    """Per configuration: masked status, open requests, last successful completion."""
    pending = (
        requests.filter(F.col("Status") == v.PENDING)
        .groupBy("ConfigId")
        .agg(F.count("*").alias("_pending"))
    )
    completed = (
        attempts.filter(F.col("Status") == v.SUCCESS)
        .groupBy("ConfigId")
        .agg(F.max("CompletedUtc").alias("LastCompletedUtc"))
    )
    status = F.when(F.col("Load") == v.NO, v.SKIPPED_LABEL).otherwise(F.col("LastRunStatus"))
    return (
        config.join(pending, "ConfigId", "left")
        .join(completed, "ConfigId", "left")
        .select(
            "ConfigId",
            _source(),
            _target(),
            "Load",
            "LoadType",
            status.alias("LastRunStatus"),
            "LastSuccessfulRunUtc",
            "ApprovedSchemaVersion",
            F.coalesce("_pending", F.lit(0).cast("bigint")).alias("PendingSchemaChanges"),
            "LastCompletedUtc",
        )
    )


def reconciliation_summary(attempts: DataFrame, checks: DataFrame) -> DataFrame:
    return (
        attempts.withColumnRenamed("Status", "LoadStatus")
        .join(checks, "TableLoadAuditId")
        .select(
            "AdfPipelineRunId",
            "ConfigId",
            "SourceObject",
            "TargetObject",
            "LoadStatus",
            "GateStage",
            "CheckName",
            "Result",
            "ExpectedValue",
            "ActualValue",
            "Details",
            "CheckedUtc",
        )
    )


def recent_pipeline_runs(runs: DataFrame) -> DataFrame:
    return runs.select(
        "PipelineRunAuditId",
        "AdfPipelineRunId",
        "PipelineName",
        "StartedUtc",
        "CompletedUtc",
        _duration(),
        "Status",
        "EnabledTableCount",
        "SuccessfulTableCount",
        "FailedTableCount",
        "Message",
    )


def recent_table_loads(attempts: DataFrame) -> DataFrame:
    return attempts.select(
        "TableLoadAuditId",
        "AdfPipelineRunId",
        "ConfigId",
        "SourceObject",
        "TargetObject",
        "LoadType",
        "IsFirstLoad",
        "SchemaChangeDetected",
        "SchemaApprovalStatus",
        "StartedUtc",
        "CompletedUtc",
        _duration(),
        "SourceRowCount",
        "TargetRowCount",
        "RowsInserted",
        "RowsUpdated",
        "Status",
        "ErrorMessage",
    )


def dashboard_summary(
    config: DataFrame,
    runs: DataFrame,
    attempts: DataFrame,
    checks: DataFrame,
    requests: DataFrame,
) -> DataFrame:
    """Thirteen metrics in one row, one pass per log.

    Attempts are grouped once: the groups give the retries and carry the sum of rows along.
    """

    def rows(condition):
        return F.count(F.when(condition, 1))

    status = F.col("Status")
    seconds = seconds_between("StartedUtc", "CompletedUtc").cast("decimal(18,2)")
    processed = F.when(status == v.SUCCESS, F.coalesce("SourceRowCount", F.lit(0).cast("bigint")))
    parts = [
        config.agg(
            F.count("*").alias("TotalConfiguredTables"),
            rows(F.col("Load") == v.YES).alias("EnabledTables"),
        ),
        runs.agg(
            rows(status == v.SUCCESS).alias("SuccessfulRuns"),
            rows(status.isin(v.FAILURE, v.PARTIAL_SUCCESS)).alias("FailedOrPartialRuns"),
            F.max(F.when(status == v.SUCCESS, F.col("CompletedUtc"))).alias("LastSuccessfulRunUtc"),
            F.avg(F.when(F.col("CompletedUtc").isNotNull(), seconds))
            .cast("decimal(18,2)")
            .alias("AverageDurationSeconds"),
        ),
        attempts.groupBy("AdfPipelineRunId", "ConfigId")
        .agg(F.sum(processed).alias("rows"), (F.count("*") - 1).alias("retries"))
        .agg(
            F.coalesce(F.sum("rows"), F.lit(0).cast("bigint")).alias("RowsProcessed"),
            F.coalesce(F.sum("retries"), F.lit(0).cast("bigint")).alias("TotalRetryAttempts"),
        ),
        requests.agg(
            F.count("*").alias("SchemaChangesDetected"),
            rows(status == v.PENDING).alias("PendingSchemaChanges"),
            rows(status == v.APPROVED).alias("ApprovedSchemaChanges"),
            rows(status == v.REJECTED).alias("RejectedSchemaChanges"),
        ),
        checks.agg(rows(F.col("Result") == v.FAIL).alias("ReconciliationFailures")),
    ]
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part, allowMissingColumns=True)
    # one-row frames stacked and folded: every part fills its own columns once
    names = [
        "TotalConfiguredTables",
        "EnabledTables",
        "SuccessfulRuns",
        "FailedOrPartialRuns",
        "RowsProcessed",
        "LastSuccessfulRunUtc",
        "SchemaChangesDetected",
        "PendingSchemaChanges",
        "ApprovedSchemaChanges",
        "RejectedSchemaChanges",
        "ReconciliationFailures",
        "TotalRetryAttempts",
        "AverageDurationSeconds",
    ]
    return stacked.agg(*[F.max(n).alias(n) for n in names])


def schema_change_requests(requests: DataFrame, config: DataFrame) -> DataFrame:
    return requests.join(_named_configs(config), "ConfigId").select(
        F.col("SchemaChangeRequestId").alias("RequestId"),
        "SourceObject",
        "DetectedUtc",
        "ChangeSummary",
        "Compatibility",
        "Status",
        "DecisionBy",
        "DecisionUtc",
        "DecisionNotes",
    )


def schema_version_history(history: DataFrame, config: DataFrame) -> DataFrame:
    """Approved versions; a list of column names renders as bracketed text."""
    columns = F.col("ColumnList")
    if isinstance(history.schema["ColumnList"].dataType, T.ArrayType):
        columns = F.array_join(F.transform(columns, quotename), ",")
    return history.join(_named_configs(config), "ConfigId").select(
        "SourceObject",
        "SchemaVersion",
        "ApprovalStatus",
        "ApprovedBy",
        "ApprovedUtc",
        columns.alias("ColumnList"),
    )


def reconciliation_results(checks: DataFrame, attempts: DataFrame, runs: DataFrame) -> DataFrame:
    label = F.col("GateStage")
    for stage, text in v.GATE_LABELS.items():
        label = F.when(F.col("GateStage") == stage, text).otherwise(label)
    started = attempts.select("TableLoadAuditId", "AdfPipelineRunId", "SourceObject").join(
        _run_starts(runs), "AdfPipelineRunId", "left"
    )
    return checks.join(started, "TableLoadAuditId").select(
        "AdfPipelineRunId",
        "RunStartedUtc",
        "SourceObject",
        label.alias("GateLabel"),
        "CheckName",
        "ExpectedValue",
        "ActualValue",
        "Result",
    )


def table_load_detail(attempts: DataFrame, runs: DataFrame) -> DataFrame:
    return (
        attempt_numbers(attempts)
        .join(_run_starts(runs), "AdfPipelineRunId", "left")
        .select(
            "AdfPipelineRunId",
            "RunStartedUtc",
            "SourceObject",
            "LoadType",
            "IsFirstLoad",
            "SchemaChangeDetected",
            "SchemaApprovalStatus",
            "AttemptNumber",
            "SourceRowCount",
            "TargetRowCount",
            "Status",
            "ErrorMessage",
        )
    )


def notification_events(notifications: DataFrame, config: DataFrame) -> DataFrame:
    names = config.select("ConfigId", "SourceSchema", "SourceTable")
    return notifications.join(names, "ConfigId", "left").select(
        "AdfPipelineRunId", _source(), "EventType", "DeliveryStatus", "Message", "CreatedUtc"
    )


def headline_cards(summary: DataFrame) -> DataFrame:
    """The headline measures over the one-row summary, and the retry card."""
    measures = [
        "TotalConfiguredTables",
        "EnabledTables",
        "SuccessfulRuns",
        "FailedOrPartialRuns",
        "RowsProcessed",
        "PendingSchemaChanges",
        "ReconciliationFailures",
        "AverageDurationSeconds",
    ]
    return summary.agg(
        *[F.max(m).alias(m) for m in measures],
        F.sum("TotalRetryAttempts").alias("TotalRetryAttempts"),
    )


def recent_runs_table(runs: DataFrame) -> DataFrame:
    """Every run, newest start first; the id settles ties and splits a busy instant."""
    return (
        recent_pipeline_runs(runs)
        .orderBy(F.desc("StartedUtc"), F.desc("PipelineRunAuditId"))
        .select("StartedUtc", "Status", "DurationSeconds", "SuccessfulTableCount", "FailedTableCount")
    )


def table_health(health: DataFrame) -> DataFrame:
    return health.select(
        "SourceObject",
        "Load",
        "LoadType",
        "LastRunStatus",
        "ApprovedSchemaVersion",
        "PendingSchemaChanges",
    )
