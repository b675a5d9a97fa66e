"""Columns of the control, audit and approval logs."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class Log:
    """A log, the id column of its rows (None: rows never change), and its columns.

    Every row also carries its sequence number and the day it was written, by which the
    files are split.
    """

    name: str
    key: str | None
    columns: str

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromDDL(self.columns + ", _seq bigint, LogDate date")

    @property
    def fields(self) -> list[str]:
        return T.StructType.fromDDL(self.columns).fieldNames()


CONFIG = Log(
    "config",
    "ConfigId",
    """ConfigId int, SourceSchema string, SourceTable string, TargetSchema string, TargetTable string,
    Load string, LoadType string, WatermarkColumn string, PrimaryKeyColumn string, KeyCollation string,
    ConnectionReference string, RetryCount smallint, RetryIntervalSeconds smallint,
    ApprovedColumnList array<string>, ApprovedSchemaHash string, ApprovedSchemaVersion int,
    LastWatermarkValue timestamp_ntz, LastRunStatus string, LastSuccessfulRunUtc timestamp_ntz,
    CreatedUtc timestamp_ntz, ModifiedUtc timestamp_ntz""",
)
RUN = Log(
    "run",
    "PipelineRunAuditId",
    """PipelineRunAuditId bigint, AdfPipelineRunId string, PipelineName string,
    StartedUtc timestamp_ntz, CompletedUtc timestamp_ntz, Status string, EnabledTableCount int,
    SuccessfulTableCount int, FailedTableCount int, Message string""",
)
ATTEMPT = Log(
    "attempt",
    "TableLoadAuditId",
    """TableLoadAuditId bigint, AdfPipelineRunId string, ConfigId int, SourceObject string,
    TargetObject string, LoadType string, IsFirstLoad boolean, SchemaChangeDetected boolean,
    SchemaApprovalStatus string, StartedUtc timestamp_ntz, CompletedUtc timestamp_ntz,
    SourceRowCount bigint, TargetRowCount bigint, RowsInserted bigint, RowsUpdated bigint,
    Status string, ErrorMessage string""",
)
CHECK = Log(
    "check",
    "ReconciliationResultId",
    """ReconciliationResultId bigint, TableLoadAuditId bigint, GateStage string, CheckName string,
    ExpectedValue string, ActualValue string, Result string, Details string,
    CheckedUtc timestamp_ntz""",
)
NOTIFICATION = Log(
    "notification",
    "NotificationAuditId",
    """NotificationAuditId bigint, AdfPipelineRunId string, ConfigId int, EventType string,
    DeliveryStatus string, Message string, CreatedUtc timestamp_ntz""",
)
HISTORY = Log(
    "history",
    "SchemaHistoryId",
    """SchemaHistoryId bigint, ConfigId int, SchemaVersion int, SchemaHash string,
    ColumnList array<string>, SchemaDefinition string, ApprovalStatus string, ApprovedBy string,
    ApprovedUtc timestamp_ntz, EffectiveUtc timestamp_ntz""",
)
REQUEST = Log(
    "request",
    "SchemaChangeRequestId",
    """SchemaChangeRequestId bigint, ConfigId int, DetectedSchemaHash string,
    PreviousSchemaHash string, DetectedColumnList array<string>, DetectedSchemaDefinition string,
    ChangeSummary string, Compatibility string, Status string, DetectedUtc timestamp_ntz,
    DecisionUtc timestamp_ntz, DecisionBy string, DecisionNotes string""",
)
OUTBOX = Log(
    "outbox",
    None,
    """AdfPipelineRunId string, ConfigId int, EventType string, Payload string,
    CreatedUtc timestamp_ntz""",
)
LOGS = [CONFIG, RUN, ATTEMPT, CHECK, NOTIFICATION, HISTORY, REQUEST, OUTBOX]

# one row per publish; the newest row of a config is its curated table
COMMIT_COLUMNS = """CommitId bigint, ConfigId int, TableLoadAuditId bigint, SchemaJson string,
    KeyColumn string, KeyCollation string, Buckets int,
    Parts array<struct<bucket:int,path:string,rows:bigint,duplicate_keys:bigint,null_keys:bigint>>,
    LastWatermarkValue timestamp_ntz, CommittedUtc timestamp_ntz"""
