"""Log-scale inputs derived from the given tables.

Each is a view over one whole table, so the control and audit logs the queries read grow
with the scale factor. The texts are plain SQL that both engines run; only the type word
of a timestamp literal and the spelling of the column list differ.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = [
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
    "documents",
    "embeddings",
    "pages",
    "benchmark",
    "labels",
    "conversations",
]

_MIDNIGHT = "TIMESTAMP '2024-01-01 00:00:00'"
# parts as schema requests, in turn for every configuration; a configuration's first may be open
_PARTS = """(
  SELECT *, p_partkey < configs AND p_size % 3 = 0 AS is_open
  FROM (SELECT *, (SELECT count(*) FROM customer) AS configs FROM part) c) p"""
_RUN_ID = "concat('run-', year(o_orderdate) * 100 + quarter(o_orderdate))"

VIEWS = {
    "fx_config": f"""
SELECT CAST(c_custkey AS INT) AS ConfigId, 'src' AS SourceSchema, concat('T_', c_custkey) AS SourceTable,
       'curated' AS TargetSchema, concat('T_', c_custkey) AS TargetTable,
       CASE WHEN c_custkey % 4 = 0 THEN 'No' ELSE 'Yes' END AS Load,
       CASE WHEN c_nationkey % 2 = 0 THEN 'FULL' ELSE 'WATERMARK' END AS LoadType,
       CASE WHEN c_nationkey % 2 = 0 THEN NULL ELSE 'm' END AS WatermarkColumn, 'k' AS PrimaryKeyColumn,
       CAST(3 AS INT) AS RetryCount, CAST(15 AS INT) AS RetryIntervalSeconds,
       CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE concat('H', c_nationkey % 5) END AS ApprovedSchemaHash,
       CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE CAST(1 + c_nationkey % 3 AS INT) END AS ApprovedSchemaVersion,
       CASE WHEN c_custkey % 3 = 0 THEN 'FAILURE' WHEN c_custkey % 11 = 0 THEN NULL ELSE 'SUCCESS' END AS LastRunStatus,
       {_MIDNIGHT} + (c_custkey % 86400) * INTERVAL '1' SECOND AS LastSuccessfulRunUtc
FROM customer""",
    "fx_current_hash": """
SELECT CAST(c_custkey AS INT) AS ConfigId, concat('H', c_custkey % 6) AS CurrentHash FROM customer""",
    "fx_schema_columns": """
SELECT CAST(c_custkey AS INT) AS ConfigId, s.side,
       CASE WHEN s.side = 'current' AND c_custkey % 5 = 4 AND s.ord = 2 THEN 3
            WHEN s.side = 'current' AND c_custkey % 5 = 4 AND s.ord = 3 THEN 2 ELSE s.ord END AS ordinal,
       CASE WHEN s.side = 'current' AND c_custkey % 5 = 2 AND s.name = 'b' THEN 'b2' ELSE s.name END AS name,
       CASE WHEN s.side = 'current' AND c_custkey % 5 = 3 AND s.name = 'a' THEN 'string' ELSE s.type END AS type
FROM customer @columns@
WHERE s.name <> 'x' OR c_custkey % 5 = 1""",
    "fx_request": f"""
SELECT CAST(p_partkey AS BIGINT) AS SchemaChangeRequestId, CAST(p_partkey % configs AS INT) AS ConfigId,
       concat('H', p_size % 6) AS DetectedSchemaHash,
       CASE WHEN p_size % 2 = 0 THEN 'OLD_PROJECTION_SAFE' ELSE 'BREAKING' END AS Compatibility,
       CASE WHEN is_open THEN 'PENDING' WHEN p_size % 3 = 1 THEN 'APPROVED' ELSE 'REJECTED' END AS Status,
       'Source schema differs from the last approved version.' AS ChangeSummary,
       {_MIDNIGHT} + (p_partkey % 86400) * INTERVAL '1' SECOND AS DetectedUtc,
       CASE WHEN is_open THEN NULL ELSE p_brand END AS DecisionBy,
       CASE WHEN is_open THEN NULL ELSE {_MIDNIGHT} + (p_partkey % 86400 + 60) * INTERVAL '1' SECOND END AS DecisionUtc,
       CASE WHEN p_size % 3 = 1 THEN p_type ELSE NULL END AS DecisionNotes
FROM {_PARTS}""",
    # a decision on every open request, some unknown; on some requests a second, contrary one
    "fx_decision": f"""
SELECT CAST(2 * p_partkey AS BIGINT) AS DecisionId, CAST(p_partkey AS BIGINT) AS SchemaChangeRequestId,
       CASE WHEN p_partkey % 14 = 0 THEN 'MAYBE' WHEN p_partkey % 2 = 0 THEN 'APPROVED' ELSE 'REJECTED' END AS Decision, p_brand AS DecisionBy
FROM {_PARTS} WHERE is_open
UNION ALL
SELECT CAST(2 * p_partkey + 1 AS BIGINT), CAST(p_partkey AS BIGINT), CASE WHEN p_partkey % 2 = 0 THEN 'REJECTED' ELSE 'APPROVED' END, p_type
FROM {_PARTS} WHERE is_open AND p_partkey % 7 = 0""",
    # decisions by every part: unknown verdicts, unknown requests, closed requests, repeats
    "fx_attempted_decision": f"""
SELECT CAST(p_partkey AS BIGINT) AS DecisionId, CAST(CASE WHEN p_size > 45 THEN p_partkey + 1000000000 ELSE p_partkey END AS BIGINT) AS SchemaChangeRequestId,
       CASE WHEN p_size < 5 THEN 'MAYBE' WHEN p_partkey % 2 = 0 THEN 'APPROVED' ELSE 'REJECTED' END AS Decision,
       p_brand AS DecisionBy
FROM part
UNION ALL
SELECT CAST(1000000000 + p_partkey AS BIGINT), CAST(p_partkey AS BIGINT), 'APPROVED', p_type FROM part WHERE p_partkey % 5 = 0""",
    "fx_history": f"""
SELECT CAST(p_partkey AS BIGINT) AS SchemaHistoryId, CAST(p_partkey % configs AS INT) AS ConfigId,
       CAST(1 + floor(p_partkey / configs) AS INT) AS SchemaVersion, concat('H', p_size % 6) AS SchemaHash,
       '[k],[a],[b],[m]' AS ColumnList, 'APPROVED' AS ApprovalStatus, p_brand AS ApprovedBy,
       {_MIDNIGHT} + (p_partkey % 86400) * INTERVAL '1' SECOND AS ApprovedUtc
FROM {_PARTS}""",
    "fx_attempt": f"""
SELECT CAST(o_orderkey AS BIGINT) AS TableLoadAuditId,
       CASE WHEN o_orderkey % 37 = 0 THEN concat('lost-', o_orderkey % 5) ELSE {_RUN_ID} END AS AdfPipelineRunId,
       CAST(o_custkey AS INT) AS ConfigId, concat('[src].[T_', o_custkey, ']') AS SourceObject,
       concat('[curated].[T_', o_custkey, ']') AS TargetObject,
       CASE WHEN o_custkey % 2 = 0 THEN 'FULL' ELSE 'WATERMARK' END AS LoadType,
       o_orderkey % 20 = 0 AS IsFirstLoad, o_orderkey % 5 = 0 AS SchemaChangeDetected,
       CASE WHEN o_orderkey % 5 <> 0 THEN NULL WHEN o_orderkey % 3 = 0 THEN 'PENDING' ELSE 'REJECTED' END AS SchemaApprovalStatus,
       o_orderdate + (o_orderkey * 37 % 1000) * INTERVAL '0.001' SECOND AS StartedUtc,
       CASE WHEN o_orderstatus = 'P' THEN NULL
            ELSE o_orderdate + (o_orderkey % 600) * INTERVAL '1' SECOND + (o_orderkey * 91 % 1000) * INTERVAL '0.001' SECOND END AS CompletedUtc,
       CASE WHEN o_orderstatus = 'F' THEN NULL ELSE CAST(o_orderkey % 1000 AS BIGINT) END AS SourceRowCount,
       CASE WHEN o_orderstatus = 'F' THEN NULL ELSE CAST(o_orderkey AS BIGINT) END AS TargetRowCount,
       CAST(NULL AS BIGINT) AS RowsInserted, CAST(NULL AS BIGINT) AS RowsUpdated,
       CASE o_orderstatus WHEN 'O' THEN 'SUCCESS' WHEN 'F' THEN 'FAILURE' ELSE 'RUNNING' END AS Status,
       CASE WHEN o_orderstatus = 'F' THEN 'Gate 1 reconciliation failed' ELSE NULL END AS ErrorMessage
FROM orders""",
    "fx_run": f"""
SELECT CAST(min(o_orderkey) AS BIGINT) AS PipelineRunAuditId,
       {_RUN_ID} AS AdfPipelineRunId, 'governed-load' AS PipelineName,
       min(o_orderdate) AS StartedUtc, max(o_orderdate) AS CompletedUtc, 'PARTIAL_SUCCESS' AS Status,
       CAST(count(*) AS INT) AS EnabledTableCount,
       CAST(count(CASE WHEN o_orderstatus = 'O' THEN 1 END) AS INT) AS SuccessfulTableCount,
       CAST(count(CASE WHEN o_orderstatus = 'F' THEN 1 END) AS INT) AS FailedTableCount,
       CAST(NULL AS STRING) AS Message
FROM orders GROUP BY year(o_orderdate), quarter(o_orderdate)
UNION ALL
SELECT CAST(1000000000 + event_id AS BIGINT), concat('evt-', event_id), 'governed-load', ts,
       CASE WHEN event_type = 'view' THEN NULL ELSE ts + (event_id * 53 % 900000) * INTERVAL '0.001' SECOND END,
       CASE event_type WHEN 'error' THEN 'FAILURE' WHEN 'signup' THEN 'PARTIAL_SUCCESS' WHEN 'view' THEN 'RUNNING' ELSE 'SUCCESS' END,
       CAST(user_id % 9 AS INT), CAST(user_id % 5 AS INT), CAST(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS INT),
       event_type
FROM events""",
    "fx_check": """
SELECT l_orderkey * 10 + l_linenumber AS ReconciliationResultId, CAST(l_orderkey AS BIGINT) AS TableLoadAuditId,
       CASE WHEN l_linestatus = 'O' THEN 'GATE_1_PRE_PUBLISH' WHEN l_linenumber = 7 THEN 'OTHER' ELSE 'GATE_2_POST_PUBLISH' END AS GateStage,
       CASE l_linenumber % 4 WHEN 0 THEN 'SOURCE_STAGE_ROW_COUNT' WHEN 1 THEN 'DUPLICATE_PRIMARY_KEY' WHEN 2 THEN 'NULL_PRIMARY_KEY' ELSE 'APPROVED_SCHEMA' END AS CheckName,
       '0' AS ExpectedValue, concat('', l_partkey % 3) AS ActualValue,
       CASE l_returnflag WHEN 'R' THEN 'FAIL' WHEN 'A' THEN 'PASS' ELSE 'WARNING' END AS Result,
       'fixture' AS Details, l_shipdate AS CheckedUtc
FROM lineitem""",
    "fx_notification": f"""
SELECT CAST(o_orderkey AS BIGINT) AS NotificationAuditId,
       {_RUN_ID} AS AdfPipelineRunId,
       CASE WHEN o_orderkey % 50 = 0 THEN NULL ELSE CAST(o_custkey AS INT) END AS ConfigId,
       CASE WHEN o_orderstatus = 'F' THEN 'TABLE_FAILURE' WHEN o_orderstatus = 'P' OR o_orderkey % 5 = 0 THEN 'SCHEMA_CHANGE' ELSE 'TABLE_SUCCESS' END AS EventType,
       'PENDING' AS DeliveryStatus, concat('load of "T_', o_custkey, '" ', o_orderpriority) AS Message, o_orderdate AS CreatedUtc
FROM orders""",
    "fx_events_nullwm": """
SELECT event_id, CASE WHEN event_id % 97 = 0 THEN NULL ELSE ts END AS ts, user_id, event_type, value FROM events""",
    # a load key that repeats and is sometimes NULL
    "fx_line_key": """
SELECT CASE WHEN l_linenumber = 7 THEN NULL ELSE l_orderkey * 10 + l_linenumber END AS line_key, l_partkey, l_shipdate FROM lineitem""",
}

# the approved and the current columns of every configured table: (side, position, name, type)
SCHEMA_COLUMNS = [
    ("approved", 1, "k", "bigint"),
    ("approved", 2, "a", "int"),
    ("approved", 3, "b", "string"),
    ("approved", 4, "m", "timestamp"),
    ("current", 1, "k", "bigint"),
    ("current", 2, "a", "int"),
    ("current", 3, "b", "string"),
    ("current", 4, "m", "timestamp"),
    ("current", 5, "x", "string"),
]
_ROWS = ", ".join(f"('{side}', {ord}, '{name}', '{kind}')" for side, ord, name, kind in SCHEMA_COLUMNS)


def spark_text(view: str, sf_dir: str) -> str:
    """The view reading parquet files directly, with zone-free literals."""
    text = VIEWS[view].replace("TIMESTAMP '", "TIMESTAMP_NTZ '")
    columns = f"LATERAL VIEW inline(array({_ROWS.replace('(', 'struct(')})) s AS side, ord, name, type"
    text = text.replace("@columns@", columns)
    return re.sub(
        r"\bFROM (\w+)", lambda m: f"FROM parquet.`{sf_dir}/{m.group(1)}.parquet`", text
    )


def oracle_text(view: str) -> str:
    """The view as the independent SQL engine reads it."""
    columns = f"CROSS JOIN (VALUES {_ROWS}) AS s(side, ord, name, type)"
    return VIEWS[view].replace("@columns@", columns)


class Inputs:
    """The given tables and the derived logs as DataFrames, by attribute-free lookup."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir.rstrip("/")

    def __getitem__(self, name: str) -> DataFrame:
        if name in VIEWS:
            return self.spark.sql(spark_text(name, self.sf_dir))
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def many(self, *names: str) -> list[DataFrame]:
        return [self[n] for n in names]
