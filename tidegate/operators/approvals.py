"""Schema-change decisions over whole logs: detection, requests, decisions, baselines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.operators.lookup import latest_by
from tidegate.operators.publish import insert_absent
from tidegate.state import vocabulary as v


def detect_changes(config: DataFrame, current: DataFrame, requests: DataFrame) -> DataFrame:
    """Drift state of every given configuration that has a current schema.

    A changed schema takes the status of the newest request with this very hash, else of
    a request still pending for the config, else it is new. The request log is reduced to
    one row per (config, hash) and per config before any join.
    """
    exact = latest_by(
        requests, ["ConfigId", "DetectedSchemaHash"], "SchemaChangeRequestId", ["Status"]
    ).select("ConfigId", F.col("DetectedSchemaHash").alias("CurrentHash"), F.col("Status").alias("exact"))
    pending = (
        requests.filter(F.col("Status") == v.PENDING)
        .groupBy("ConfigId")
        .agg(F.lit(v.PENDING).alias("open"))
    )
    changed = F.coalesce(F.col("CurrentHash") != F.col("ApprovedSchemaHash"), F.lit(False))
    known = F.coalesce(F.col("exact"), F.col("open"))
    return (
        config.select("ConfigId", "ApprovedSchemaHash")
        .join(current.select("ConfigId", "CurrentHash"), "ConfigId")
        .join(exact, ["ConfigId", "CurrentHash"], "left")
        .join(pending, "ConfigId", "left")
        .select(
            "ConfigId",
            "CurrentHash",
            "ApprovedSchemaHash",
            F.col("ApprovedSchemaHash").isNull().alias("IsFirstLoad"),
            changed.alias("SchemaChangeDetected"),
            F.when(changed, F.coalesce(known, F.lit(v.PENDING))).alias("SchemaApprovalStatus"),
            (changed & known.isNull()).alias("IsNewRequest"),
        )
    )


def new_requests(changes: DataFrame, missing: DataFrame) -> DataFrame:
    """The requests detection would raise, judged by the missing approved columns."""
    verdict = F.coalesce(F.col("Compatibility"), F.lit(v.OLD_PROJECTION_SAFE))
    return (
        changes.filter("IsNewRequest")
        .join(missing.select("ConfigId", "Compatibility"), "ConfigId", "left")
        .select(
            "ConfigId",
            F.col("CurrentHash").alias("DetectedSchemaHash"),
            F.col("ApprovedSchemaHash").alias("PreviousSchemaHash"),
            F.lit(v.CHANGE_SUMMARY).alias("ChangeSummary"),
            verdict.alias("Compatibility"),
            F.lit(v.PENDING).alias("Status"),
        )
    )


def _valid(decisions: DataFrame) -> DataFrame:
    return decisions.filter(F.col("Decision").isin(v.APPROVED, v.REJECTED))


def _first(decisions: DataFrame) -> DataFrame:
    """The first valid decision of every request, by DecisionId."""
    return (
        _valid(decisions)
        .groupBy("SchemaChangeRequestId")
        .agg(F.min("DecisionId").alias("_first"))
    )


def decision_errors(requests: DataFrame, decisions: DataFrame) -> DataFrame:
    """Decisions that may not be applied, with the code the single form would raise.

    ``DecisionId`` tells their order: the first valid decision closes a pending request, so
    every later one meets a request that is no longer pending.
    """
    status = requests.select("SchemaChangeRequestId", F.col("Status").alias("_status"))
    code = (
        F.when(~F.col("Decision").isin(v.APPROVED, v.REJECTED) | F.col("Decision").isNull(), 50001)
        .when(F.col("_status").isNull(), 50002)
        .when((F.col("_status") != v.PENDING) | (F.col("DecisionId") > F.col("_first")), 50003)
    )
    return (
        decisions.join(status, "SchemaChangeRequestId", "left")
        .join(_first(decisions), "SchemaChangeRequestId", "left")
        .withColumn("ErrorCode", code)
        .filter(F.col("ErrorCode").isNotNull())
        .select("SchemaChangeRequestId", "Decision", "ErrorCode")
    )


def _decided(requests: DataFrame, decisions: DataFrame) -> DataFrame:
    """Requests with their applicable decision: the first valid one, on pending requests only.

    The decision log is read once; its first row per request is one aggregate, combined on the map side.
    """
    valid = (
        _valid(decisions)
        .groupBy("SchemaChangeRequestId")
        .agg(F.min_by(F.struct(*decisions.columns), "DecisionId").alias("_d"))
    )
    hit = (F.col("Status") == v.PENDING) & F.col("_d").isNotNull()
    return requests.join(valid, "SchemaChangeRequestId", "left").withColumn("_hit", hit)


def apply_decisions(requests: DataFrame, decisions: DataFrame) -> DataFrame:
    """All requests, pending ones carrying their first valid decision.

    DecisionBy, DecisionUtc and DecisionNotes are taken over where both sides have them.
    """
    taken = {"Status": "Decision"}
    for name in ("DecisionBy", "DecisionUtc", "DecisionNotes"):
        if name in decisions.columns:
            taken[name] = name
    return _decided(requests, decisions).select(
        [
            F.when(F.col("_hit"), F.col(f"_d.{taken[c]}")).otherwise(F.col(c)).alias(c)
            if c in taken
            else F.col(c)
            for c in requests.columns
        ]
    )


def next_versions(requests: DataFrame, decisions: DataFrame, history: DataFrame) -> DataFrame:
    """History rows that approvals add: the next version per config.

    At most one request is pending per config (a log rule), so a config gains one row.
    """
    approved = _decided(requests, decisions).filter(F.col("_hit") & (F.col("_d.Decision") == v.APPROVED))
    last = history.groupBy("ConfigId").agg(F.max("SchemaVersion").alias("_last"))
    version = (F.coalesce(F.col("_last"), F.lit(0)) + 1).cast("int")
    return approved.join(last, "ConfigId", "left").select(
        "ConfigId",
        version.alias("SchemaVersion"),
        F.col("DetectedSchemaHash").alias("SchemaHash"),
        F.lit(v.APPROVED).alias("ApprovalStatus"),
        F.col("_d.DecisionBy").alias("ApprovedBy"),
    )


def pin_versions(config: DataFrame, versions: DataFrame) -> DataFrame:
    """Configuration with the newly approved hash and version where there is one."""
    new = versions.select(
        "ConfigId", F.col("SchemaHash").alias("_hash"), F.col("SchemaVersion").alias("_version")
    )
    pinned = {
        "ApprovedSchemaHash": F.coalesce(F.col("_hash"), F.col("ApprovedSchemaHash")),
        "ApprovedSchemaVersion": F.coalesce(F.col("_version"), F.col("ApprovedSchemaVersion")),
    }
    return config.join(new, "ConfigId", "left").select(
        [pinned.get(c, F.col(c)).alias(c) for c in config.columns]
    )


def baselines(
    config: DataFrame, current: DataFrame, history: DataFrame, requests: DataFrame
) -> DataFrame:
    """First-load approvals still to be recorded: a version and a request, each if absent."""
    first = (
        config.filter(F.col("ApprovedSchemaHash").isNull())
        .select("ConfigId")
        .join(current.select("ConfigId", "CurrentHash"), "ConfigId")
        .withColumnRenamed("CurrentHash", "SchemaHash")
    )
    versions = insert_absent(
        history.filter(F.col("SchemaVersion") == 1), first, "ConfigId"
    ).withColumns({"Record": F.lit("VERSION"), "SchemaVersion": F.lit(1)})
    initial = requests.filter(F.col("DecisionBy") == v.INITIAL_LOAD).select(
        "ConfigId", F.col("DetectedSchemaHash").alias("SchemaHash")
    )
    raised = insert_absent(initial, first, ["ConfigId", "SchemaHash"]).withColumns(
        {"Record": F.lit("REQUEST"), "SchemaVersion": F.lit(None).cast("int")}
    )
    return versions.unionByName(raised).select(
        "ConfigId",
        "Record",
        "SchemaHash",
        "SchemaVersion",
        F.lit(v.APPROVED).alias("Status"),
        F.lit(v.INITIAL_LOAD).alias("DecidedBy"),
    )
