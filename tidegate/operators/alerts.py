"""Alert selection over whole notification logs, and the outbox text of an alert."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.functions.clock import iso_utc, timestamp_literal
from tidegate.functions.text import concat0
from tidegate.operators.attempts import CONFIG, RUN, outcomes
from tidegate.operators.lookup import latest_by
from tidegate.state import vocabulary as v

COLUMNS = [RUN, CONFIG, "EventType", "Status", "Message"]


def _pairs(notifications: DataFrame, requests: DataFrame, attempts: DataFrame) -> DataFrame:
    """One row per finished (run, config): its outcome, newest events, and request standing.

    Each log is reduced by one aggregate before the joins.
    """

    def newest(event: str):
        return F.max(F.when(F.col("EventType") == event, F.col("NotificationAuditId")))

    # numbers only, so nothing is sorted; texts are fetched for events that are sent
    events = notifications.groupBy(RUN, CONFIG).agg(
        F.max("NotificationAuditId").alias("last"),
        newest(v.TABLE_FAILURE).alias("failure"),
        newest(v.SCHEMA_CHANGE).alias("change"),
    )
    finished = outcomes(attempts).filter(F.col("outcome").isNotNull())
    # the newest request of the config, whatever schema it was for
    standing = latest_by(requests, [CONFIG], "SchemaChangeRequestId", ["Status"]).select(
        CONFIG, F.col("Status").alias("request")
    )
    return events.join(finished, [RUN, CONFIG]).join(standing, CONFIG, "left")


def _sent() -> Column:
    """The events a finished pair sends, with the status each has unless it tells of a change.

    Success: its newest event. Failure: the newest failure, then the newest schema change;
    the second follows the first, so a pair without a recorded failure sends neither.
    """

    def event(number: Column, status: str) -> Column:
        sent = F.struct(number.alias("NotificationAuditId"), F.lit(status).alias("_status"))
        return F.when(number.isNotNull(), sent)

    change = F.when(F.col("failure").isNotNull(), F.col("change"))
    failed = F.array(event(F.col("failure"), v.FAILURE), event(change, v.FAILURE))
    return F.when(F.col("outcome") == v.SUCCESS, F.array(event(F.col("last"), v.SUCCESS))).otherwise(failed)


def alerts(notifications: DataFrame, requests: DataFrame, attempts: DataFrame, outcome: str | None = None) -> DataFrame:
    """All alerts of all runs, or those of pairs with one outcome."""
    pairs = _pairs(notifications, requests, attempts)
    if outcome is not None:
        pairs = pairs.filter(F.col("outcome") == outcome)
    chosen = pairs.select("request", F.inline(F.array_compact(_sent())))
    change = concat0(F.lit("SCHEMA_CHANGE_"), F.coalesce(F.col("request"), F.lit(v.PENDING)))
    status = F.when(F.col("EventType") == v.SCHEMA_CHANGE, change).otherwise(F.col("_status"))
    return notifications.join(chosen, "NotificationAuditId").withColumn("Status", status).select(COLUMNS)


def success_alerts(notifications: DataFrame, requests: DataFrame, attempts: DataFrame) -> DataFrame:
    """One alert per (run, config) whose latest attempt succeeded."""
    return alerts(notifications, requests, attempts, v.SUCCESS)


def failure_alerts(notifications: DataFrame, requests: DataFrame, attempts: DataFrame) -> DataFrame:
    """Failure and schema-change alerts of (run, config) whose latest attempt failed."""
    return alerts(notifications, requests, attempts, v.FAILURE)


def payloads(selected: DataFrame, now: datetime) -> DataFrame:
    """Outbox rows: the JSON event of each alert; double quotes turn into single ones."""
    text = F.replace(F.coalesce(F.col("Message"), F.lit("")), F.lit('"'), F.lit("'"))
    body = F.struct(
        F.col("EventType").alias("eventType"),
        F.col(RUN).alias("pipelineRunId"),
        concat0(F.lit("ConfigId "), F.col(CONFIG)).alias("tableName"),
        F.col("Status").alias("status"),
        text.alias("message"),
        iso_utc(timestamp_literal(now)).alias("occurredUtc"),
    )
    return selected.select(RUN, CONFIG, "EventType", F.to_json(body).alias("Payload"))
