"""The registered queries: each runs library operators over whole given tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import reduce
from uuid import uuid4

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from catalogue.fixtures import TABLES, Inputs
from tidegate.functions import seconds_between, sha256_hex, timestamp_literal
from tidegate.operators import (
    alerts,
    approvals,
    attempts,
    calendar,
    fingerprint,
    gates,
    highwater,
    lookup,
    projection,
    publish,
    rollup,
    validate,
)
from tidegate.plans import reporting
from tidegate.plans.catalog_views import create_views
from tidegate.plans.load import load_table
from tidegate.plans.run import run_pipeline
from tidegate.plans.views import register_views
from tidegate.sources import CatalogTables, Frames, Marks, ParquetFolder, Sources, column_catalog
from tidegate.state import tables as logs
from tidegate.state.row_level import RowLevelTables
from tidegate.state.shared import shared_root, stage
from tidegate.state.snapshots import Snapshots
from tidegate.state.store import StateStore
from tidegate.state.vocabulary import LoadError

T1 = datetime(2024, 1, 15)
NOW = datetime(2024, 6, 1, 12, 30, 15)
APPROVED_EVENT_COLUMNS = ["event_id", "ts", "event_type", "value"]

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Callable[[Inputs], DataFrame]) -> Callable[[Inputs], DataFrame]:
    """Register under the function's name."""
    QUERIES[build.__name__] = lambda spark, sf_dir: build(Inputs(spark, sf_dir))
    return build


# --- control table and high-water windows -----------------------------------------


@query
def enabled_config_lookup(t: Inputs) -> DataFrame:
    return lookup.enabled_configs(t["fx_config"])


MARKS = {"events": "ts", "orders": "o_orderdate", "lineitem": "l_shipdate"}


def _marks(t: Inputs) -> dict[str, Marks]:
    """Asked of the sources: parquet footers, and the row groups that hold the largest marks."""
    lake = ParquetFolder(t.sf_dir.rpartition("/")[0])
    folder = t.sf_dir.rpartition("/")[2]
    return {name: lake.marks(t[name], folder, f"{name}.parquet", mark) for name, mark in MARKS.items()}


@query
def highwater_capture(t: Inputs) -> DataFrame:
    """The captured mark of each source, and the rows of the first window up to it."""
    rows = [(name, m.top, m.rows - m.null_marks) for name, m in _marks(t).items()]
    return t.spark.createDataFrame(rows, "source string, captured timestamp_ntz, source_rows bigint")


@query
def source_marks(t: Inputs) -> DataFrame:
    """Mark, rows and unmarked rows of each source, as its connection tells them."""
    rows = [(name, m.top, m.rows, m.null_marks) for name, m in _marks(t).items()]
    return t.spark.createDataFrame(rows, "source string, top timestamp_ntz, rows bigint, null_marks bigint")


@query
def observed_window(t: Inputs) -> DataFrame:
    """What one read of a source with unmarked rows shows: mark, window rows, unmarked rows; and the rows staged."""
    read = highwater.observed_window(t["fx_events_nullwm"], "ts", T1)
    staged = stage(read.frame.select("event_id"), shared_root(t.spark))
    counted = staged.agg(F.count("*").alias("staged_rows"), F.sum("event_id").alias("id_sum"))
    figures = {"mark": timestamp_literal(read.mark), "window_rows": F.lit(read.rows), "null_marks": F.lit(read.null_marks)}
    return counted.withColumns({name: value.cast("bigint") if name != "mark" else value for name, value in figures.items()})


def _window(source: DataFrame, last: datetime | None) -> DataFrame:
    return highwater.window(source, "ts", last, highwater.capture(source, "ts"))


@query
def highwater_first_load(t: Inputs) -> DataFrame:
    return _window(t["fx_events_nullwm"], None)


@query
def highwater_delta(t: Inputs) -> DataFrame:
    return _window(t["events"], T1)


@query
def highwater_empty_window(t: Inputs) -> DataFrame:
    events = t["events"]
    captured = highwater.capture(events, "ts")
    delta = highwater.window(events, "ts", captured, captured)
    mark = F.coalesce(F.max("ts"), timestamp_literal(captured))
    return delta.agg(F.count("*").alias("window_rows"), mark.alias("next_mark"))


@query
def approved_projection(t: Inputs) -> DataFrame:
    return projection.project(_window(t["events"], T1), APPROVED_EVENT_COLUMNS)


# --- gates ------------------------------------------------------------------------


@query
def gate1_checks_pass(t: Inputs) -> DataFrame:
    delta = _window(t["events"], T1)
    return gates.gate1(delta, projection.project(delta, APPROVED_EVENT_COLUMNS), "event_id")


@query
def gate1_checks_fail(t: Inputs) -> DataFrame:
    lines = t["fx_line_key"]
    return gates.gate1(lines, lines, "line_key")


def _gate1_by_bitmap(t: Inputs, rows: DataFrame, key: str) -> DataFrame:
    """Gate 1 of rows that are staged first, their counts and key range observed on the way."""
    seen = Observation()
    figures = {"rows": F.count("*"), **gates.key_range_columns(rows, key)}
    staged = stage(rows.observe(seen, *[c.alias(name) for name, c in figures.items()]).select(key), shared_root(t.spark))
    found = gates.KeyRange(seen.get["rows"], seen.get["low"], seen.get["high"], len(staged.inputFiles()))
    p = gates.measured_profile(staged, key, found)
    return gates.gate1_of(t.spark, found.rows, p["rows"], p["duplicate_keys"], p["null_keys"], 0)


@query
def integer_gate1_pass(t: Inputs) -> DataFrame:
    """Unique integer keys in a dense range: proven by bitmaps."""
    return _gate1_by_bitmap(t, t["orders"].select("o_orderkey"), "o_orderkey")


@query
def integer_gate1_skewed(t: Inputs) -> DataFrame:
    """A third of all rows have one key, some none: the bitmaps prove nothing and the keys are counted."""
    k = F.col("o_orderkey")
    hot = F.when(k % 3 == 0, 6).when(k % 97 != 0, k)
    return _gate1_by_bitmap(t, t["orders"].select(hot.alias("o_orderkey")), "o_orderkey")


@query
def integer_key_counts(t: Inputs) -> DataFrame:
    """Rows, different keys and missing keys of three tables, by bitmaps."""
    keys = {"orders": "o_orderkey", "lineitem": "l_orderkey", "events": "user_id"}
    return reduce(
        DataFrame.unionByName,
        [gates.integer_profile(t[name], key).withColumn("source", F.lit(name)) for name, key in keys.items()],
    )


# --- publish ----------------------------------------------------------------------


def _published_events(t: Inputs) -> DataFrame:
    return t["events"].filter(F.col("ts") <= timestamp_literal(T1))


def _staged_events(t: Inputs) -> DataFrame:
    """New events, and published purchases whose value was corrected."""
    events = t["events"]
    new = F.col("ts") > timestamp_literal(T1)
    value = F.when(new, F.col("value")).otherwise(F.col("value") * 2)
    return events.filter(new | (F.col("event_type") == "purchase")).withColumn("value", value)


@query
def publish_full(t: Inputs) -> DataFrame:
    stage = t["orders"].filter(F.col("o_orderstatus") != "P").drop("o_orderpriority")
    return publish.overwrite(t["orders"], stage)


@query
def publish_upsert(t: Inputs) -> DataFrame:
    return publish.upsert(_published_events(t), _staged_events(t), "event_id")


@query
def publish_evolved_upsert(t: Inputs) -> DataFrame:
    stage = _staged_events(t).withColumn("region_code", F.upper(F.substring("event_type", 1, 2)))
    return publish.upsert(_published_events(t), stage, "event_id")


@query
def unpublished_keys(t: Inputs) -> DataFrame:
    stage = _staged_events(t)
    return publish.unpublished(stage, _published_events(t), "event_id").select("event_id", "ts")


@query
def gate2_checks(t: Inputs) -> DataFrame:
    stage = _staged_events(t)
    merged = publish.upsert(_published_events(t), stage, "event_id")
    replaced = publish.overwrite(_published_events(t), stage)
    upserted = gates.gate2(stage, merged, "event_id", full=False)
    full = gates.gate2(stage, replaced, "event_id", full=True)
    return upserted.withColumn("mode", F.lit("UPSERT")).unionByName(
        full.withColumn("mode", F.lit("FULL"))
    )


@query
def gate2_checks_fail(t: Inputs) -> DataFrame:
    """Lines against the lines of shipped orders: missing, repeated and NULL keys."""
    lines = t["fx_line_key"]
    shipped = lines.filter(F.col("l_shipdate") < timestamp_literal(datetime(1998, 1, 1)))
    return gates.gate2(lines, shipped, "line_key", full=True)


def _changed_customers(t: Inputs) -> DataFrame:
    """Customers of one segment with a new balance, and another segment under new keys."""
    c = t["customer"].filter(F.col("c_mktsegment").isin("BUILDING", "MACHINERY"))
    moved = F.col("c_mktsegment") == "MACHINERY"
    return c.withColumns(
        {
            "c_custkey": F.when(moved, F.col("c_custkey") + 1_000_000_000).otherwise(F.col("c_custkey")),
            "c_acctbal": F.when(moved, F.col("c_acctbal")).otherwise(F.col("c_acctbal") * 2),
        }
    )


@query
def merge_upsert(t: Inputs) -> DataFrame:
    target = t["customer"].withColumn("c_note", F.concat(F.lit("n"), "c_nationkey"))
    return publish.merge(target, _changed_customers(t), "c_custkey")


RTRIM_LCASE = "UTF8_LCASE_RTRIM"


def _named_customers(t: Inputs, published: bool) -> DataFrame:
    """Customers by a text key whose case and trailing blanks depend on who wrote it."""
    name = F.col("c_name")
    if published:
        key = F.when(F.col("c_custkey") % 3 == 0, F.upper(name)).otherwise(name)
        rows = t["customer"].filter(F.col("c_custkey") % 5 != 0)
    else:
        key = F.when(F.col("c_custkey") % 2 == 0, F.concat(F.lower(name), F.lit("  "))).otherwise(name)
        rows = t["customer"].filter(F.col("c_custkey") % 4 != 1).withColumn("c_acctbal", F.col("c_acctbal") + 1)
    return rows.select(key.alias("c_key"), "c_nationkey", "c_acctbal")


@query
def collated_gate1(t: Inputs) -> DataFrame:
    """Gate 1 over both spellings together: what the database takes for one key is a repeated key."""
    both = _named_customers(t, True).unionByName(_named_customers(t, False))
    return gates.gate1(both, both, "c_key", collation=RTRIM_LCASE)


@query
def collated_gate2(t: Inputs) -> DataFrame:
    target, staged = _named_customers(t, True), _named_customers(t, False)
    merged = publish.upsert(target, staged, "c_key", RTRIM_LCASE)
    return gates.gate2(staged, merged, "c_key", False, RTRIM_LCASE)


@query
def collated_upsert(t: Inputs) -> DataFrame:
    return publish.upsert(_named_customers(t, True), _named_customers(t, False), "c_key", RTRIM_LCASE)


@query
def collated_merge(t: Inputs) -> DataFrame:
    target = _named_customers(t, True).withColumn("c_note", F.concat(F.lit("n"), "c_nationkey"))
    return publish.merge(target, _named_customers(t, False), "c_key", RTRIM_LCASE)


@query
def insert_if_absent(t: Inputs) -> DataFrame:
    return publish.insert_absent(t["customer"], _changed_customers(t), ["c_custkey"])


# --- fingerprints and drift -------------------------------------------------------


@query
def schema_fingerprint(t: Inputs) -> DataFrame:
    """Definition and hash of every configured table, approved and current."""
    prints = fingerprint.fingerprint_columns(t["fx_schema_columns"], ["ConfigId", "side"])
    return prints.withColumn("WideHash", sha256_hex("SchemaDefinition", "UTF-16LE"))


@query
def source_inventory(t: Inputs) -> DataFrame:
    """Fingerprint and row count of each given table."""

    def one(name: str) -> DataFrame:
        table = t[name]
        fp = fingerprint.fingerprint(table.schema)
        return table.agg(
            F.lit(name).alias("table_name"),
            F.lit(fp.definition).alias("SchemaDefinition"),
            F.lit(fp.hash).alias("SchemaHash"),
            F.count("*").alias("source_rows"),
        )

    return reduce(DataFrame.unionByName, [one(name) for name in TABLES])


@query
def schema_diff(t: Inputs) -> DataFrame:
    return fingerprint.schema_diff(t["fx_schema_columns"])


@query
def missing_approved_columns(t: Inputs) -> DataFrame:
    return fingerprint.missing_columns(t["fx_schema_columns"])


def _changes(t: Inputs) -> DataFrame:
    enabled = t["fx_config"].filter(F.col("Load") == "Yes")
    return approvals.detect_changes(enabled, t["fx_current_hash"], t["fx_request"])


@query
def detect_changes(t: Inputs) -> DataFrame:
    return _changes(t)


@query
def new_change_requests(t: Inputs) -> DataFrame:
    return approvals.new_requests(_changes(t), fingerprint.missing_columns(t["fx_schema_columns"]))


@query
def decision_errors(t: Inputs) -> DataFrame:
    return approvals.decision_errors(*t.many("fx_request", "fx_attempted_decision"))


@query
def apply_decisions(t: Inputs) -> DataFrame:
    return approvals.apply_decisions(*t.many("fx_request", "fx_decision"))


@query
def next_schema_versions(t: Inputs) -> DataFrame:
    return approvals.next_versions(*t.many("fx_request", "fx_decision", "fx_history"))


@query
def pinned_configuration(t: Inputs) -> DataFrame:
    versions = approvals.next_versions(*t.many("fx_request", "fx_decision", "fx_history"))
    return approvals.pin_versions(t["fx_config"], versions).select(
        "ConfigId", "ApprovedSchemaHash", "ApprovedSchemaVersion"
    )


@query
def initial_load_approvals(t: Inputs) -> DataFrame:
    return approvals.baselines(
        *t.many("fx_config", "fx_current_hash", "fx_history", "fx_request")
    )


@query
def latest_pending_request(t: Inputs) -> DataFrame:
    return lookup.latest_pending_request(t["fx_request"])


# --- reporting views --------------------------------------------------------------


@query
def vw_pipeline_health(t: Inputs) -> DataFrame:
    return reporting.pipeline_health(*t.many("fx_config", "fx_request", "fx_attempt"))


@query
def vw_reconciliation_summary(t: Inputs) -> DataFrame:
    return reporting.reconciliation_summary(*t.many("fx_attempt", "fx_check"))


@query
def vw_recent_pipeline_runs(t: Inputs) -> DataFrame:
    return reporting.recent_pipeline_runs(t["fx_run"])


@query
def vw_recent_table_loads(t: Inputs) -> DataFrame:
    return reporting.recent_table_loads(t["fx_attempt"])


def _summary(t: Inputs) -> DataFrame:
    return reporting.dashboard_summary(
        *t.many("fx_config", "fx_run", "fx_attempt", "fx_check", "fx_request")
    )


@query
def vw_dashboard_summary(t: Inputs) -> DataFrame:
    return _summary(t)


@query
def summary_from_partials(t: Inputs) -> DataFrame:
    """The summary's measures of attempts and checks, merged from day partials of four spans of the logs."""
    attempts = t["fx_attempt"].withColumn("day", F.to_date("StartedUtc"))
    checks = t["fx_check"].withColumn("day", F.to_date("CheckedUtc"))
    folder, seen, partials = shared_root(t.spark), attempts.select(*rollup.PAIR).limit(0), []
    for k, (first, last) in enumerate([("0001", "1996"), ("1996", "1998"), ("1998", "2000"), ("2000", "9999")]):
        span = F.col("day").between(f"{first}-01-01", f"{int(last) - 1:04d}-12-31")
        begun = attempts.filter(span)
        fresh = stage(rollup.new_pairs(begun, seen, "day"), f"{folder}/pairs-{k}")
        done = begun.filter(F.col("Status") == "SUCCESS")
        partials.append(rollup.day_partials(begun, done, checks.filter(span), fresh, "day"))
        seen = seen.unionByName(fresh.select(*rollup.PAIR))
    return rollup.merged(reduce(DataFrame.unionByName, partials))


@query
def vw_schema_change_requests(t: Inputs) -> DataFrame:
    return reporting.schema_change_requests(*t.many("fx_request", "fx_config"))


@query
def vw_schema_version_history(t: Inputs) -> DataFrame:
    return reporting.schema_version_history(*t.many("fx_history", "fx_config"))


@query
def vw_reconciliation_results(t: Inputs) -> DataFrame:
    return reporting.reconciliation_results(*t.many("fx_check", "fx_attempt", "fx_run"))


@query
def vw_table_load_detail(t: Inputs) -> DataFrame:
    return reporting.table_load_detail(*t.many("fx_attempt", "fx_run"))


@query
def vw_notification_events(t: Inputs) -> DataFrame:
    return reporting.notification_events(*t.many("fx_notification", "fx_config"))


@query
def headline_cards(t: Inputs) -> DataFrame:
    return reporting.headline_cards(_summary(t))


@query
def recent_runs_dashboard(t: Inputs) -> DataFrame:
    return reporting.recent_runs_table(t["fx_run"])


@query
def table_health_dashboard(t: Inputs) -> DataFrame:
    health = reporting.pipeline_health(*t.many("fx_config", "fx_request", "fx_attempt"))
    return reporting.table_health(health)


# --- attempts and runs ------------------------------------------------------------


@query
def latest_attempt_per_config(t: Inputs) -> DataFrame:
    return attempts.latest_attempts(t["fx_attempt"])


@query
def attempt_numbers(t: Inputs) -> DataFrame:
    return attempts.attempt_numbers(t["fx_attempt"]).select(
        "TableLoadAuditId", "AdfPipelineRunId", "ConfigId", "AttemptNumber"
    )


@query
def retry_totals(t: Inputs) -> DataFrame:
    return attempts.retry_totals(t["fx_attempt"])


@query
def finalize_runs(t: Inputs) -> DataFrame:
    return attempts.finalize(t["fx_attempt"])


@query
def datediff_boundary_seconds(t: Inputs) -> DataFrame:
    return t["fx_attempt"].select(
        "TableLoadAuditId", seconds_between("StartedUtc", "CompletedUtc").alias("DurationSeconds")
    )


# --- calendar ---------------------------------------------------------------------


@query
def date_dimension(t: Inputs) -> DataFrame:
    return calendar.date_dimension(t["fx_run"], "StartedUtc")


@query
def runs_by_calendar_rollup(t: Inputs) -> DataFrame:
    return calendar.calendar_rollup(t["fx_run"], "StartedUtc", "runs")


@query
def runs_datepart_join(t: Inputs) -> DataFrame:
    runs = t["fx_run"]
    days = calendar.date_dimension(runs, "StartedUtc").select("Date", "Year", "Quarter")
    return calendar.by_date(runs, "StartedUtc", days, "runs")


@query
def health_datepart_join(t: Inputs) -> DataFrame:
    """The other relationships: runs by completion, tables by both health timestamps, the
    summary by its last success."""
    health = reporting.pipeline_health(*t.many("fx_config", "fx_request", "fx_attempt"))
    days = [
        calendar.related_days(t["fx_run"], {"run_completed": "CompletedUtc"}, "n"),
        calendar.related_days(
            health, {"table_last_success": "LastSuccessfulRunUtc", "table_last_completed": "LastCompletedUtc"}, "n"
        ),
        calendar.related_days(_summary(t), {"summary_last_success": "LastSuccessfulRunUtc"}, "n"),
    ]
    return calendar.fill_days(reduce(DataFrame.unionByName, days), "n")


# --- alerts -----------------------------------------------------------------------


def _alert_logs(t: Inputs) -> list[DataFrame]:
    return t.many("fx_notification", "fx_request", "fx_attempt")


@query
def alerts_success(t: Inputs) -> DataFrame:
    return alerts.success_alerts(*_alert_logs(t))


@query
def alerts_failure(t: Inputs) -> DataFrame:
    return alerts.failure_alerts(*_alert_logs(t))


@query
def alert_payloads(t: Inputs) -> DataFrame:
    return alerts.payloads(alerts.alerts(*_alert_logs(t)), NOW)


# --- rules and evidence -----------------------------------------------------------


@query
def config_validation(t: Inputs) -> DataFrame:
    return validate.validate_config(t["fx_config"])


@query
def log_integrity(t: Inputs) -> DataFrame:
    return validate.validate_logs(
        *t.many("fx_config", "fx_run", "fx_attempt", "fx_check", "fx_request", "fx_history")
    )


@query
def evidence_configuration(t: Inputs) -> DataFrame:
    return lookup.evidence(t["fx_config"], "Configuration", "ConfigId", descending=False)


@query
def evidence_pipeline_audit(t: Inputs) -> DataFrame:
    return lookup.evidence(t["fx_run"], "PipelineAudit", "PipelineRunAuditId")


@query
def evidence_table_audit(t: Inputs) -> DataFrame:
    return lookup.evidence(t["fx_attempt"], "TableAudit", "TableLoadAuditId")


@query
def evidence_reconciliation(t: Inputs) -> DataFrame:
    return lookup.evidence(t["fx_check"], "Reconciliation", "ReconciliationResultId")


@query
def evidence_schema_requests(t: Inputs) -> DataFrame:
    return lookup.evidence(t["fx_request"], "SchemaRFC", "SchemaChangeRequestId")


# --- governed loads with real state -----------------------------------------------


GOVERNED = [
    {
        "SourceTable": "events",
        "TargetTable": "events",
        "Load": "Yes",
        "LoadType": "WATERMARK",
        "WatermarkColumn": "ts",
        "PrimaryKeyColumn": "event_id",
    },
    {
        "SourceTable": "orders",
        "TargetTable": "orders",
        "Load": "Yes",
        "LoadType": "FULL",
        "PrimaryKeyColumn": "o_orderkey",
    },
    {
        "SourceTable": "lineitem",
        "TargetTable": "lineitem",
        "Load": "Yes",
        "LoadType": "FULL",
        "PrimaryKeyColumn": "l_orderkey",
        "RetryCount": 1,
        "RetryIntervalSeconds": 0,
    },
]


def _governed(t: Inputs, published_only: bool) -> Sources:
    events = _published_events if published_only else lambda inputs: inputs["events"]
    frames = {
        ("src", "events"): lambda: events(t),
        ("src", "orders"): lambda: t["orders"],
        ("src", "lineitem"): lambda: t["lineitem"],
    }
    return Sources(t.spark, {}, Frames(frames))


@query
def governed_run_audit(t: Inputs) -> DataFrame:
    """Two runs over three tables; lineitem repeats its key, so gate 1 stops it each time."""
    store = StateStore(t.spark, shared_root(t.spark))
    snapshots = Snapshots(store)
    store.add_configs(GOVERNED)
    for run_id, published_only in (("run-1", True), ("run-2", False)):
        try:
            run_pipeline(store, snapshots, _governed(t, published_only), run_id, parallel=3)
        except LoadError as error:
            if error.code != 50020:
                raise
    checks = store.current(logs.CHECK).groupBy("TableLoadAuditId")
    failed = checks.agg(F.count("*").alias("checks"), F.count_if(F.col("Result") == "FAIL").alias("failed_checks"))
    detail = attempts.attempt_numbers(store.current(logs.ATTEMPT))
    return detail.join(failed, "TableLoadAuditId").select(
        "AdfPipelineRunId",
        "SourceObject",
        "LoadType",
        "IsFirstLoad",
        "AttemptNumber",
        "SourceRowCount",
        "TargetRowCount",
        "Status",
        "checks",
        "failed_checks",
    )


@query
def governed_load_curated(t: Inputs) -> DataFrame:
    """The curated event table after a first load and a delta."""
    store = StateStore(t.spark, shared_root(t.spark))
    snapshots = Snapshots(store)
    store.add_configs(GOVERNED[:1])
    load_table(store, snapshots, _governed(t, True), 1, "run-1")
    load_table(store, snapshots, _governed(t, False), 1, "run-2")
    return snapshots.table(1)


class _Disturbed(Snapshots):
    """Adds rows to a fully loaded folder between the write and gate 2, as a stray writer would."""

    def replace_all(self, old, stage):
        candidate = super().replace_all(old, stage)
        stray = stage.frame.filter(F.col(stage.key) % 10 == 0)
        stray.write.mode("append").parquet(self.store.path(stage.path))
        return candidate


@query
def governed_gate_checks(t: Inputs) -> DataFrame:
    """The checks of one attempt each: a clean first load, a full load that gate 2 stops, and a
    table that gate 1 stops."""
    store = StateStore(t.spark, shared_root(t.spark))
    snapshots = _Disturbed(store)
    store.add_configs(GOVERNED)
    for config_id, code in ((1, None), (2, 50015), (3, 50014)):
        try:
            load_table(store, snapshots, _governed(t, False), config_id, "run-1")
        except LoadError as error:
            if error.code != code:
                raise
    attempt = store.current(logs.ATTEMPT).select("TableLoadAuditId", "SourceObject", "Status")
    checks = store.read(logs.CHECK).select(
        "TableLoadAuditId", "GateStage", "CheckName", "ExpectedValue", "ActualValue", "Result", "Details"
    )
    return checks.join(attempt, "TableLoadAuditId").drop("TableLoadAuditId")


@query
def governed_error_messages(t: Inputs) -> DataFrame:
    """What each kind of failed attempt records: gate 2, gate 1, a lost approved column."""
    store = StateStore(t.spark, shared_root(t.spark))
    snapshots = _Disturbed(store)
    store.add_configs(GOVERNED)
    narrow = {("src", "events"): lambda: t["events"].drop("event_type")}
    for config_id, sources in (
        (2, _governed(t, False)),
        (3, _governed(t, False)),
        (1, _governed(t, False)),
        (1, Sources(t.spark, {}, Frames(narrow))),
    ):
        try:
            load_table(store, snapshots, sources, config_id, "run-1")
        except LoadError:
            continue
    return store.current(logs.ATTEMPT).select("TableLoadAuditId", "SourceObject", "Status", "ErrorMessage")


@query
def governed_empty_table(t: Inputs) -> DataFrame:
    """The columns of a table that its first load, of an empty source, created."""
    store = StateStore(t.spark, shared_root(t.spark))
    snapshots = Snapshots(store)
    store.add_configs(GOVERNED[:1])
    nothing = {("src", "events"): lambda: t["events"].filter("event_id IS NULL")}
    load_table(store, snapshots, Sources(t.spark, {}, Frames(nothing)), 1, "run-1")
    created = snapshots.table(1)
    columns = column_catalog(t.spark, {"events": created}).drop("table", "nullable")
    return columns.withColumn("table_rows", F.lit(created.count()))


class _Planned(RowLevelTables):
    """Keeps a delta as planned: the built-in catalog creates tables but has no MERGE to issue."""

    planned = None

    def commit(self, config_id, audit_id, snapshot):
        if snapshot.merged:
            self.planned = snapshot
        else:
            super().commit(config_id, audit_id, snapshot)


@query
def governed_row_level_delta(t: Inputs) -> DataFrame:
    """A first load into a catalog table, then the rows a MERGE of the delta will leave, as gate 2 counts them."""
    store = StateStore(t.spark, shared_root(t.spark))
    database = f"row_level_{uuid4().hex}"
    t.spark.sql(f"CREATE DATABASE {database} LOCATION '{shared_root(t.spark)}'")
    published = _Planned(store, f"spark_catalog.{database}", "parquet")
    store.add_configs(GOVERNED[:1])
    load_table(store, published, _governed(t, True), 1, "run-1")
    load_table(store, published, _governed(t, False), 1, "run-2")
    return published.frame(published.planned)


@query
def governed_views_by_name(t: Inputs) -> DataFrame:
    """A registered view, read by its name after a load."""
    store = StateStore(t.spark, shared_root(t.spark))
    snapshots = Snapshots(store)
    store.add_configs(GOVERNED[:2])
    for config_id in (1, 2):
        load_table(store, snapshots, _governed(t, False), config_id, "run-1")
    register_views(store)
    return t.spark.sql(
        "SELECT SourceObject, LoadType, IsFirstLoad, AttemptNumber, SourceRowCount, TargetRowCount, Status "
        "FROM vw_TableLoadDetail"
    )


@query
def governed_catalog_views(t: Inputs) -> DataFrame:
    """A catalog view, read by its name in another session, which knows nothing of this library."""
    store = StateStore(t.spark, shared_root(t.spark))
    snapshots = Snapshots(store)
    store.add_configs(GOVERNED[:2])
    database = f"reporting_{uuid4().hex}"
    create_views(store, database)  # before there are any rows
    for config_id in (1, 2):
        load_table(store, snapshots, _governed(t, False), config_id, "run-1")
    return t.spark.newSession().sql(
        "SELECT SourceObject, LoadType, IsFirstLoad, AttemptNumber, SourceRowCount, TargetRowCount, Status "
        f"FROM {database}.vw_TableLoadDetail"
    )


@query
def declared_fingerprint(t: Inputs) -> DataFrame:
    """The fingerprint of a catalog table by its declared types, lengths included."""
    folder, database = shared_root(t.spark), f"declared_{uuid4().hex}"
    t.spark.sql(f"CREATE DATABASE {database} LOCATION '{folder}'")
    t.spark.sql(
        f"CREATE TABLE {database}.customer (c_custkey BIGINT, c_name VARCHAR(40), c_mktsegment CHAR(12), "
        "c_acctbal DECIMAL(18, 3), loaded TIMESTAMP_NTZ) USING parquet"
    )
    rows = t["customer"].select("c_custkey", "c_name", "c_mktsegment", F.col("c_acctbal").cast("decimal(18,3)"), timestamp_literal(T1))
    rows.write.insertInto(f"{database}.customer")
    sources = Sources(t.spark, {})
    source = sources.read(database, "customer")
    fp = fingerprint.fingerprint(source.schema, declared=sources.declared(database, "customer"))
    return source.agg(F.count("*").alias("table_rows"), F.sum("c_acctbal").alias("balance")).select(
        F.lit(fp.definition).alias("SchemaDefinition"), F.lit(fp.hash).alias("SchemaHash"), "table_rows", F.col("balance").cast("decimal(28,3)").alias("balance")
    )


@query
def source_connections(t: Inputs) -> DataFrame:
    """The same table through a folder connection and through the session catalog."""
    root, _, folder = t.sf_dir.rpartition("/")
    name = f"orders_{uuid4().hex}"
    t["orders"].createOrReplaceTempView(name)
    sources = Sources(t.spark, {"lake": ParquetFolder(root), "session": CatalogTables()})
    read = {
        "lake": sources.read(folder, "orders.parquet", "lake"),
        "session": sources.read("", name, "session"),
        "default": sources.read("", name),
    }
    parts = [
        frame.groupBy("o_orderstatus").agg(
            F.lit(reference).alias("reference"),
            F.count("*").alias("source_rows"),
            F.max("o_orderdate").alias("newest"),
        )
        for reference, frame in read.items()
    ]
    return reduce(DataFrame.unionByName, parts)
