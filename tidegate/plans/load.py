"""Load one configured table: fingerprint, stage, gate 1, publish, gate 2, commit."""

from __future__ import annotations

import threading
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field, replace
from datetime import datetime
from uuid import uuid4

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import is_remote

from tidegate.operators import gates, highwater
from tidegate.operators.fingerprint import fingerprint, missing_names
from tidegate.operators.projection import align, by_name
from tidegate.plans import rfc
from tidegate.sources import Sources
from tidegate.state import tables
from tidegate.state import vocabulary as v
from tidegate.state.snapshots import Snapshot, Snapshots, Staged
from tidegate.state.store import StateStore


@dataclass(frozen=True)
class LoadResult:
    table_load_audit_id: int
    config_id: int
    schema_change_detected: bool
    schema_approval_status: str
    status: str


@dataclass
class Attempt:
    """What an attempt has recorded so far."""

    row: dict
    config: dict
    changed: bool
    approval: str | None
    first: bool
    checks: list[dict] = field(default_factory=list)

    @property
    def id(self) -> int:
        return self.row["TableLoadAuditId"]


def load_table(
    store: StateStore,
    snapshots: Snapshots,
    sources: Sources,
    config_id: int,
    run_id: str,
    full_check: bool = True,
    config: dict | None = None,
    limit_seconds: float | None = None,
) -> LoadResult:
    """One attempt. Errors before the attempt row leave no trace; later ones are audited.

    Gate 2 counts every key of the table as it will be published. ``full_check=False`` adds the
    counts that earlier loads found in untouched folders instead. ``config`` is the row as the
    caller has just read it; otherwise it is looked up. After ``limit_seconds`` the attempt's Spark
    jobs, and no others, are cancelled and the attempt fails.
    """
    with store.config_lock(config_id):
        config = config or store.config(config_id)
        if config["Load"] != v.YES:
            raise v.LoadError(50011)
        if config["LoadType"] not in (v.FULL, v.WATERMARK):
            raise v.LoadError(None, f"Unknown LoadType {config['LoadType']!r}.")
        place = (config["SourceSchema"], config["SourceTable"], config["ConnectionReference"])
        source = sources.read(*place)
        fp = fingerprint(source.schema, declared=sources.declared(*place))
        first = config["ApprovedSchemaHash"] is None
        if first:
            config, changed, approval = rfc.establish_baseline(store, config, fp), False, None
        else:
            changed, approval = rfc.detect_change(store, config, fp)
        missing = missing_names(config["ApprovedColumnList"], fp.columns)
        attempt = _start(store, config, run_id, first, changed, approval)
        try:
            with time_limit(store.spark, limit_seconds, f"attempt-{attempt.id}-{uuid4().hex}"):
                done, mark = _load(store, snapshots, sources, source, attempt, missing, full_check)
        except Exception as error:
            _record_failure(store, attempt, error)
            raise
        _record_success(store, attempt, done, mark)
        return LoadResult(attempt.id, config_id, changed, approval or "NONE", v.SUCCESS)


@contextmanager
def time_limit(spark: SparkSession, seconds: float | None, tag: str) -> Iterator[None]:
    """Cancel the jobs this thread starts inside the block once the time is over, and fail it.

    Jobs are found by a tag of this thread, so loads of other tables go on. A block that is done
    when its time ends has succeeded; what it committed is never taken back.
    """
    if seconds is None:
        yield
        return
    # a classic session's own tags are only known to the thread that adds them; the context's are not
    tags = spark if is_remote() else spark.sparkContext
    add, remove, cancel = (
        (tags.addTag, tags.removeTag, tags.interruptTag)
        if is_remote()
        else (tags.addJobTag, tags.removeJobTag, tags.cancelJobsWithTag)
    )
    done, expired = threading.Event(), threading.Event()

    def watch() -> None:
        if done.wait(seconds):
            return
        expired.set()
        while not done.is_set():  # also the jobs that the block starts after the first interrupt
            cancel(tag)
            done.wait(0.5)

    watcher = threading.Thread(target=watch, daemon=True)
    add(tag)
    watcher.start()
    try:
        yield
    except Exception as error:
        if expired.is_set():
            raise v.LoadError(None, v.TIME_LIMIT_MESSAGE.format(seconds=seconds)) from error
        raise
    finally:
        done.set()
        watcher.join()
        remove(tag)


def _load(
    store: StateStore,
    snapshots: Snapshots,
    sources: Sources,
    source: DataFrame,
    attempt: Attempt,
    missing: list[str],
    full_check: bool,
) -> tuple[dict, datetime | None]:
    """Stage, check, publish and commit; the counts of the attempt and the new mark."""
    if missing:
        failed = gates.gate1_of(store.spark, 0, 0, 0, 0, len(missing))
        (row,) = failed.filter(F.col("CheckName") == v.APPROVED_SCHEMA).collect()
        attempt.checks.append({**row.asDict(), "Details": v.MISSING_COLUMN_DETAIL})
        raise v.LoadError(50013)
    config = attempt.config
    old = snapshots.newest(config["ConfigId"])
    marked = config["LoadType"] == v.WATERMARK
    read = _read(sources, source, config, None if old is None else old.mark)
    stage = _stage(store, read.frame, config, attempt, old)
    known = (read.rows, stage.rows, stage.duplicate_keys, stage.null_keys)
    _pass(attempt, gates.gate1_of(store.spark, *known, 0), 50014)

    if not marked:
        candidate = snapshots.replace_all(old, stage)
    elif attempt.first:
        candidate = snapshots.bucketed(old, stage, f"load={attempt.id}")
    else:
        candidate = snapshots.upsert(old, stage, f"load={attempt.id}")
    full = not marked or attempt.first
    if full_check:
        published = snapshots.frame(candidate.snapshot)
        checks = gates.gate2(stage.frame, published, stage.key, full, stage.collation)
    else:
        checks = snapshots.carried_gate2(candidate, stage, full)
    _pass(attempt, checks, 50015)

    mark = read.mark if read.mark is not None or old is None else old.mark
    snapshots.commit(config["ConfigId"], attempt.id, replace(candidate.snapshot, mark=mark))
    counts = {"SourceRowCount": read.rows, "TargetRowCount": candidate.snapshot.total("rows")}
    return counts, mark


def _read(sources: Sources, source: DataFrame, config: dict, last: datetime | None) -> highwater.ObservedRead:
    """The rows to stage. One scan of the source: its rows are counted by the job that stages them.

    The mark is fixed before that read where the source can tell it without a scan, and otherwise
    taken in the same read, which is safe for sources whose files are listed once.
    """
    if config["LoadType"] != v.WATERMARK:
        return highwater.observed_rows(source)
    column = config["WatermarkColumn"]
    found = sources.marks(source, config["SourceSchema"], config["SourceTable"], column, config["ConnectionReference"])
    if found is None:
        return highwater.observed_window(source, column, last)
    return highwater.bounded_window(source, column, last, found.top)


def _stage(
    store: StateStore, window: DataFrame, config: dict, attempt: Attempt, old: Snapshot | None
) -> Staged:
    """Write the window's approved columns once; every later step reads these files.

    Columns the curated table already has keep its types: values are converted or the load
    fails.
    """
    have = by_name(window.schema)
    pinned = by_name(old.schema) if old is not None else {}
    fields = []
    for name in config["ApprovedColumnList"]:
        field = pinned.get(name.lower(), have[name.lower()])
        fields.append(T.StructField(field.name, field.dataType, True))
    schema = T.StructType(fields)
    path = f"staging/config={config['ConfigId']}/load={attempt.id}"
    key = by_name(schema)[config["PrimaryKeyColumn"].lower()].name
    rows, seen = align(window, schema), Observation()
    bounds = gates.key_range_columns(rows, key)
    if bounds:
        rows = rows.observe(seen, F.count("*").alias("rows"), *[c.alias(name) for name, c in bounds.items()])
    rows.write.mode("overwrite").parquet(store.path(path))
    frame = store.spark.read.schema(schema).parquet(store.path(path))
    found = gates.KeyRange(seen.get["rows"], seen.get["low"], seen.get["high"], len(frame.inputFiles())) if bounds else None
    p = gates.measured_profile(frame, key, found, config["KeyCollation"])
    counts = (p["rows"], p["duplicate_keys"], p["null_keys"], p["key_bytes"])
    return Staged(config["ConfigId"], path, frame, schema, key, *counts, config["KeyCollation"])


# --- gates ------------------------------------------------------------------------


def _pass(attempt: Attempt, checks: DataFrame, code: int) -> None:
    """Note the checks of a gate; stop the load if one failed."""
    rows = checks.collect()
    attempt.checks += [row.asDict() for row in rows]
    if gates.any_failed(rows):
        raise v.LoadError(code)


# --- audit ------------------------------------------------------------------------


def _object(schema: str, table: str) -> str:
    return ".".join("[" + part.replace("]", "]]") + "]" for part in (schema, table))


def _start(
    store: StateStore, config: dict, run_id: str, first: bool, changed: bool, approval: str | None
) -> Attempt:
    row = {
        "TableLoadAuditId": store.next_id(tables.ATTEMPT),
        "AdfPipelineRunId": run_id,
        "ConfigId": config["ConfigId"],
        "SourceObject": _object(config["SourceSchema"], config["SourceTable"]),
        "TargetObject": _object(config["TargetSchema"], config["TargetTable"]),
        "LoadType": config["LoadType"],
        "IsFirstLoad": first,
        "SchemaChangeDetected": changed,
        "SchemaApprovalStatus": approval,
        "StartedUtc": store.clock(),
        "Status": v.RUNNING,
    }
    store.append(tables.ATTEMPT, [row])
    return Attempt(row, config, changed, approval, first)


def _check_rows(store: StateStore, attempt: Attempt) -> list[dict]:
    now = store.clock()
    return [
        {
            **check,
            "ReconciliationResultId": store.next_id(tables.CHECK),
            "TableLoadAuditId": attempt.id,
            "CheckedUtc": now,
        }
        for check in attempt.checks
    ]


def _event_rows(store: StateStore, attempt: Attempt, events: list[tuple[str, str]]) -> list[dict]:
    return [
        {
            "NotificationAuditId": store.next_id(tables.NOTIFICATION),
            "AdfPipelineRunId": attempt.row["AdfPipelineRunId"],
            "ConfigId": attempt.config["ConfigId"],
            "EventType": event,
            "DeliveryStatus": v.PENDING,
            "Message": message,
            "CreatedUtc": store.clock(),
        }
        for event, message in events
    ]


def _record(
    store: StateStore, attempt: Attempt, config: dict, outcome: dict, events: list[tuple[str, str]]
) -> None:
    """Close an attempt: configuration state, both gates' checks, outcome and notifications."""
    store.append_all(
        {
            tables.CONFIG: [store.changed_config(attempt.config, **config)],
            tables.CHECK: _check_rows(store, attempt),
            tables.ATTEMPT: [{**attempt.row, "CompletedUtc": store.clock(), **outcome}],
            tables.NOTIFICATION: _event_rows(store, attempt, events),
        }
    )


def _record_success(
    store: StateStore, attempt: Attempt, counts: dict, mark: datetime | None
) -> None:
    config = {
        "LastWatermarkValue": mark,
        "LastRunStatus": v.SUCCESS,
        "LastSuccessfulRunUtc": store.clock(),
    }
    event = (
        (v.SCHEMA_CHANGE, v.CHANGE_MESSAGE) if attempt.changed else (v.TABLE_SUCCESS, v.SUCCESS_MESSAGE)
    )
    _record(store, attempt, config, {**counts, "Status": v.SUCCESS}, [event])


def _record_failure(store: StateStore, attempt: Attempt, error: Exception) -> None:
    message = str(error)
    events = [(v.TABLE_FAILURE, message)]
    if attempt.changed:
        text = v.CHANGE_FAILURE_MESSAGE.format(status=attempt.approval or v.PENDING, error=message)
        events.insert(0, (v.SCHEMA_CHANGE, text))
    outcome = {"Status": v.FAILURE, "ErrorMessage": message}
    _record(store, attempt, {"LastRunStatus": v.FAILURE}, outcome, events)
