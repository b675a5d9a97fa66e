"""Run all enabled tables: isolate failures, repeat failed tables, finalize, fill the outbox."""

from __future__ import annotations

import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime

from pyspark import inheritable_thread_target
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql.utils import is_remote

from tidegate.functions import timestamp_literal
from tidegate.operators import alerts, attempts, lookup
from tidegate.plans.load import LoadResult, load_table
from tidegate.sources import Sources
from tidegate.state import tables
from tidegate.state import vocabulary as v
from tidegate.state.snapshots import Snapshots
from tidegate.state.store import StateStore


# a run without attempts has no failed table
NO_ATTEMPTS = {
    "SuccessfulTableCount": 0,
    "FailedTableCount": 0,
    "Status": v.SUCCESS,
    "Message": "0 table(s) succeeded; 0 table(s) failed.",
}


@dataclass(frozen=True)
class RunResult:
    status: str
    message: str
    results: dict[int, LoadResult | Exception]


def _own(run_id: str):
    return F.col("AdfPipelineRunId") == run_id


def start_run(store: StateStore, run_id: str, name: str, enabled: int | None = None) -> dict:
    """Record the run once; a second call with the same id changes nothing."""
    row = store.latest_row(tables.RUN, _own(run_id))
    if row is not None:
        return row
    if enabled is None:
        enabled = lookup.enabled_configs(store.current(tables.CONFIG)).count()
    row = {
        "PipelineRunAuditId": store.next_id(tables.RUN),
        "AdfPipelineRunId": run_id,
        "PipelineName": name,
        "StartedUtc": store.clock(),
        "Status": v.RUNNING,
        "EnabledTableCount": enabled,
    }
    store.append(tables.RUN, [row])
    return row


def finalize_run(store: StateStore, run_id: str) -> tuple[str, str]:
    """Close the run with the outcome of each table's latest attempt.

    The outcome is recorded first; then 50020 is raised if any table failed.
    """
    row = store.latest_row(tables.RUN, _own(run_id))
    since = row["StartedUtc"] if row else None
    own = store.current(tables.ATTEMPT, _own(run_id), since)
    found = attempts.finalize(own).drop("AdfPipelineRunId").first()
    outcome = found.asDict() if found else dict(NO_ATTEMPTS)
    if row:
        store.append(tables.RUN, [{**row, **outcome, "CompletedUtc": store.clock()}])
    if outcome["FailedTableCount"]:
        raise v.LoadError(50020)
    return outcome["Status"], outcome["Message"]


def close_published(store: StateStore) -> int:
    """Close attempts that published but were lost before their outcome was written.

    A commit names its attempt, so an attempt that is RUNNING and has a commit did succeed. A store's
    first run begins with it; attempts without a commit stay RUNNING. Returns how many were closed;
    as many rows come to the driver.
    """
    folder = store.path("commit")
    if not store.exists(folder):
        return 0
    commits = store.spark.read.schema(tables.COMMIT_COLUMNS).parquet(folder).select(
        "TableLoadAuditId",
        F.aggregate("Parts", F.lit(0).cast("bigint"), lambda n, part: n + part["rows"]).alias("rows"),
        "LastWatermarkValue",
        "CommittedUtc",
    )
    running = store.current(tables.ATTEMPT, None).filter(F.col("Status") == v.RUNNING)
    found = running.join(commits, "TableLoadAuditId").collect()
    for row in map(Row.asDict, found):
        outcome = {
            **{name: row[name] for name in tables.ATTEMPT.fields},
            "TargetRowCount": row["rows"],
            "CompletedUtc": row["CommittedUtc"],
            "Status": v.SUCCESS,
        }
        with store.config_lock(row["ConfigId"]):
            changes = {
                "LastWatermarkValue": row["LastWatermarkValue"],
                "LastRunStatus": v.SUCCESS,
                "LastSuccessfulRunUtc": row["CommittedUtc"],
            }
            store.update_config(store.config(row["ConfigId"]), **changes)
            store.append(tables.ATTEMPT, [outcome])
    return len(found)


def fill_outbox(store: StateStore, run_id: str, since: datetime | None = None) -> None:
    """Append the JSON events of the run's alerts; delivery is someone else's work."""
    now = store.clock()
    selected = alerts.alerts(
        # notifications never change, so their versions need no grouping
        store.read(tables.NOTIFICATION, _own(run_id), since),
        store.current(tables.REQUEST),
        store.current(tables.ATTEMPT, _own(run_id), since),
    )
    events = alerts.payloads(selected, now).withColumn("CreatedUtc", timestamp_literal(now))
    store.append_frame(tables.OUTBOX, events)


def run_pipeline(
    store: StateStore,
    snapshots: Snapshots,
    sources: Sources,
    run_id: str,
    name: str = "governed-load",
    parallel: int = 2,
    sleep: Callable[[float], None] = time.sleep,
    full_check: bool = True,
    limit_seconds: float | None = 1200,
) -> RunResult:
    """Load every enabled table, ``parallel`` at a time, then finalize and raise on failure.

    An attempt that takes longer than ``limit_seconds`` is ended, recorded as failed and repeated like
    any other failure, while the other tables load. Every table has a scheduler pool of its own,
    so under ``spark.scheduler.mode=FAIR`` a large one leaves cores to the others.
    """
    if store.first_run():
        close_published(store)
    # one read of the configuration log serves the first attempt of every table
    enabled = store.current(tables.CONFIG).filter(F.col("Load") == v.YES).orderBy("ConfigId")
    configs = [row.asDict() for row in enabled.collect()]
    run = start_run(store, run_id, name, len(configs))

    def load(config: dict) -> LoadResult | Exception:
        tries_left, known = config["RetryCount"], config
        if not is_remote():
            store.spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"table-{config['ConfigId']}")
        while True:
            try:
                return load_table(
                    store, snapshots, sources, config["ConfigId"], run_id, full_check, known, limit_seconds
                )
            except Exception as error:  # a failing table never stops the others
                known = None  # the failed attempt has changed the row
                if not tries_left:
                    return error
                tries_left -= 1
                sleep(config["RetryIntervalSeconds"])

    with ThreadPoolExecutor(max_workers=parallel) as pool:
        # wrapped once per table: every wrapper has job properties of its own, and with them tags and pool
        work = [pool.submit(inheritable_thread_target(store.spark)(load), config) for config in configs]
        results = {config["ConfigId"]: done.result() for config, done in zip(configs, work)}
    fill_outbox(store, run_id, run["StartedUtc"])
    status, message = finalize_run(store, run_id)
    return RunResult(status, message, results)
