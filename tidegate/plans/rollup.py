"""Partials of finished log days, written once; the summary reads them and scans unfinished days only."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.operators import rollup
from tidegate.plans.reporting import dashboard_summary
from tidegate.state import tables
from tidegate.state import vocabulary as v
from tidegate.state.store import StateStore

DAYS = "day date, attempts bigint, new_pairs bigint, rows_processed bigint, failed_checks bigint"
PAIRS = "AdfPipelineRunId string, ConfigId int, day date"


def _written(store: StateStore, name: str, schema: str) -> DataFrame:
    path = store.path("rollup", name)
    if not store.exists(path):
        return store.spark.createDataFrame([], schema)
    return store.spark.read.schema(schema).parquet(path)


def _finished_to(store: StateStore) -> date | None:
    """The last day that has been rolled up, with all days before it."""
    return _written(store, "days", DAYS).agg(F.max("day")).first()[0]


def _measured(store: StateStore, last: date | None, wanted: Column) -> tuple[DataFrame, DataFrame]:
    """(new pairs, partials) of the log days for which ``wanted`` holds; it prunes the logs' folders."""
    attempts = store.read(tables.ATTEMPT, wanted)
    # an attempt is logged when it begins, and once more when it has ended
    begun = attempts.filter(F.col("Status") == v.RUNNING)
    done = attempts.filter(F.col("Status") == v.SUCCESS)
    # pairs of later days are those of a call that was lost before it wrote its days
    seen = _written(store, "pairs", PAIRS).filter(F.lit(False) if last is None else F.col("day") <= F.lit(last))
    fresh = rollup.new_pairs(begun, seen, "LogDate")
    return fresh, rollup.day_partials(begun, done, store.read(tables.CHECK, wanted), fresh, "LogDate")


def roll_up(store: StateStore, today: date) -> int:
    """Write the partials of all days before ``today`` that have none; how many days had facts.

    The days are written last and in one file, so a call that is lost leaves nothing that counts,
    and the next call does its work again. One driver owns a state folder.
    """
    last = _finished_to(store)
    wanted = F.col("LogDate") < F.lit(today)
    if last is not None:
        wanted &= F.col("LogDate") > F.lit(last)
    fresh, days = _measured(store, last, wanted)
    fresh.write.mode("append").parquet(store.path("rollup", "pairs"))
    days.coalesce(1).write.mode("append").parquet(store.path("rollup", "days"))  # one row a day
    written = _written(store, "days", DAYS)
    return (written if last is None else written.filter(F.col("day") > F.lit(last))).count()


def summary(store: StateStore) -> DataFrame:
    """``reporting.dashboard_summary`` from the partials and the days that have none yet.

    Configurations, runs and requests are read as they are: they have few rows, and their
    states change.
    """
    last = _finished_to(store)
    written = _written(store, "days", DAYS)
    _, live = _measured(store, last, F.lit(True) if last is None else F.col("LogDate") > F.lit(last))
    measures = rollup.merged(written.unionByName(live))
    config, run, request = (store.current(log) for log in (tables.CONFIG, tables.RUN, tables.REQUEST))
    nothing = store.read(tables.ATTEMPT, F.lit(False)), store.read(tables.CHECK, F.lit(False))
    rest = dashboard_summary(config, run, nothing[0], nothing[1], request)
    both = rest.drop(*measures.columns).unionByName(measures, allowMissingColumns=True)
    return both.agg(*[F.max(name).alias(name) for name in rest.columns])
