"""Append-only state on a shared folder: rows are added, the newest version of a key counts.

An update appends the whole row again under a higher sequence number. One append writes one
file, which the output committer renames into place, so readers see a row entirely or not at
all. Ids and sequence numbers are handed out by the one driver that owns the folder.
"""

from __future__ import annotations

import itertools
import threading
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timezone

import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.logger import PySparkLogger
from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidegate.functions.clock import timestamp_literal
from tidegate.operators.keys import COLLATIONS
from tidegate.operators.lookup import newest_rows
from tidegate.operators.publish import insert_absent
from tidegate.state import tables
from tidegate.state import vocabulary as v
from tidegate.state.tables import Log

# asking for a path that is not there is no error worth a stack trace in the log
PySparkLogger.getLogger("SQLQueryContextLogger").addFilter(lambda record: "PATH_NOT_FOUND" not in record.getMessage())

DEFAULTS = {
    "SourceSchema": "src",
    "TargetSchema": "curated",
    "RetryCount": 3,
    "RetryIntervalSeconds": 15,
}


REQUIRED = ("SourceSchema", "SourceTable", "TargetSchema", "TargetTable", "Load", "LoadType", "PrimaryKeyColumn")


def check_configs(rows: list[dict]) -> None:
    """Refuse rows with unknown fields, missing or unknown values, or a source given twice."""
    known, sources = set(tables.CONFIG.schema.fieldNames()), set()
    for row in rows:
        source = (row.get("SourceSchema"), row.get("SourceTable"))
        problems = [f"unknown field {name}" for name in sorted(set(row) - known)]
        problems += [f"{name} is missing" for name in REQUIRED if not row.get(name)]
        if row.get("Load") not in (None, v.YES, v.NO):
            problems.append(f"unknown Load {row['Load']!r}")
        if row.get("LoadType") not in (None, v.FULL, v.WATERMARK):
            problems.append(f"unknown LoadType {row['LoadType']!r}")
        if row.get("KeyCollation") not in (None, *COLLATIONS):
            problems.append(f"unknown KeyCollation {row['KeyCollation']!r}")
        if row.get("LoadType") == v.WATERMARK and not row.get("WatermarkColumn"):
            raise v.LoadError(51003)
        if source in sources:
            problems.append("the source is given twice")
        sources.add(source)
        if problems:
            raise v.LoadError(None, f"Configuration of {source[0]}.{source[1]}: {'; '.join(problems)}.")


def utc_now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def local_frame(spark: SparkSession, rows: list[dict], schema: T.StructType) -> DataFrame:
    """A handful of driver rows as a one-partition local relation; no Python worker takes part.

    A field the schema lacks is an error: it would be dropped without a word.
    """
    unknown = {name for row in rows for name in row} - set(schema.fieldNames())
    if unknown:
        raise ValueError(f"unknown fields: {', '.join(sorted(unknown))}")
    table = pa.Table.from_pylist(rows, schema=to_arrow_schema(schema))
    return spark.createDataFrame(table, schema).coalesce(1)


class StateStore:
    def __init__(self, spark: SparkSession, root: str, clock: Callable[[], datetime] = utc_now):
        self.spark, self.root, self.clock = spark, root.rstrip("/"), clock
        self._guard = threading.RLock()
        self._fresh = True
        self._ids: dict[str, itertools.count] = {}
        self._seqs: dict[str, itertools.count] = {}
        self._config_locks: dict[int, threading.RLock] = {}
        # two jobs that append to one folder would clear each other's temporary files
        self._log_locks = {log.name: threading.Lock() for log in tables.LOGS}
        with ThreadPoolExecutor(max_workers=len(tables.LOGS)) as pool:
            for done in [pool.submit(inheritable_thread_target(spark)(self._ensure), log) for log in tables.LOGS]:
                done.result()

    def first_run(self) -> bool:
        """Whether no run has begun with this store object: only then can another driver's attempts be open."""
        with self._guard:
            first, self._fresh = self._fresh, False
        return first

    # --- logs ---------------------------------------------------------------------

    def path(self, *parts: str) -> str:
        return "/".join([self.root, *parts])

    def _ensure(self, log: Log) -> None:
        ids, seqs = 0, 0
        if self.exists(self.path("log", log.name)):
            key = F.max(log.key) if log.key else F.lit(0)
            last = self.read(log).agg(key.alias("id"), F.max("_seq").alias("seq")).first()
            ids, seqs = last["id"] or 0, last["seq"] or 0
        else:
            self._write(local_frame(self.spark, [], log.schema), log)
        self._ids[log.name], self._seqs[log.name] = itertools.count(ids + 1), itertools.count(seqs + 1)

    def exists(self, path: str) -> bool:
        """Whether the shared folder has this path, asked of a file source, so any kind of session can."""
        try:
            return bool(self.spark.read.schema("_any int").parquet(path).columns)
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return False
            raise

    def _write(self, rows: DataFrame, log: Log) -> None:
        rows.write.mode("append").partitionBy("LogDate").parquet(self.path("log", log.name))

    def next_id(self, log: Log) -> int:
        with self._guard:
            return next(self._ids[log.name])

    def append(self, log: Log, rows: Iterable[dict]) -> None:
        """Add row versions of one table load or run; a handful of rows each."""
        rows = list(rows)
        if not rows:
            return
        with self._log_locks[log.name]:
            stamp = {"LogDate": self.clock().date()}
            numbered = [{**r, **stamp, "_seq": next(self._seqs[log.name])} for r in rows]
            self._write(local_frame(self.spark, numbered, log.schema), log)

    def append_frame(self, log: Log, rows: DataFrame) -> None:
        """Append the rows of a query, written by its tasks; every row has a sequence number of its own."""
        with self._log_locks[log.name]:
            begin, seen = next(self._seqs[log.name]), Observation()
            stamped = rows.withColumns(
                {
                    "_seq": F.lit(begin).cast("bigint") + F.monotonically_increasing_id(),
                    "LogDate": F.lit(self.clock().date()),
                }
            )
            self._write(stamped.select(log.schema.fieldNames()).observe(seen, F.max("_seq").alias("last")), log)
            last = seen.get["last"]
            self._seqs[log.name] = itertools.count((begin if last is None else last) + 1)

    def append_all(self, rows: dict[Log, list[dict]]) -> None:
        """Append to several logs at once; each small write is mostly waiting."""
        with ThreadPoolExecutor(max_workers=len(rows)) as pool:
            # wrapped once per log: a wrapper's job properties are shared by the calls made through it
            for done in [pool.submit(inheritable_thread_target(self.spark)(self.append), *item) for item in rows.items()]:
                done.result()

    def read(
        self, log: Log, where: Column | None = None, since: datetime | None = None
    ) -> DataFrame:
        """All versions of all rows, or of some; days before ``since`` are pruned."""
        versions = self.spark.read.schema(log.schema).parquet(self.path("log", log.name))
        if where is not None:
            versions = versions.filter(where)
        if since is not None:
            versions = versions.filter(F.col("LogDate") >= timestamp_literal(since).cast("date"))
        return versions

    def current(
        self, log: Log, where: Column | None = None, since: datetime | None = None
    ) -> DataFrame:
        """The newest version of each row.

        ``where`` must hold for all versions of a row or none; it and ``since`` apply at the
        scan, before versions are grouped.
        """
        versions = self.read(log, where, since)
        return newest_rows(versions, [log.key], "_seq").select(*log.fields)

    def latest_row(self, log: Log, where: Column) -> dict | None:
        """The newest version of the one row ``where`` names."""
        newest = self.read(log, where).orderBy(F.desc("_seq")).select(*log.fields).limit(1)
        row: Row | None = newest.first()
        return None if row is None else row.asDict()

    # --- configuration ------------------------------------------------------------

    def config_lock(self, config_id: int) -> threading.RLock:
        """Loads and decisions of one configuration take turns."""
        with self._guard:
            return self._config_locks.setdefault(config_id, threading.RLock())

    def add_configs(self, rows: Iterable[dict]) -> None:
        """Insert configurations whose source is not configured yet; refuse invalid ones as a whole."""
        now = self.clock()
        new = [{**DEFAULTS, **r, "CreatedUtc": now, "ModifiedUtc": now} for r in rows]
        check_configs(new)
        if not new:
            return
        sources = [{"SourceSchema": r["SourceSchema"], "SourceTable": r["SourceTable"]} for r in new]
        names = T.StructType.fromDDL("SourceSchema string, SourceTable string")
        known = self.current(tables.CONFIG).select("SourceSchema", "SourceTable")
        fresh = insert_absent(known, local_frame(self.spark, sources, names), ["SourceSchema", "SourceTable"])
        wanted = {tuple(r) for r in fresh.collect()}  # no more than were given
        new = [r for r in new if (r["SourceSchema"], r["SourceTable"]) in wanted]
        self.append(tables.CONFIG, [{**r, "ConfigId": self.next_id(tables.CONFIG)} for r in new])

    def config(self, config_id: int) -> dict:
        """One configuration row; 50010 when there is none."""
        row = self.latest_row(tables.CONFIG, F.col("ConfigId") == config_id)
        if row is None:
            raise v.LoadError(50010)
        return row

    def update_config(self, row: dict, **changes) -> dict:
        """Append the row's next version; the caller holds the configuration's lock."""
        updated = self.changed_config(row, **changes)
        self.append(tables.CONFIG, [updated])
        return updated

    def changed_config(self, row: dict, **changes) -> dict:
        return {**row, **changes, "ModifiedUtc": self.clock()}

    # --- requests -----------------------------------------------------------------

    def has_initial_request(self, config_id: int, digest: str) -> bool:
        """Whether the first-load approval of this very schema is on record; it never changes."""
        own = (F.col("ConfigId") == config_id) & (F.col("DetectedSchemaHash") == digest)
        return not self.read(tables.REQUEST, own & (F.col("DecisionBy") == v.INITIAL_LOAD)).isEmpty()

    def request(self, request_id: int) -> dict | None:
        return self.latest_row(tables.REQUEST, F.col("SchemaChangeRequestId") == request_id)
