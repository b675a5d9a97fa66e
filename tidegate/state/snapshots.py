"""Curated tables: immutable files plus a commit row that names them.

A commit lists the folders that make up the table and carries the high-water mark, so data
and mark move together. Readers take the newest commit of a configuration; files written by
a load that never commits are not part of any table.

A table loaded by high-water mark is split by a hash of its key into ``buckets`` folders.
A delta rewrites the buckets its keys fall into and keeps the folders of the others. The key
counts of every folder are in the commit, so a whole-table check adds up what is known of
untouched folders and recounts the rewritten ones.
"""

from __future__ import annotations

import json
import threading
from dataclasses import asdict, dataclass, replace
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.functions.text import quoted
from tidegate.operators.gates import gate2_of, key_profile, reconcile
from tidegate.operators.keys import hashable
from tidegate.operators.projection import align, evolve
from tidegate.operators.publish import survivors
from tidegate.state import tables
from tidegate.state.store import StateStore, local_frame

BUCKET = "_bucket"
WHOLE = -1  # bucket number of a folder that is not split by key


@dataclass(frozen=True)
class Part:
    bucket: int
    path: str
    rows: int
    duplicate_keys: int
    null_keys: int


@dataclass(frozen=True)
class Snapshot:
    schema: T.StructType
    key: str
    buckets: int
    parts: tuple[Part, ...] = ()
    mark: datetime | None = None
    collation: str | None = None  # under which the buckets were dealt

    def total(self, measure: str) -> int:
        return sum(getattr(p, measure) for p in self.parts)


@dataclass(frozen=True)
class Candidate:
    """A published state before its gate: the snapshot and staged keys it lacks."""

    snapshot: Snapshot
    missing_keys: int


@dataclass(frozen=True)
class Staged:
    """A staged window: its files, and the key counts of gate 1."""

    config_id: int
    path: str
    frame: DataFrame
    schema: T.StructType
    key: str
    rows: int
    duplicate_keys: int
    null_keys: int
    key_bytes: int
    collation: str | None = None


@dataclass(frozen=True)
class Layout:
    """Sizing of key buckets and of the staged keys a join may broadcast."""

    rows_per_bucket: int = 4_000_000
    broadcast_key_bytes: int = 32 << 20

    def buckets_for(self, rows: int) -> int:
        return max(1, -(-rows // self.rows_per_bucket))

    def outgrown(self, snapshot: Snapshot, added: int) -> bool:
        """Whether the buckets hold over twice their planned rows and more may be made."""
        rows = snapshot.total("rows") + added
        return self.buckets_for(rows) > 2 * snapshot.buckets


def bucket_of(key: Column, buckets: int, collation: str | None = None) -> Column:
    return F.pmod(F.xxhash64(hashable(key, collation)), F.lit(buckets).cast("bigint")).cast("int")


class Snapshots:
    def __init__(self, store: StateStore, layout: Layout = Layout()):
        self.store, self.spark, self.layout = store, store.spark, layout
        self._known: dict[int, tuple[int, Snapshot | None]] = {}
        self._guard = threading.Lock()

    # --- commits ------------------------------------------------------------------

    def _load(self, config_id: int) -> tuple[int, Snapshot | None]:
        path = self.store.path("commit", f"config={config_id}")
        if not self.store.exists(path):
            return 0, None
        commits = self.spark.read.schema(tables.COMMIT_COLUMNS).parquet(path)
        last = commits.agg(F.max("CommitId").alias("id")).first()["id"]
        row = commits.filter(F.col("CommitId") == last).first()
        parts = tuple(Part(**p.asDict()) for p in row["Parts"])
        schema = T.StructType.fromJson(json.loads(row["SchemaJson"]))
        return last, Snapshot(
            schema, row["KeyColumn"], row["Buckets"], parts, row["LastWatermarkValue"], row["KeyCollation"]
        )

    def newest(self, config_id: int) -> Snapshot | None:
        with self._guard:
            if config_id not in self._known:
                self._known[config_id] = self._load(config_id)
            return self._known[config_id][1]

    def commit(self, config_id: int, audit_id: int | None, snapshot: Snapshot) -> None:
        """Make the snapshot the table: one row, one file, one rename."""
        self.newest(config_id)
        commit_id = self._known[config_id][0] + 1
        row = {
            "CommitId": commit_id,
            "ConfigId": config_id,
            "TableLoadAuditId": audit_id,
            "SchemaJson": snapshot.schema.json(),
            "KeyColumn": snapshot.key,
            "KeyCollation": snapshot.collation,
            "Buckets": snapshot.buckets,
            "Parts": [asdict(p) for p in snapshot.parts],
            "LastWatermarkValue": snapshot.mark,
            "CommittedUtc": self.store.clock(),
        }
        frame = local_frame(self.spark, [row], T.StructType.fromDDL(tables.COMMIT_COLUMNS))
        path = self.store.path("commit", f"config={config_id}")
        frame.write.mode("append").parquet(path)
        with self._guard:
            self._known[config_id] = (commit_id, snapshot)

    # --- reading ------------------------------------------------------------------

    def frame(self, snapshot: Snapshot, buckets: set[int] | None = None) -> DataFrame:
        """The snapshot's rows, or those of some buckets; absent columns read as NULL."""
        paths = [
            self.store.path(p.path)
            for p in snapshot.parts
            if buckets is None or p.bucket in buckets
        ]
        if not paths:
            return self.spark.createDataFrame([], snapshot.schema)
        return self.spark.read.schema(snapshot.schema).parquet(*paths)

    def table(self, config_id: int) -> DataFrame | None:
        snapshot = self.newest(config_id)
        return None if snapshot is None else self.frame(snapshot)

    def live_paths(self, config_id: int) -> list[str]:
        """The folders the newest commit names; others of the configuration are not read."""
        snapshot = self.newest(config_id)
        return [self.store.path(p.path) for p in snapshot.parts] if snapshot else []

    # --- publishing ---------------------------------------------------------------

    def replace_all(self, old: Snapshot | None, stage: Staged) -> Candidate:
        """The staged files become the table without being copied.

        They are immutable and were profiled at gate 1, so their key counts carry over; only
        the row count is read again, from file footers.
        """
        schema = stage.schema if old is None else evolve(old.schema, stage.schema)
        whole = Part(WHOLE, stage.path, stage.rows, stage.duplicate_keys, stage.null_keys)
        snapshot = Snapshot(schema, stage.key, 0, (whole,), collation=stage.collation)
        counted = replace(whole, rows=self.frame(snapshot).count())
        return Candidate(replace(snapshot, parts=(counted,)), stage.null_keys)

    def upsert(self, old: Snapshot | None, stage: Staged, version: str) -> Candidate:
        """Staged rows replace rows of the same key; other rows stay."""
        if old is None:
            buckets = self.layout.buckets_for(stage.rows)
            old = Snapshot(stage.schema, stage.key, buckets, collation=stage.collation)
        schema = evolve(old.schema, stage.schema)
        if stage.rows == 0:
            return Candidate(replace(old, schema=schema), 0)
        staged = align(stage.frame, schema)
        regroup = (
            old.buckets == 0
            or (old.key, old.collation) != (stage.key, stage.collation)
            or self.layout.outgrown(old, stage.rows)
        )
        if regroup:
            buckets, touched = self.layout.buckets_for(old.total("rows") + stage.rows), None
        else:
            buckets = old.buckets
            hit = staged.select(bucket_of(F.col(quoted(stage.key)), buckets, stage.collation).alias(BUCKET))
            touched = {r[BUCKET] for r in hit.distinct().collect()}  # at most one per bucket
        stays = () if touched is None else tuple(p for p in old.parts if p.bucket not in touched)
        previous = align(self.frame(old, touched), schema)
        path = f"curated/config={stage.config_id}/{version}"
        self._write(previous, staged, stage, buckets, path, regroup)
        written, missing = self._profile(staged, stage, schema, buckets, path)
        snapshot = Snapshot(schema, stage.key, buckets, (*stays, *written), collation=stage.collation)
        return Candidate(snapshot, missing)

    def bucketed(self, old: Snapshot | None, stage: Staged, version: str) -> Candidate:
        """A full replace that is split by key, ready for later upserts."""
        schema = stage.schema if old is None else evolve(old.schema, stage.schema)
        buckets = self.layout.buckets_for(stage.rows)
        empty = Snapshot(schema, stage.key, buckets, collation=stage.collation)
        if stage.rows == 0:
            return Candidate(empty, 0)
        return self.upsert(empty, stage, version)

    def adopt(self, config_id: int, df: DataFrame, key: str, mark: datetime | None = None) -> None:
        """Take over an existing table as the curated state of a configuration, as it is."""
        self.newest(config_id)
        path = f"curated/config={config_id}/adopted-{self._known[config_id][0] + 1}"
        df.write.mode("overwrite").parquet(self.store.path(path))
        whole = Snapshot(df.schema, key, 0, (Part(WHOLE, path, 0, 0, 0),), mark)
        p = key_profile(self.frame(whole), key).first()
        part = Part(WHOLE, path, p["rows"], p["duplicate_keys"], p["null_keys"])
        self.commit(config_id, None, replace(whole, parts=(part,)))

    def _write(
        self,
        previous: DataFrame,
        staged: DataFrame,
        stage: Staged,
        buckets: int,
        path: str,
        regroup: bool,
    ) -> None:
        """Write surviving and staged rows of the touched buckets.

        Staged keys within the measured broadcast bound leave the previous rows in the files'
        own grouping: they are read, filtered and written without a shuffle. Otherwise the join
        moves them, and everything is brought together by bucket before the write.
        """
        number = bucket_of(F.col(quoted(stage.key)), buckets, stage.collation)
        small = stage.key_bytes <= self.layout.broadcast_key_bytes
        kept = align(survivors(previous, staged, stage.key, small, stage.collation), staged.schema)
        kept, staged = kept.withColumn(BUCKET, number), staged.withColumn(BUCKET, number)
        if small and not regroup:
            rows = kept.unionByName(staged.hint("rebalance", F.col(BUCKET)))
        else:
            rows = kept.unionByName(staged).hint("rebalance", F.col(BUCKET))
        rows.write.mode("overwrite").partitionBy(BUCKET).parquet(self.store.path(path))

    def _profile(
        self, staged: DataFrame, stage: Staged, schema: T.StructType, buckets: int, path: str
    ) -> tuple[tuple[Part, ...], int]:
        """Key counts of the written buckets, and staged keys that did not arrive."""
        written = self.spark.read.schema(schema).parquet(self.store.path(path))
        number = bucket_of(F.col("k"), buckets, stage.collation)
        counts = reconcile(staged, written, stage.key, number, stage.collation).collect()
        parts = tuple(
            Part(
                r["bucket"],
                f"{path}/{BUCKET}={r['bucket']}",
                r["target_rows"],
                r["duplicate_keys"],
                r["null_keys"],
            )
            for r in sorted(counts, key=lambda r: r["bucket"])
            if r["target_rows"]
        )
        return parts, sum(r["missing_keys"] for r in counts)

    def carried_gate2(self, candidate: Candidate, stage: Staged, full: bool) -> DataFrame:
        """Gate 2 from the counts of rewritten folders and those known of the others."""
        table = candidate.snapshot
        counts = (table.total(m) for m in ("rows", "duplicate_keys", "null_keys"))
        return gate2_of(self.spark, stage.rows, *counts, candidate.missing_keys, full)
