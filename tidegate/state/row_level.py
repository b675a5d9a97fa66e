"""Curated tables of a catalog that offers MERGE: its own commit publishes, no file is managed here.

A publisher for ``run_pipeline`` in place of ``Snapshots``, chosen by passing it. Staging, gates, commit
rows and marks are the same; what differs is where the rows live:

* the first load creates ``namespace.TargetTable``, a full load overwrites it, a delta is one MERGE by key,
  after ALTER TABLE for columns the table lacks;
* gate 2 counts the rows as the statement will leave them, before it is issued. Only keys are read for
  that, and nothing has to be undone when it fails;
* the commit row with the mark follows the statement. A driver lost in between repeats the same window,
  which changes nothing: every statement here gives the same rows when it is run again.

A delta replaces whole rows: columns that only the table has become NULL in matched rows. Keys of the table
are unique, which ``adopt`` checks of tables from elsewhere; gate 1 has checked the staged ones.

The table belongs to one configuration, named by the property ``OWNER``. A table that exists without it is
not touched. No other writer may change keys between gate 2 and the statement; a catalog with
optimistic commits refuses one that does so meanwhile.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.functions.text import quoted
from tidegate.operators.gates import key_profile, reconcile
from tidegate.operators.projection import align, by_name, evolve
from tidegate.operators.publish import overwrite, upsert
from tidegate.state.snapshots import WHOLE, Candidate, Part, Snapshot, Snapshots, Staged
from tidegate.state.store import StateStore
from tidegate.state.vocabulary import LoadError

OWNER = "tidegate.config"


def add_column_statements(table: str, have: T.StructType, want: T.StructType) -> list[str]:
    """One statement per column of ``want`` that the table lacks."""
    known = by_name(have)
    return [
        f"ALTER TABLE {table} ADD COLUMN {quoted(f.name)} {f.dataType.simpleString()}"
        for f in want.fields
        if f.name.lower() not in known
    ]


def merge_statement(
    table: str, stage: str, schema: T.StructType, staged: T.StructType, key: str, collation: str | None = None
) -> str:
    """The keyed upsert of a stage with different keys, none of them NULL, into a table with ``schema``."""
    ours, theirs = by_name(schema), by_name(staged)

    def compared(side: str, field: T.StructField) -> str:
        text = f"{side}.{quoted(field.name)}"
        if collation is None or not isinstance(field.dataType, T.StringType):
            return text
        return f"collate({text}, '{collation}')"

    def value(field: T.StructField) -> str:
        found = theirs.get(field.name.lower())
        if found is None:
            return "NULL"
        text = f"s.{quoted(found.name)}"
        return text if found.dataType == field.dataType else f"CAST({text} AS {field.dataType.simpleString()})"

    names = [quoted(f.name) for f in schema.fields]
    values = [value(f) for f in schema.fields]
    match = f"{compared('t', ours[key.lower()])} = {compared('s', theirs[key.lower()])}"
    return (
        f"MERGE INTO {table} AS t USING {stage} AS s ON {match}"
        f" WHEN MATCHED THEN UPDATE SET {', '.join(f'{n} = {v}' for n, v in zip(names, values))}"
        f" WHEN NOT MATCHED THEN INSERT ({', '.join(names)}) VALUES ({', '.join(values)})"
    )


@dataclass(frozen=True)
class Pending(Snapshot):
    """A table as the statement of ``commit`` will leave it."""

    stage: Staged | None = None
    result: DataFrame | None = None
    merged: bool = False  # otherwise the staged rows become the whole table


class RowLevelTables(Snapshots):
    """``namespace`` names a catalog and schema; ``provider`` the table format, if it is not the catalog's own."""

    def __init__(self, store: StateStore, namespace: str, provider: str | None = None):
        super().__init__(store)
        self.namespace, self.provider = namespace, provider
        self._names: dict[int, str] = {}

    def name(self, config_id: int) -> str:
        """A configuration's table; it never changes."""
        if config_id not in self._names:
            self._names[config_id] = f"{self.namespace}.{quoted(self.store.config(config_id)['TargetTable'])}"
        return self._names[config_id]

    # --- the catalog --------------------------------------------------------------

    def _exists(self, table: str) -> bool:
        return self.spark.catalog.tableExists(table)

    def _rows(self, table: str) -> DataFrame:
        return self.spark.table(table)

    def _run(self, statement: str, stage: DataFrame | None = None) -> None:
        self.spark.sql(statement, **({} if stage is None else {"stage": stage}))

    def _owner(self, table: str) -> str | None:
        found = self.spark.sql(f"SHOW TBLPROPERTIES {table}").filter(F.col("key") == OWNER).first()
        return None if found is None else found["value"]

    def _replace(self, config_id: int, rows: DataFrame) -> None:
        table = self.name(config_id)
        if self._exists(table):
            rows.writeTo(table).overwrite(F.lit(True))
        else:
            writer = rows.writeTo(table).tableProperty(OWNER, str(config_id))
            (writer if self.provider is None else writer.using(self.provider)).create()

    def _evolve(self, table: str, schema: T.StructType) -> None:
        for statement in add_column_statements(table, self._rows(table).schema, schema):
            self._run(statement)

    def _check_owner(self, config_id: int) -> None:
        table = self.name(config_id)
        if self._exists(table) and self._owner(table) != str(config_id):
            raise LoadError(None, f"Table {table} exists and does not belong to configuration {config_id}.")

    # --- as Snapshots -------------------------------------------------------------

    def frame(self, snapshot: Snapshot, buckets: set[int] | None = None) -> DataFrame:
        if isinstance(snapshot, Pending):
            return align(snapshot.result, snapshot.schema)
        return align(self._rows(snapshot.parts[0].path), snapshot.schema)

    def live_paths(self, config_id: int) -> list[str]:
        """None: the catalog looks after its files."""
        return []

    def replace_all(self, old: Snapshot | None, stage: Staged) -> Candidate:
        self._check_owner(stage.config_id)
        rows = stage.frame if old is None else overwrite(self.frame(old), stage.frame)
        whole = Part(WHOLE, self.name(stage.config_id), stage.rows, stage.duplicate_keys, stage.null_keys)
        pending = Pending(
            rows.schema, stage.key, 0, (whole,), collation=stage.collation, stage=stage, result=rows
        )
        return Candidate(pending, stage.null_keys)

    def bucketed(self, old: Snapshot | None, stage: Staged, version: str) -> Candidate:
        return self.replace_all(old, stage)

    def upsert(self, old: Snapshot | None, stage: Staged, version: str) -> Candidate:
        if old is None:
            return self.replace_all(None, stage)
        self._check_owner(stage.config_id)
        schema = evolve(old.schema, stage.schema)
        before = self.frame(old)
        if stage.rows == 0:
            result, whole, missing = before, old.parts[0], 0
        else:
            result = upsert(before, stage.frame, stage.key, stage.collation)
            n = reconcile(stage.frame, result, stage.key, collation=stage.collation).first()
            whole = Part(WHOLE, old.parts[0].path, n["target_rows"], n["duplicate_keys"], n["null_keys"])
            missing = n["missing_keys"]
        pending = Pending(
            schema, stage.key, 0, (whole,), collation=stage.collation, stage=stage, result=result, merged=True
        )
        return Candidate(pending, missing)

    def commit(self, config_id: int, audit_id: int | None, snapshot: Snapshot) -> None:
        """Issue the statement, then note the mark. The statement is the table's one atomic change."""
        if isinstance(snapshot, Pending):
            table, stage = self.name(config_id), snapshot.stage
            if snapshot.merged:
                self._evolve(table, snapshot.schema)
                if stage.rows:
                    schema = self._rows(table).schema
                    merge = merge_statement(table, "{stage}", schema, stage.schema, stage.key, stage.collation)
                    self._run(merge, stage.frame)
            else:
                if self._exists(table):
                    self._evolve(table, snapshot.schema)
                    schema = self._rows(table).schema  # the order and types an overwrite goes by
                else:
                    schema = snapshot.schema
                self._replace(config_id, align(stage.frame, schema))
            snapshot = Snapshot(
                snapshot.schema, snapshot.key, 0, snapshot.parts, snapshot.mark, snapshot.collation
            )
        super().commit(config_id, audit_id, snapshot)

    def adopt(self, config_id: int, df: DataFrame, key: str, mark: datetime | None = None) -> None:
        """Take over the catalog's table of a configuration, as it is; ``df`` has to be that table."""
        table = self.name(config_id)
        if not self._exists(table) or self._rows(table).schema != df.schema:
            raise LoadError(None, f"{table} is not the table to take over.")
        p = key_profile(self._rows(table), key).first()
        if p["duplicate_keys"]:
            raise LoadError(None, f"{table} has {p['duplicate_keys']} repeated key value(s) in {key}.")
        self._run(f"ALTER TABLE {table} SET TBLPROPERTIES ('{OWNER}' = '{config_id}')")
        whole = Part(WHOLE, table, p["rows"], p["duplicate_keys"], p["null_keys"])
        self.commit(config_id, None, Snapshot(df.schema, key, 0, (whole,), mark))
