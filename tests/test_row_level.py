"""Publishing by MERGE: the statements run on DuckDB, the rest as far as the built-in catalog goes."""

import random
from dataclasses import replace
from datetime import datetime

import duckdb
import pytest
from pyspark.sql import types as T
from samples import AGP, AGP_ID, CONFIGS, World
from test_snapshots import staged

from tidegate.operators import publish
from tidegate.state import vocabulary as v
from tidegate.state.row_level import RowLevelTables, add_column_statements, merge_statement
from tidegate.state.store import StateStore
from tidegate.state.vocabulary import LoadError

NOW = datetime(2026, 1, 1)


class OnDuckDB(RowLevelTables):
    """The same publisher whose catalog is an in-process DuckDB."""

    def __init__(self, store, fail=False):
        super().__init__(store, "main")
        self.db, self.owners, self.statements, self.fail = duckdb.connect(), {}, [], fail

    def name(self, config_id):
        return "main.`the table`"

    def _exists(self, table):
        return bool(self.owners)

    def _owner(self, table):
        return self.owners.get(table)

    def _rows(self, table):
        return self.spark.createDataFrame(self.db.sql(f"FROM {self.plain(table)}").to_arrow_table())

    def _run(self, statement, stage=None):
        self.statements.append(statement)
        if stage is not None:
            if self.fail:
                raise ConnectionError("the driver is lost")
            self.db.register("stage", stage.toArrow())
        self.db.execute(self.plain(statement.replace("{stage}", "stage")))

    def _replace(self, config_id, rows):
        table, arrow = self.name(config_id), rows.toArrow()
        self.db.register("stage", arrow)
        self.db.execute(f"CREATE OR REPLACE TABLE {self.plain(table)} AS FROM stage")
        self.owners[table] = str(config_id)

    @staticmethod
    def plain(text):
        return text.replace("`", '"')


def test_deltas_equal_a_dictionary(spark, tmp_path):
    rng = random.Random(11)
    store = StateStore(spark, str(tmp_path), lambda: NOW)
    tables, expected = OnDuckDB(store), {}
    for step, (size, span) in enumerate([(60, 100), (3, 100), (80, 300), (0, 1), (40, 200)]):
        rows = [(k, f"step {step}", rng.randrange(100)) for k in rng.sample(range(span), size)]
        stage = staged(store, f"s{step}", rows)
        old = tables.newest(1)
        candidate = tables.bucketed(None, stage, "") if old is None else tables.upsert(old, stage, "")
        expected.update({r[0]: r for r in rows})
        # what gate 2 counts is what the statement leaves behind
        pending = sorted(tuple(r) for r in tables.frame(candidate.snapshot).collect())
        tables.commit(1, step, candidate.snapshot)
        assert pending == sorted(tuple(r) for r in tables.table(1).collect()) == sorted(expected.values())
        assert candidate.missing_keys == 0
        assert tables.newest(1).total("rows") == len(expected)
    assert len(tables.statements) == 3  # the first load and the empty delta need none


def test_new_and_absent_columns(spark, tmp_path):
    store = StateStore(spark, str(tmp_path), lambda: NOW)
    tables = OnDuckDB(store)
    tables.commit(1, 1, tables.bucketed(None, staged(store, "a", [(1, "x", 1), (2, "y", 2)]), "").snapshot)
    stage = staged(store, "b", [(2, "new", 5), (3, "new", 6)])
    odd = stage.frame.selectExpr("k", "label", "bigint(n) AS `an odd name`")
    changed = replace(stage, frame=odd, schema=odd.schema)
    wanted = sorted(map(str, publish.upsert(tables.table(1), odd, "k").collect()))
    tables.commit(1, 2, tables.upsert(tables.newest(1), changed, "").snapshot)
    got = tables.table(1)
    assert got.columns == ["k", "label", "n", "an odd name"]
    assert sorted(map(str, got.collect())) == wanted
    assert [r["n"] for r in got.orderBy("k").collect()] == [1, None, None]  # a matched row is replaced whole
    assert tables.statements[0] == "ALTER TABLE main.`the table` ADD COLUMN `an odd name` bigint"


def test_a_lost_driver_repeats_the_window(spark, tmp_path):
    store = StateStore(spark, str(tmp_path), lambda: NOW)
    tables = OnDuckDB(store)
    tables.commit(1, 1, tables.bucketed(None, staged(store, "a", [(1, "x", 1), (2, "y", 2)]), "").snapshot)
    stage = staged(store, "b", [(2, "new", 5), (3, "new", 6)])
    tables.fail = True
    with pytest.raises(ConnectionError):
        tables.commit(1, 2, tables.upsert(tables.newest(1), stage, "").snapshot)
    assert tables.table(1).count() == 2 and tables.newest(1).total("rows") == 2
    tables.fail = False
    pending = tables.upsert(tables.newest(1), stage, "").snapshot
    for _ in range(2):  # the second time stands for a driver lost before its commit row
        tables.commit(1, 2, pending)
    assert sorted(tuple(r) for r in tables.table(1).collect()) == [(1, "x", 1), (2, "new", 5), (3, "new", 6)]


def test_statements():
    table = T.StructType.fromDDL("K string, `a``b` int, old date")
    stage = T.StructType.fromDDL("k string, `A``b` bigint")
    assert add_column_statements("c.t", stage, table) == ["ALTER TABLE c.t ADD COLUMN `old` date"]
    assert merge_statement("c.t", "{stage}", table, stage, "k", "UTF8_LCASE") == (
        "MERGE INTO c.t AS t USING {stage} AS s ON collate(t.`K`, 'UTF8_LCASE') = collate(s.`k`, 'UTF8_LCASE')"
        " WHEN MATCHED THEN UPDATE SET `K` = s.`k`, `a``b` = CAST(s.`A``b` AS int), `old` = NULL"
        " WHEN NOT MATCHED THEN INSERT (`K`, `a``b`, `old`) VALUES (s.`k`, CAST(s.`A``b` AS int), NULL)"
    )


@pytest.fixture
def schema(spark, tmp_path):
    spark.sql(f"CREATE DATABASE row_level LOCATION '{tmp_path}/row_level'")
    yield "spark_catalog.row_level"
    spark.sql("DROP DATABASE row_level CASCADE")


def test_the_built_in_catalog(spark, tmp_path, schema):
    """It creates tables but offers no MERGE: the first run succeeds, a delta fails and is audited."""
    world = World(spark, tmp_path / "state", configs=[{**CONFIGS[0], "RetryCount": 0}])
    world.snapshots = RowLevelTables(world.store, schema, "parquet")
    assert world.run("r1") is None
    name = f"{schema}.`{AGP}`"
    assert spark.table(name).count() == world.tables[AGP].frame(spark).count() == 3
    (attempt,) = world.attempts("r1")
    assert (attempt["SourceRowCount"], attempt["TargetRowCount"]) == (3, 3)
    assert all(c["Result"] == v.PASS for c in world.checks(attempt))
    mark = world.snapshots.newest(AGP_ID).mark
    row = world.tables[AGP].rows[0]
    world.tables[AGP].rows.append({**row, "AssetGenerationId": 9, "LastModifiedUtc": datetime(2026, 9, 20)})
    assert world.run("r2") == 50020
    (attempt,) = world.attempts("r2")
    assert attempt["Status"] == v.FAILURE and "MERGE" in attempt["ErrorMessage"]
    assert world.snapshots.newest(AGP_ID).mark == mark and spark.table(name).count() == 3


def test_tables_of_others_are_not_touched(spark, tmp_path, schema):
    world = World(spark, tmp_path / "state", configs=[{**CONFIGS[0], "RetryCount": 0}])
    tables = RowLevelTables(world.store, schema, "parquet")
    name = f"{schema}.`{AGP}`"
    world.tables[AGP].frame(spark).limit(2).write.format("parquet").saveAsTable(name)
    world.snapshots = tables
    assert world.run("r1") == 50020
    assert "does not belong" in world.attempts("r1")[0]["ErrorMessage"]
    assert spark.table(name).count() == 2
    tables.adopt(AGP_ID, spark.table(name), "AssetGenerationId")
    assert tables.newest(AGP_ID).total("rows") == 2 and tables._owner(name) == str(AGP_ID)
    with pytest.raises(LoadError, match="not the table"):
        tables.adopt(AGP_ID, spark.range(1), "id")
