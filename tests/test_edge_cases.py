"""Rules of a load that are easy to lose, each forced on small sources."""

from datetime import datetime
from decimal import Decimal

import pytest
from samples import AGP, AGP_ID, CONFIGS, CSD, CSD_ID, STG, World
from pyspark.sql import types as T

from tidegate.operators.fingerprint import compatibility, fingerprint, missing_names
from tidegate.plans import rfc
from tidegate.plans.load import load_table
from tidegate.plans.run import close_published, finalize_run, start_run
from tidegate.state import tables
from tidegate.state.snapshots import Snapshots
from tidegate.state.store import StateStore
from tidegate.state.vocabulary import LoadError


@pytest.fixture
def world(spark, tmp_path):
    return World(spark, tmp_path)


def load(world, config_id, run_id="run", **kwargs):
    return load_table(world.store, world.snapshots, world.sources, config_id, run_id, **kwargs)


def code_of(world, config_id, **kwargs):
    with pytest.raises(LoadError) as failure:
        load(world, config_id, **kwargs)
    return failure.value.code


def schema(**columns):
    return T.StructType.fromDDL(", ".join(f"{n} {t}" for n, t in columns.items()))


def test_early_errors_leave_no_trace(world):
    del world.tables[CSD]
    start_run(world.store, "run", "n")
    start_run(world.store, "run", "n")
    assert [code_of(world, i) for i in (99, 3, CSD_ID)] == [50010, 50011, 50012]
    assert world.log(tables.ATTEMPT) == [] and world.log(tables.NOTIFICATION) == []
    assert world.store.config(CSD_ID)["LastRunStatus"] is None
    assert finalize_run(world.store, "run") == (
        "SUCCESS",
        "0 table(s) succeeded; 0 table(s) failed.",
    )
    assert len(world.log(tables.RUN)) == 1


def test_failed_first_load_is_not_first_again(world):
    agp = world.tables[AGP]
    agp.rows.append(dict(agp.rows[0]))
    assert code_of(world, AGP_ID) == 50014
    assert world.curated(AGP_ID) is None
    (attempt,) = world.attempts("run")
    assert {c["CheckName"] for c in world.checks(attempt) if c["Result"] == "FAIL"} == {
        "DUPLICATE_PRIMARY_KEY"
    }
    assert world.store.config(AGP_ID)["ApprovedSchemaVersion"] == 1
    agp.rows.pop()
    load(world, AGP_ID)
    retry = world.attempts("run")[-1]
    assert not retry["IsFirstLoad"] and retry["TargetRowCount"] == 3
    assert "FULL_ROW_COUNT" not in {c["CheckName"] for c in world.checks(retry)}
    assert retry["RowsInserted"] is None and retry["RowsUpdated"] is None
    assert {n["DeliveryStatus"] for n in world.log(tables.NOTIFICATION)} == {"PENDING"}


def test_return_to_an_older_approved_schema(world):
    load(world, CSD_ID)
    csd = world.tables[CSD]
    csd.add_column("RegionCode", "string", lambda r: "X")
    load(world, CSD_ID)
    rfc.decide_latest(world.store, "APPROVED", "steward")
    csd.drop_column("RegionCode")
    assert code_of(world, CSD_ID) == 50013
    last = world.attempts("run")[-1]
    assert last["SchemaChangeDetected"] and last["SchemaApprovalStatus"] == "APPROVED"
    assert len(world.requests(CSD_ID)) == 2


def test_one_open_request_and_approval_of_a_stale_one(world):
    load(world, CSD_ID)
    csd = world.tables[CSD]
    csd.add_column("A1", "string")
    load(world, CSD_ID)
    csd.rename("A1", "A2")
    load(world, CSD_ID)  # a third schema raises nothing while the first is open
    assert [r["Status"] for r in world.requests(CSD_ID)] == ["APPROVED", "PENDING"]
    rfc.decide_latest(world.store, "APPROVED", "steward")
    assert world.store.config(CSD_ID)["ApprovedColumnList"][-1] == "A1"
    assert code_of(world, CSD_ID) == 50013  # the pinned column is gone from the source
    assert [r["Compatibility"] for r in world.requests(CSD_ID)] == [
        "INITIAL_LOAD",
        "OLD_PROJECTION_SAFE",
        "BREAKING",
    ]


def test_decisions_are_checked(world):
    load(world, CSD_ID)

    def refused(*args):
        with pytest.raises(LoadError) as failure:
            rfc.decide(world.store, *args)
        return failure.value.code

    assert refused(1, "MAYBE", "steward") == 50001
    assert refused(77, "APPROVED", "steward") == 50002
    assert refused(1, "APPROVED", "steward") == 50003
    with pytest.raises(LoadError) as none_open:
        rfc.decide_latest(world.store, "APPROVED", "steward")
    assert none_open.value.code == 52001


def test_fingerprint_sees_every_change():
    base = schema(k="bigint", a="int", b="string")
    variants = [
        schema(k="bigint", b="string", a="int"),
        schema(k="bigint", a="bigint", b="string"),
        schema(k="bigint", a2="int", b="string"),
        T.StructType([T.StructField("k", T.LongType(), False), *base.fields[1:]]),
        schema(k="bigint", a="int", b="struct<x:int>"),
    ]
    hashes = {fingerprint(s).hash for s in [base, *variants]}
    assert len(hashes) == 6 and all(len(h) == 64 and h == h.upper() for h in hashes)
    assert fingerprint(base, "utf-16-le").hash != fingerprint(base).hash
    # names alone decide compatibility, without regard to case
    assert compatibility(["k", "A"], ["K", "a", "new"]) == "OLD_PROJECTION_SAFE"
    assert missing_names(["k", "a"], ["k"]) == ["a"]
    # separators inside names cannot forge another schema
    odd = [T.StructField("a:int:1|b", T.IntegerType())]
    assert fingerprint(T.StructType(odd)).hash != fingerprint(schema(a="int", b="int")).hash
    wide = T.StructType([T.StructField(f"column_{i}", T.StringType()) for i in range(5000)])
    assert len(fingerprint(wide).columns) == 5000


def test_declared_lengths_are_part_of_the_fingerprint():
    def declared(n):
        metadata = {"__CHAR_VARCHAR_TYPE_STRING": f"varchar({n})"}
        return T.StructType([T.StructField("c", T.StringType(), True, metadata)])

    assert fingerprint(declared(10)).definition == "c:varchar(10):1"
    assert fingerprint(declared(10)).hash != fingerprint(declared(20)).hash


def test_types_stay_pinned(world):
    load(world, CSD_ID)
    csd = world.tables[CSD]
    csd.schema["AssetId"] = "string"
    for row in csd.rows:
        row["AssetId"] = str(row["AssetId"])
    load(world, CSD_ID)
    assert world.requests(CSD_ID)[-1]["Compatibility"] == "OLD_PROJECTION_SAFE"
    assert dict(world.curated(CSD_ID).dtypes)["AssetId"] == "int"
    csd.rows[0]["AssetId"] = "not a number"
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        load(world, CSD_ID)
    assert world.attempts("run")[-1]["Status"] == "FAILURE"
    assert world.curated(CSD_ID).count() == 3


def test_evolution_on_a_marked_table(world):
    load(world, AGP_ID)
    agp = world.tables[AGP]
    agp.add_column("Note", "string", lambda r: "n")
    load(world, AGP_ID)
    rfc.decide_latest(world.store, "APPROVED", "steward")
    agp.rows[0]["LastModifiedUtc"] = datetime(2026, 9, 18)
    load(world, AGP_ID)
    # rows loaded before the approval keep NULL until they change again
    assert world.curated(AGP_ID).filter("Note IS NULL").count() == 2
    agp.drop_column("GenerationMWh")
    assert code_of(world, AGP_ID) == 50013
    rfc.decide_latest(world.store, "APPROVED", "steward")
    agp.rows[1]["LastModifiedUtc"] = datetime(2026, 9, 19)
    load(world, AGP_ID)
    # a column that left the approved set stays; later rows have NULL in it
    values = dict(world.rows(AGP_ID, "AssetGenerationId", "GenerationMWh"))
    assert values == {1: Decimal("125.500"), 2: None, 3: Decimal("510.750")}


def test_marks_late_rows_and_deletes(world):
    agp = world.tables[AGP]
    agp.rows[2]["LastModifiedUtc"] = None
    load(world, AGP_ID)
    assert [r[0] for r in world.rows(AGP_ID, "AssetGenerationId")] == [1, 2]
    late = dict(agp.rows[0], AssetGenerationId=9, LastModifiedUtc=datetime(2026, 9, 1))
    agp.rows = [late, *agp.rows[1:]]
    load(world, AGP_ID)
    assert [r[0] for r in world.rows(AGP_ID, "AssetGenerationId")] == [1, 2]
    load(world, CSD_ID)
    world.tables[CSD].rows.pop()
    load(world, CSD_ID)
    assert world.curated(CSD_ID).count() == 2


def test_empty_marked_source(world):
    world.tables[AGP].rows = []
    load(world, AGP_ID)
    assert world.curated(AGP_ID).count() == 0
    assert world.store.config(AGP_ID)["LastWatermarkValue"] is None


@pytest.mark.parametrize("full_check", [False, True])
def test_gate_2_rolls_back(world, full_check):
    """Keys repeated in the curated table before the load fail a clean delta."""
    load(world, AGP_ID)
    old = world.tables[AGP].frame(world.spark)
    mark = world.snapshots.newest(AGP_ID).mark
    world.snapshots.adopt(AGP_ID, old.unionAll(old.limit(1)), "AssetGenerationId", mark)
    before, table = world.snapshots.newest(AGP_ID), world.rows(AGP_ID, "*")
    agp = world.tables[AGP]
    agp.rows.append(dict(agp.rows[1], AssetGenerationId=7, LastModifiedUtc=datetime(2026, 9, 20)))
    assert code_of(world, AGP_ID, full_check=full_check) == 50015
    assert world.snapshots.newest(AGP_ID) == before and world.rows(AGP_ID, "*") == table
    failed = world.attempts("run")[-1]
    checks = {c["CheckName"]: c for c in world.checks(failed) if c["GateStage"].startswith("GATE_2")}
    assert checks["DUPLICATE_PRIMARY_KEY"]["ActualValue"] == "1"
    assert checks["STAGE_KEYS_PUBLISHED"]["Result"] == "PASS"
    config = world.store.config(AGP_ID)
    assert config["LastRunStatus"] == "FAILURE" and config["LastWatermarkValue"] == mark
    assert world.events("run", AGP_ID) == ["TABLE_SUCCESS", "TABLE_FAILURE"]


def test_names_match_without_case(spark, tmp_path):
    marked = dict(CONFIGS[0], PrimaryKeyColumn="ASSETGENERATIONID", WatermarkColumn="lastmodifiedutc")
    world = World(spark, tmp_path, [marked])
    load(world, 1)
    world.tables[AGP].rename("AssetCode", "ASSETCODE")
    load(world, 1)  # the hash differs, the projection still fits
    assert world.requests(1)[-1]["Compatibility"] == "OLD_PROJECTION_SAFE"
    assert world.curated(1).columns[1] == "AssetCode"


def test_configurations_are_added_once(world):
    world.store.add_configs(CONFIGS)
    assert [c["SourceTable"] for c in world.log(tables.CONFIG)] == [AGP, CSD, STG]


class Crash(BaseException):
    """The driver dies: nothing after this point runs."""


def test_a_driver_lost_before_the_commit(world, monkeypatch):
    load(world, AGP_ID, "r1")
    agp = world.tables[AGP]
    agp.rows[0]["LastModifiedUtc"] = datetime(2026, 9, 20)
    before, table = world.snapshots.newest(AGP_ID), world.rows(AGP_ID, "*")

    def lost(*args):
        raise Crash

    monkeypatch.setattr(world.snapshots, "commit", lost)
    start_run(world.store, "r2", "n")
    with pytest.raises(Crash):
        load(world, AGP_ID, "r2")
    # a new driver finds the table as it was and an attempt without an outcome
    world.store = StateStore(world.spark, world.store.root, world.tick)
    world.snapshots = Snapshots(world.store)
    assert world.snapshots.newest(AGP_ID) == before and world.rows(AGP_ID, "*") == table
    assert world.attempts("r2")[0]["Status"] == "RUNNING"
    assert finalize_run(world.store, "r2")[1] == "0 table(s) succeeded; 0 table(s) failed."
    load(world, AGP_ID, "r3")
    assert [a["SourceRowCount"] for a in world.attempts("r3")] == [1]
    assert world.snapshots.newest(AGP_ID).mark == datetime(2026, 9, 20)


def test_unknown_load_type_and_connection_touch_nothing(world):
    load(world, CSD_ID)
    config, before = world.store.config(CSD_ID), world.rows(CSD_ID, "*")
    for wrong in ({"LoadType": "Watermark"}, {"ConnectionReference": "typo"}):
        world.store.update_config(config, **wrong)
        attempts = len(world.log(tables.ATTEMPT))
        with pytest.raises(LoadError, match="Unknown"):
            load(world, CSD_ID)
        assert world.rows(CSD_ID, "*") == before and len(world.log(tables.ATTEMPT)) == attempts


def test_error_texts_are_kept_whole(world, monkeypatch):
    def broken(*args):
        raise ValueError("x" * 9000)

    monkeypatch.setattr(world.snapshots, "commit", broken)
    with pytest.raises(ValueError):
        load(world, CSD_ID)
    assert len(world.attempts("run")[-1]["ErrorMessage"]) == 9000


def test_gate_2_sees_a_file_added_to_a_full_load(world, monkeypatch):
    """Rows that appear in the folder between the write and the check stop the commit."""
    load(world, CSD_ID)
    before = world.snapshots.newest(CSD_ID)
    publish = world.snapshots.replace_all

    def disturbed(old, stage):
        candidate = publish(old, stage)
        stage.frame.limit(2).write.mode("append").parquet(world.store.path(stage.path))
        return candidate

    monkeypatch.setattr(world.snapshots, "replace_all", disturbed)
    assert code_of(world, CSD_ID) == 50015
    assert world.snapshots.newest(CSD_ID) == before
    checks = {c["CheckName"]: c["Result"] for c in world.checks(world.attempts("run")[-1]) if c["GateStage"].startswith("GATE_2")}
    assert checks["DUPLICATE_PRIMARY_KEY"] == checks["FULL_ROW_COUNT"] == "FAIL"


def test_a_driver_lost_after_the_commit(world, monkeypatch):
    load(world, AGP_ID, "r1")
    world.tables[AGP].rows[0]["LastModifiedUtc"] = datetime(2026, 9, 20)
    append, commit = world.store.append_all, world.snapshots.commit

    def committed(*args):
        commit(*args)
        monkeypatch.setattr(world.store, "append_all", lost)

    def lost(*args):
        raise Crash

    monkeypatch.setattr(world.snapshots, "commit", committed)
    with pytest.raises(Crash):
        load(world, AGP_ID, "r2")
    assert append and world.attempts("r2")[0]["Status"] == "RUNNING"
    world.store = StateStore(world.spark, world.store.root, world.tick)
    world.snapshots = Snapshots(world.store)
    assert close_published(world.store) == 1 and close_published(world.store) == 0
    (attempt,) = world.attempts("r2")
    assert attempt["Status"] == "SUCCESS" and attempt["TargetRowCount"] == world.curated(AGP_ID).count()
    config = world.store.config(AGP_ID)
    assert config["LastRunStatus"] == "SUCCESS" and config["LastWatermarkValue"] == datetime(2026, 9, 20)


VALID = {"SourceTable": "t", "TargetTable": "t", "Load": "Yes", "LoadType": "FULL", "PrimaryKeyColumn": "k"}


@pytest.mark.parametrize(
    "rows",
    [
        [{**VALID, "Load": "Maybe"}],
        [{**VALID, "LoadType": "full"}],
        [{**VALID, "LoadType": "WATERMARK"}],
        [{**VALID, "PrimaryKeyColumn": None}],
        [{k: x for k, x in VALID.items() if k != "TargetTable"}],
        [{**VALID, "PrimaryKey": "k"}],
        [VALID, {**VALID, "TargetTable": "u"}],
    ],
)
def test_invalid_configurations_are_refused(world, rows):
    with pytest.raises(LoadError):
        world.store.add_configs([{**VALID, "SourceTable": "fine"}, *rows])
    assert len(world.log(tables.CONFIG)) == len(CONFIGS)


def test_column_names_with_a_backtick(spark, tmp_path):
    odd = dict(CONFIGS[0], SourceTable="odd", TargetTable="odd", PrimaryKeyColumn="k`1", WatermarkColumn="at``")
    world = World(spark, tmp_path, [odd])
    world.tables["odd"] = type(world.tables[AGP])({"k`1": "int", "at``": "timestamp_ntz", "a.b": "string"}, [])
    world.tables["odd"].rows += [{"k`1": i, "at``": datetime(2026, 1, i), "a.b": "x"} for i in (1, 2)]
    load(world, 1)
    world.tables["odd"].rows.append({"k`1": 2, "at``": datetime(2026, 1, 9), "a.b": "y"})
    world.tables["odd"].rows.pop(1)
    load(world, 1)
    assert sorted(tuple(r) for r in world.curated(1).collect())[1][2] == "y" and world.curated(1).count() == 2
