"""The demonstration scenario: eight runs over the sample sources, with golden outcomes."""

import json
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from samples import AGP, AGP_ID, CSD, CSD_ID, World

from tidegate.operators import validate
from tidegate.plans import reporting, rfc
from tidegate.plans.views import register_views
from tidegate.state import tables
from tidegate.state.store import StateStore
from tidegate.state.vocabulary import LoadError


@pytest.fixture(scope="module")
def world(spark, tmp_path_factory):
    return World(spark, tmp_path_factory.mktemp("scenario"))


def counts(world, run_id):
    return {
        r["ConfigId"]: (r["SourceRowCount"], r["TargetRowCount"]) for r in world.attempts(run_id)
    }


def test_1_first_load(world):
    assert world.run("r1") is None
    assert counts(world, "r1") == {AGP_ID: (3, 3), CSD_ID: (3, 3)}
    for attempt in world.attempts("r1"):
        assert attempt["IsFirstLoad"] and not attempt["SchemaChangeDetected"]
        assert attempt["SchemaApprovalStatus"] is None
        checks = world.checks(attempt)
        assert [c["CheckName"] for c in checks] == [
            "SOURCE_STAGE_ROW_COUNT",
            "DUPLICATE_PRIMARY_KEY",
            "NULL_PRIMARY_KEY",
            "APPROVED_SCHEMA",
            "STAGE_KEYS_PUBLISHED",
            "DUPLICATE_PRIMARY_KEY",
            "NULL_PRIMARY_KEY",
            "FULL_ROW_COUNT",
        ]
        assert {c["Result"] for c in checks} == {"PASS"}
    for config_id in (AGP_ID, CSD_ID):
        (request,) = world.requests(config_id)
        assert request["Compatibility"] == "INITIAL_LOAD" and request["Status"] == "APPROVED"
    assert len(world.log(tables.HISTORY)) == 2
    run = world.run_row("r1")
    assert run["Status"] == "SUCCESS" and run["EnabledTableCount"] == 2


def test_2_incremental(world):
    agp, now = world.tables[AGP], datetime(2026, 9, 17, 9, 30, 15, 123456)
    agp.rows[1].update(GenerationMWh=Decimal("350.250"), LastModifiedUtc=now)
    new = (4, "SOLAR-02", Decimal("88.125"), date(2026, 9, 17), now)
    agp.rows.append(dict(zip(agp.schema, new)))
    assert world.run("r2") is None
    assert counts(world, "r2") == {AGP_ID: (2, 4), CSD_ID: (3, 3)}
    (attempt,) = world.attempts("r2", AGP_ID)
    assert len(world.checks(attempt)) == 7
    assert world.store.config(AGP_ID)["LastWatermarkValue"] == now
    assert world.rows(AGP_ID, "AssetGenerationId", "GenerationMWh")[1] == (2, Decimal("350.250"))


def test_3_rerun(world):
    assert world.run("r3") is None
    assert counts(world, "r3") == {AGP_ID: (0, 4), CSD_ID: (3, 3)}


def test_4a_new_column_pending(world):
    region = {101: "NORTH", 102: "EAST"}
    world.tables[CSD].add_column("RegionCode", "string", lambda r: region.get(r["AssetId"], "WEST"))
    assert world.run("r4a") is None
    (attempt,) = world.attempts("r4a", CSD_ID)
    assert attempt["SchemaChangeDetected"] and attempt["SchemaApprovalStatus"] == "PENDING"
    assert world.requests(CSD_ID)[-1]["Compatibility"] == "OLD_PROJECTION_SAFE"
    assert len(world.curated(CSD_ID).columns) == 5
    assert world.events("r4a", CSD_ID) == ["SCHEMA_CHANGE"]


def test_4b_approved(world):
    rfc.decide_latest(world.store, "APPROVED", "steward", "approved")
    assert world.run("r4b") is None
    (attempt,) = world.attempts("r4b", CSD_ID)
    assert not attempt["SchemaChangeDetected"]
    assert world.store.config(CSD_ID)["ApprovedSchemaVersion"] == 2
    assert world.rows(CSD_ID, "AssetId", "RegionCode")[0] == (101, "NORTH")
    assert world.events("r4b", CSD_ID) == ["TABLE_SUCCESS"]


def test_5_rejected(world):
    world.tables[CSD].add_column("TemporaryNote", "string", lambda r: "Not approved for curated use")
    assert world.run("r5a") is None
    rfc.decide_latest(world.store, "REJECTED", "steward")
    with pytest.raises(LoadError) as none_left:
        rfc.decide_latest(world.store, "REJECTED", "steward")
    assert none_left.value.code == 52002
    assert world.run("r5b") is None
    (attempt,) = world.attempts("r5b", CSD_ID)
    assert attempt["SchemaApprovalStatus"] == "REJECTED"
    assert len(world.curated(CSD_ID).columns) == 6


def test_6_breaking_change(world):
    before = world.rows(CSD_ID, "*")
    world.tables[CSD].rename("AssetType", "AssetCategory")
    assert world.run("r6") == 50020
    failed = world.attempts("r6", CSD_ID)
    assert [a["Status"] for a in failed] == ["FAILURE"] * 4
    assert {a["ErrorMessage"][:26] for a in failed} == {"Previously approved column"}
    for attempt in failed:
        (check,) = world.checks(attempt)
        assert (check["CheckName"], check["Result"], check["ActualValue"]) == (
            "APPROVED_SCHEMA",
            "FAIL",
            "1",
        )
    assert world.events("r6", CSD_ID) == ["SCHEMA_CHANGE", "TABLE_FAILURE"] * 4
    breaking = [r for r in world.requests(CSD_ID) if r["Compatibility"] == "BREAKING"]
    assert [r["Status"] for r in breaking] == ["PENDING"]
    assert world.rows(CSD_ID, "*") == before
    assert counts(world, "r6")[AGP_ID] == (0, 4)
    run = world.run_row("r6")
    assert run["Status"] == "PARTIAL_SUCCESS"
    assert run["Message"] == "1 table(s) succeeded; 1 table(s) failed."
    assert world.slept == [15, 15, 15]
    outbox = [json.loads(o["Payload"]) for o in world.log(tables.OUTBOX, "r6")]
    assert sorted((o["tableName"], o["eventType"], o["status"]) for o in outbox) == [
        ("ConfigId 1", "TABLE_SUCCESS", "SUCCESS"),
        ("ConfigId 2", "SCHEMA_CHANGE", "SCHEMA_CHANGE_PENDING"),
        ("ConfigId 2", "TABLE_FAILURE", "FAILURE"),
    ]


def test_7_restored(world):
    world.tables[CSD].rename("AssetCategory", "AssetType")
    assert world.run("r7") is None
    (attempt,) = world.attempts("r7", CSD_ID)
    assert attempt["SchemaChangeDetected"] and attempt["SchemaApprovalStatus"] == "REJECTED"
    # the alert shows the config's newest request, which is the open breaking one
    outbox = [json.loads(o["Payload"])["status"] for o in world.log(tables.OUTBOX, "r7")]
    assert sorted(outbox) == ["SCHEMA_CHANGE_PENDING", "SUCCESS"]
    statuses = [(r["Compatibility"], r["Status"]) for r in world.log(tables.REQUEST)]
    assert sorted(statuses) == [
        ("BREAKING", "PENDING"),
        ("INITIAL_LOAD", "APPROVED"),
        ("INITIAL_LOAD", "APPROVED"),
        ("OLD_PROJECTION_SAFE", "APPROVED"),
        ("OLD_PROJECTION_SAFE", "REJECTED"),
    ]


def test_8_reports_over_the_logs(world):
    s = world.store
    config, requests, attempts = (
        s.current(log) for log in (tables.CONFIG, tables.REQUEST, tables.ATTEMPT)
    )
    checks, runs, history = (s.current(log) for log in (tables.CHECK, tables.RUN, tables.HISTORY))
    summary = reporting.dashboard_summary(config, runs, attempts, checks, requests).first()
    assert summary["TotalConfiguredTables"] == 3 and summary["EnabledTables"] == 2
    assert summary["SuccessfulRuns"] == 8 and summary["FailedOrPartialRuns"] == 1
    assert summary["TotalRetryAttempts"] == 3 and summary["ReconciliationFailures"] == 4
    assert summary["SchemaChangesDetected"] == 5 and summary["PendingSchemaChanges"] == 1
    health = {r.ConfigId: r for r in reporting.pipeline_health(config, requests, attempts).collect()}
    assert health[3].LastRunStatus == "Skipped (Load = No)"
    assert health[CSD_ID].PendingSchemaChanges == 1 and health[CSD_ID].ApprovedSchemaVersion == 2
    versions = reporting.schema_version_history(history, config).collect()
    newest = max(versions, key=lambda r: r.SchemaVersion)
    assert newest.ColumnList == (
        "[AssetId],[AssetName],[AssetType],[IsActive],[LastModifiedUtc],[RegionCode]"
    )
    broken = validate.validate_logs(config, runs, attempts, checks, requests, history)
    assert {r.offending for r in broken.collect()} == {0}
    assert {r.offending for r in validate.validate_config(config).collect()} == {0}


def test_8_views_by_name(world, spark):
    names = register_views(world.store)
    assert len(names) == 10
    assert spark.table("vw_TableLoadDetail").filter("AttemptNumber = 4").count() == 1
    assert spark.sql("SELECT * FROM vw_ReconciliationResults WHERE Result = 'FAIL'").count() == 4
    assert spark.table("vw_PipelineDashboardSummary").first()["SuccessfulRuns"] == 8


def test_9_reopened_state_goes_on(world):
    """A new driver finds the ids, the approvals and the mark where the last one left them."""
    reopened = StateStore(world.spark, world.store.root, world.tick)
    world.store, world.snapshots = reopened, type(world.snapshots)(reopened)
    assert world.run("r9") is None
    assert counts(world, "r9") == {AGP_ID: (0, 4), CSD_ID: (3, 3)}
    ids = [a["TableLoadAuditId"] for a in world.log(tables.ATTEMPT)]
    assert len(ids) == len(set(ids))
