"""The approval workflow of one configuration: baseline, drift, decision."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.operators import approvals
from tidegate.operators.fingerprint import Fingerprint, compatibility
from tidegate.operators.lookup import latest_pending_request
from tidegate.state import tables
from tidegate.state import vocabulary as v
from tidegate.state.store import StateStore, local_frame


def establish_baseline(store: StateStore, config: dict, fp: Fingerprint) -> dict:
    """Pin the first schema as version 1, before and apart from the load itself."""
    config_id, now = config["ConfigId"], store.clock()
    pinned = {
        "ApprovedColumnList": fp.columns,
        "ApprovedSchemaHash": fp.hash,
        "ApprovedSchemaVersion": 1,
    }
    config = store.update_config(config, **pinned)
    own = (F.col("ConfigId") == config_id) & (F.col("SchemaVersion") == 1)
    if store.read(tables.HISTORY).filter(own).isEmpty():
        _add_version(store, config_id, 1, fp.hash, fp.columns, fp.definition, v.INITIAL_LOAD)
    if not store.has_initial_request(config_id, fp.hash):
        _add_request(
            store,
            config_id,
            fp,
            ChangeSummary=v.INITIAL_SUMMARY,
            Compatibility=v.INITIAL_LOAD,
            Status=v.APPROVED,
            DecisionUtc=now,
            DecisionBy=v.INITIAL_LOAD,
            DecisionNotes=v.INITIAL_NOTES,
        )
    return config


def detect_change(store: StateStore, config: dict, fp: Fingerprint) -> tuple[bool, str | None]:
    """Whether the schema drifted, and the standing of that drift.

    A decision for this very schema is reused; while another request is open no second one
    is raised; otherwise a pending request is added.
    """
    if fp.hash == config["ApprovedSchemaHash"]:
        return False, None
    config_id, spark = config["ConfigId"], store.spark
    known = {"ConfigId": config_id, "ApprovedSchemaHash": config["ApprovedSchemaHash"], "CurrentHash": fp.hash}
    one = local_frame(spark, [known], T.StructType.fromDDL("ConfigId int, ApprovedSchemaHash string, CurrentHash string"))
    own = store.current(tables.REQUEST, F.col("ConfigId") == config_id)
    found = approvals.detect_changes(one, one, own).first()
    if found["IsNewRequest"]:
        _add_request(
            store,
            config_id,
            fp,
            PreviousSchemaHash=config["ApprovedSchemaHash"],
            ChangeSummary=v.CHANGE_SUMMARY,
            Compatibility=compatibility(config["ApprovedColumnList"], fp.columns),
            Status=v.PENDING,
        )
    return True, found["SchemaApprovalStatus"]


def decide(
    store: StateStore, request_id: int, decision: str, by: str, notes: str | None = None
) -> None:
    """Approve or reject a pending request; an approval shows in the next run."""
    if decision not in (v.APPROVED, v.REJECTED):
        raise v.LoadError(50001)
    request = store.request(request_id)
    if request is None:
        raise v.LoadError(50002)
    config_id = request["ConfigId"]
    with store.config_lock(config_id):
        request = store.request(request_id)
        if request["Status"] != v.PENDING:
            raise v.LoadError(50003)
        decided = {
            "Status": decision,
            "DecisionUtc": store.clock(),
            "DecisionBy": by,
            "DecisionNotes": notes,
        }
        store.append(tables.REQUEST, [{**request, **decided}])
        if decision == v.APPROVED:
            columns, digest = request["DetectedColumnList"], request["DetectedSchemaHash"]
            version = _next_version(store, config_id)
            definition = request["DetectedSchemaDefinition"]
            _add_version(store, config_id, version, digest, columns, definition, by)
            store.update_config(
                store.config(config_id),
                ApprovedColumnList=columns,
                ApprovedSchemaHash=digest,
                ApprovedSchemaVersion=version,
            )


def decide_latest(
    store: StateStore, decision: str, by: str, notes: str | None = None
) -> int:
    """Decide the newest pending request over all configurations."""
    row = latest_pending_request(store.current(tables.REQUEST)).first()
    if row is None:
        raise v.LoadError(52001 if decision == v.APPROVED else 52002)
    decide(store, row["SchemaChangeRequestId"], decision, by, notes)
    return row["SchemaChangeRequestId"]


def _next_version(store: StateStore, config_id: int) -> int:
    own = store.read(tables.HISTORY).filter(F.col("ConfigId") == config_id)
    return (own.agg(F.max("SchemaVersion")).first()[0] or 0) + 1


def _add_version(
    store: StateStore,
    config_id: int,
    version: int,
    digest: str,
    columns: list[str],
    definition: str,
    by: str,
) -> None:
    now = store.clock()
    row = {
        "SchemaHistoryId": store.next_id(tables.HISTORY),
        "ConfigId": config_id,
        "SchemaVersion": version,
        "SchemaHash": digest,
        "ColumnList": columns,
        "SchemaDefinition": definition,
        "ApprovalStatus": v.APPROVED,
        "ApprovedBy": by,
        "ApprovedUtc": now,
        "EffectiveUtc": now,
    }
    store.append(tables.HISTORY, [row])


def _add_request(store: StateStore, config_id: int, fp: Fingerprint, **values) -> None:
    row = {
        "SchemaChangeRequestId": store.next_id(tables.REQUEST),
        "ConfigId": config_id,
        "DetectedSchemaHash": fp.hash,
        "DetectedColumnList": fp.columns,
        "DetectedSchemaDefinition": fp.definition,
        "DetectedUtc": store.clock(),
        **values,
    }
    store.append(tables.REQUEST, [row])
