"""The reporting views over a state folder, by name."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidegate.plans import reporting
from tidegate.state import tables
from tidegate.state.store import StateStore


def reporting_views(store: StateStore) -> dict[str, DataFrame]:
    config, run, attempt, request, history = (
        store.current(log)
        for log in (tables.CONFIG, tables.RUN, tables.ATTEMPT, tables.REQUEST, tables.HISTORY)
    )
    # checks and notifications are written once, so every row is current
    check, event = (
        store.read(log).select(log.fields) for log in (tables.CHECK, tables.NOTIFICATION)
    )
    return {
        "vw_PipelineHealth": reporting.pipeline_health(config, request, attempt),
        "vw_ReconciliationSummary": reporting.reconciliation_summary(attempt, check),
        "vw_RecentPipelineRuns": reporting.recent_pipeline_runs(run),
        "vw_RecentTableLoads": reporting.recent_table_loads(attempt),
        "vw_PipelineDashboardSummary": reporting.dashboard_summary(
            config, run, attempt, check, request
        ),
        "vw_SchemaChangeRequests": reporting.schema_change_requests(request, config),
        "vw_SchemaVersionHistory": reporting.schema_version_history(history, config),
        "vw_ReconciliationResults": reporting.reconciliation_results(check, attempt, run),
        "vw_TableLoadDetail": reporting.table_load_detail(attempt, run),
        "vw_NotificationEvents": reporting.notification_events(event, config),
    }


def register_views(store: StateStore) -> list[str]:
    """Make the views readable by name in this session's SQL."""
    views = reporting_views(store)
    for name, view in views.items():
        view.createOrReplaceTempView(name)
    return list(views)
