"""Summaries merged from day partials equal the full scan, however the logs are cut into days."""

from datetime import date, datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import DataFrame
from samples import AGP, CSD, World

from tidegate.operators import rollup
from tidegate.plans import rollup as plan
from tidegate.plans.views import reporting_views

ATTEMPTS = "AdfPipelineRunId string, ConfigId int, SourceRowCount bigint, Status string, day int"
CHECKS = "Result string, day int"
attempt = st.tuples(st.sampled_from(["a", "b", None]), st.sampled_from([1, 2, None]), st.sampled_from([5, None]), st.sampled_from(["SUCCESS", "FAILURE", "RUNNING"]), st.integers(0, 6))


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(attempt, max_size=30), cuts=st.sets(st.integers(0, 6), max_size=3), failed=st.lists(st.integers(0, 6), max_size=5))
def test_any_split_into_days(spark, rows, cuts, failed):
    attempts = spark.createDataFrame(rows, ATTEMPTS)
    checks = spark.createDataFrame([("FAIL", d) for d in failed] + [("PASS", 1)], CHECKS)
    seen, partials = attempts.limit(0).select(*rollup.PAIR), None
    edges = [-1, *sorted(cuts), 9]
    for low, high in zip(edges, edges[1:]):
        begun = attempts.filter(f"day > {low} AND day <= {high}")
        fresh = rollup.new_pairs(begun, seen, "day")
        part = rollup.day_partials(begun, begun.filter("Status = 'SUCCESS'"), checks.filter(f"day > {low} AND day <= {high}"), fresh, "day")
        partials = part if partials is None else DataFrame.unionByName(partials, part)
        seen = seen.unionByName(fresh.select(*rollup.PAIR))
    found = rollup.merged(partials).first()
    assert found["RowsProcessed"] == sum(r[2] or 0 for r in rows if r[3] == "SUCCESS")
    assert found["TotalRetryAttempts"] == len(rows) - len({r[:2] for r in rows})
    assert found["ReconciliationFailures"] == len(failed)


def test_summary_of_a_store(spark, tmp_path, monkeypatch):
    """Runs on several days, one over midnight; rolled up at various times, once by a driver that is lost."""
    world = World(spark, tmp_path)

    def same():
        wanted = reporting_views(world.store)["vw_PipelineDashboardSummary"]
        found = plan.summary(world.store)
        assert found.columns == wanted.columns and [f.dataType for f in found.schema] == [f.dataType for f in wanted.schema]
        assert found.first() == wanted.first()

    same()
    world.run("r1")
    same()
    first = world.now.date()
    world.now = datetime.combine(first + timedelta(days=1), datetime.min.time()) - timedelta(seconds=12)
    world.tables[CSD].rename("AssetType", "AssetKind")  # fails on both sides of midnight
    world.run("r2")
    days = {r["LogDate"] for r in world.store.read(plan.tables.ATTEMPT).select("LogDate").distinct().collect()}
    assert days == {first, first + timedelta(days=1)}
    assert plan.roll_up(world.store, first + timedelta(days=1)) == 1
    same()
    assert plan.roll_up(world.store, first + timedelta(days=1)) == 0
    world.now += timedelta(days=3)
    world.tables[AGP].rows.append(dict(world.tables[AGP].rows[0]))
    world.run("r2")  # late attempts of pairs that are rolled up

    class Gone(Exception):
        pass

    written = plan._measured

    def lost(*args):
        fresh, _ = written(*args)
        fresh.write.mode("append").parquet(world.store.path("rollup", "pairs"))
        raise Gone

    monkeypatch.setattr(plan, "_measured", lost)
    with pytest.raises(Gone):
        plan.roll_up(world.store, date(2030, 1, 1))
    monkeypatch.undo()
    same()
    assert plan.roll_up(world.store, date(2030, 1, 1)) == 2
    same()
    live = plan._measured(world.store, plan._finished_to(world.store), plan.F.col("LogDate") > plan.F.lit(plan._finished_to(world.store)))[1]
    assert live.isEmpty()
