"""Catalog views against the reporting functions, read by a session that knows nothing of the library."""

from collections import Counter
from uuid import uuid4

from samples import AGP, CSD, CSD_ID, World

from tidegate.plans import rfc
from tidegate.plans.catalog_views import create_views, view_texts
from tidegate.plans.views import reporting_views


def rows(frame):
    return Counter(str(tuple(r)) for r in frame.collect())


def test_views_of_another_session(spark, tmp_path):
    world = World(spark, tmp_path)
    database = f"reporting_{uuid4().hex}"
    names = create_views(world.store, database)
    assert len(names) == len(view_texts(world.store)) == 10
    stranger = spark.newSession()
    one_row = "vw_PipelineDashboardSummary"
    for name in view_texts(world.store):  # logs without rows
        found = stranger.table(f"{database}.{name}").count()
        assert found == (1 if name == one_row else 3 if name == "vw_PipelineHealth" else 0)

    world.run("r1")
    world.tables[CSD].add_column("RegionCode", "string", lambda row: "x")
    world.run("r2")
    rfc.decide_latest(world.store, "APPROVED", "me", "it's [fine]")
    world.tables[CSD].rename("AssetType", "AssetKind")  # fails, and is tried again
    world.run("r3")
    world.tables[AGP].rows.append(dict(world.tables[AGP].rows[0]))  # a key twice
    world.run("r4")
    views = reporting_views(world.store)
    for name, view in views.items():
        read = stranger.table(f"{database}.{name}")
        assert read.columns == view.columns and [f.dataType for f in read.schema] == [f.dataType for f in view.schema], name
        assert rows(read) == rows(view) and (name == one_row or read.count()), name
    failed = stranger.sql(f"SELECT max(AttemptNumber) AS n FROM {database}.vw_TableLoadDetail WHERE Status = 'FAILURE'").first()
    assert failed["n"] == 4 and world.run_row("r3")["FailedTableCount"] == 1
    assert create_views(world.store, database) == names  # again, over rows
    assert CSD_ID and rows(stranger.table(f"{database}.vw_TableLoadDetail")) == rows(views["vw_TableLoadDetail"])
