"""Marks asked of the source, counts observed while rows are staged, one read per attempt."""

from datetime import date, datetime, timedelta

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tidegate.operators import highwater
from tidegate.operators.fingerprint import fingerprint
from tidegate.plans.load import load_table
from tidegate.plans.run import run_pipeline
from tidegate.sources import Frames, JdbcDatabase, Marks, ParquetFolder, Sources
from tidegate.sources import marks as asked
from tidegate.state import tables
from tidegate.state.snapshots import Snapshots
from tidegate.state.store import StateStore

T0 = datetime(2024, 3, 1, 12, 0, 0, 250000)
CONFIG = {"SourceTable": "t", "TargetTable": "t", "Load": "Yes", "LoadType": "WATERMARK", "WatermarkColumn": "ts", "PrimaryKeyColumn": "id"}


def _files(folder, parts, unit="us", kind=None, zone=None, swapped=()):
    """A parquet file for each list of (id, mark), with small row groups; some with their columns swapped."""
    folder.mkdir(parents=True, exist_ok=True)
    for k, rows in enumerate(parts):
        columns = {
            "id": pa.array([r[0] for r in rows], pa.int64()),
            "ts": pa.array([r[1] for r in rows], kind or pa.timestamp(unit, zone)),
        }
        names = ["ts", "id"] if k in swapped else ["id", "ts"]
        pq.write_table(pa.table({n: columns[n] for n in names}), folder / f"{k}.parquet", row_group_size=3, coerce_timestamps=None)


def _instants(*days):
    return [(int(d * 10), None if d < 0 else T0 + timedelta(days=d)) for d in days]


@pytest.mark.parametrize("unit", ["us", "ms"])
@pytest.mark.parametrize("zone", [None, "UTC"])
@pytest.mark.parametrize("swapped", [(), (0,), (1,), (0, 1)])
def test_footer_marks_are_exact(spark, tmp_path, unit, zone, swapped):
    """Whatever footers say (other units, other column orders), the mark is that of a full scan."""
    _files(tmp_path / "s" / "t", [_instants(1, 2, -1, 9, 4, 3, 8), _instants(5, 7, -1, -1, 6)], unit, None, zone, swapped)
    lake = ParquetFolder(str(tmp_path))
    df = lake.read(spark, "s", "t")
    assert lake.marks(df, "s", "t", "TS") == Marks(T0 + timedelta(days=9), 12, 3) == asked.plain_marks(df, "ts")


def test_footer_marks_of_dates_and_nothing(spark, tmp_path):
    lake = ParquetFolder(str(tmp_path))
    _files(tmp_path / "s" / "dates", [[(1, date(2024, 1, 5)), (2, None)], [(3, date(2023, 1, 1))]], kind=pa.date32())
    _files(tmp_path / "s" / "nulls", [[(1, None), (2, None)]])
    _files(tmp_path / "s" / "empty", [[]])
    found = {name: lake.marks(lake.read(spark, "s", name), "s", name, "ts") for name in ("dates", "nulls", "empty")}
    assert found == {"dates": Marks(datetime(2024, 1, 5), 3, 1), "nulls": Marks(None, 2, 2), "empty": Marks(None, 0, 0)}


def test_footers_answer_without_reading_columns(spark, tmp_path):
    _files(tmp_path / "s" / "t", [_instants(1, 2, 3)])
    df = ParquetFolder(str(tmp_path)).read(spark, "s", "t")
    plan = asked.footer_aggregate(spark, str(tmp_path / "s" / "t"), df.schema, "ts")._jdf.queryExecution().toString()
    assert "PushedAggregation: [MAX(ts), COUNT(*)]" in plan
    assert spark.conf.get("spark.sql.sources.useV1SourceList") != ""  # the caller's session is as it was


@pytest.mark.parametrize("zone", [None, "UTC"])
def test_observed_window_equals_capture(spark, tmp_path, zone):
    _files(tmp_path / "s" / "t", [_instants(1, 2, -1, 4), _instants(3, -1)], zone=zone)
    df = ParquetFolder(str(tmp_path)).read(spark, "s", "t")
    for last in (None, T0 + timedelta(days=2), T0 + timedelta(days=4), T0 + timedelta(days=9)):
        read = highwater.observed_window(df, "TS", last)
        rows = read.frame.select("id").toPandas()["id"]
        assert (read.mark, read.rows) == highwater.capture_window(df, "ts", last) and len(rows) == read.rows and read.null_marks == 2
        again = highwater.bounded_window(df, "ts", last, read.mark)
        assert again.frame.select("id").toPandas()["id"].tolist() == rows.tolist()
        assert (again.mark, again.rows) == (read.mark, read.rows)
    nothing = highwater.observed_window(df.limit(0), "ts", None)
    assert nothing.frame.collect() == [] and (nothing.mark, nothing.rows, nothing.null_marks) == (None, 0, 0)
    none_captured = highwater.bounded_window(df, "ts", None, None)
    assert none_captured.frame.collect() == [] and (none_captured.mark, none_captured.rows) == (None, 0)


def _counted(spark, rows, counter):
    """A source whose every row read adds one to the counter."""

    def pass_on(batches):
        for batch in batches:
            counter.add(batch.num_rows)
            yield batch

    frame = spark.createDataFrame(rows, "id bigint, ts timestamp_ntz, v string").repartition(3)
    return frame.mapInArrow(pass_on, frame.schema)


def test_an_attempt_reads_its_source_once(spark, tmp_path):
    counter = spark.sparkContext.accumulator(0)
    data = [[(k, T0 + timedelta(hours=k), "x") for k in range(10)] + [(90, None, "x")]]
    sources = Sources(spark, {}, Frames({("src", "t"): lambda: _counted(spark, data[0], counter), ("src", "u"): lambda: _counted(spark, data[0][:10], counter)}))
    store = StateStore(spark, str(tmp_path / "state"))
    snapshots = Snapshots(store)
    store.add_configs([CONFIG, {**CONFIG, "SourceTable": "u", "TargetTable": "u", "LoadType": "FULL", "WatermarkColumn": None}])
    load_table(store, snapshots, sources, 1, "r1")
    assert counter.value == 11
    load_table(store, snapshots, sources, 2, "r1")
    assert counter.value == 21
    data[0] = data[0] + [(k, T0 + timedelta(hours=k), "y") for k in (3, 20, 21)][1:]
    load_table(store, snapshots, sources, 1, "r2")
    assert counter.value == 34
    found = store.current(tables.ATTEMPT).orderBy("TableLoadAuditId").select("SourceRowCount", "TargetRowCount").collect()
    assert [tuple(r) for r in found] == [(10, 10), (10, 10), (2, 12)]
    assert store.config(1)["LastWatermarkValue"] == T0 + timedelta(hours=21)


def test_a_repeated_attempt_counts_its_own_rows(spark, tmp_path):
    """The first attempt fails while it reads; the second one's figures hold nothing of the first."""
    tries = []

    def source():
        tries.append(1)
        frame = spark.createDataFrame([(k, T0, "x") for k in range(8)], "id bigint, ts timestamp_ntz, v string").repartition(4)
        if len(tries) > 1:
            return frame
        return frame.withColumn("v", F.when(F.col("id") == 5, F.raise_error(F.lit("broken"))).otherwise(F.col("v")))

    store = StateStore(spark, str(tmp_path / "state"))
    snapshots = Snapshots(store)
    store.add_configs([{**CONFIG, "RetryCount": 2, "RetryIntervalSeconds": 0}])
    run_pipeline(store, snapshots, Sources(spark, {}, Frames({("src", "t"): source})), "r1")
    found = store.current(tables.ATTEMPT).orderBy("TableLoadAuditId").select("Status", "SourceRowCount", "TargetRowCount").collect()
    assert [tuple(r) for r in found] == [("FAILURE", None, None), ("SUCCESS", 8, 8)]


def test_folder_sources_fix_the_mark_before_they_are_read(spark, tmp_path):
    lake = ParquetFolder(str(tmp_path / "lake"))
    _files(tmp_path / "lake" / "src" / "t", [_instants(1, 2, 3, -1)])
    store = StateStore(spark, str(tmp_path / "state"))
    snapshots = Snapshots(store)
    store.add_configs([{**CONFIG, "ConnectionReference": "lake"}])
    sources = Sources(spark, {"lake": lake})
    load_table(store, snapshots, sources, 1, "r1")
    _files(tmp_path / "lake" / "src" / "t", [_instants(1, 2, 3, -1), _instants(4, 5, 2.5)])
    load_table(store, snapshots, sources, 1, "r2")
    load_table(store, snapshots, sources, 1, "r3")
    found = store.current(tables.ATTEMPT).orderBy("TableLoadAuditId").select("SourceRowCount", "TargetRowCount").collect()
    assert [tuple(r) for r in found] == [(3, 3), (2, 5), (0, 5)]
    assert store.config(1)["LastWatermarkValue"] == T0 + timedelta(days=5)


def test_database_is_asked_for_marks_and_bounds(spark):
    """By reader options only: no database may run here."""
    seen = []

    def load(session, options):
        seen.append(dict(options))
        if "query" not in options:
            return session.range(3)
        if "MIN" in options["query"]:
            return session.sql("SELECT 5L AS low, 900L AS high")
        return session.sql("SELECT TIMESTAMP '2024-03-01 12:00:00 UTC' AS top, 7L AS all_rows, 4L AS marked")

    db = JdbcDatabase("jdbc:x", {"fetchsize": "9"}, {("s", "t"): "id"}, partitions=16, load=load)
    df = db.read(spark, "s", "t")
    assert db.marks(df, "s", "t", 'm"k') == Marks(datetime(2024, 3, 1, 12), 7, 3)
    assert seen == [
        {"url": "jdbc:x", "fetchsize": "9", "query": 'SELECT MIN("id") AS low, MAX("id") AS high FROM "s"."t"'},
        {
            "url": "jdbc:x", "dbtable": '"s"."t"', "fetchsize": "9",
            "partitionColumn": "id", "lowerBound": "5", "upperBound": "900", "numPartitions": "16",
        },
        {
            "url": "jdbc:x", "fetchsize": "9",
            "query": 'SELECT MAX("m""k") AS top, COUNT(*) AS all_rows, COUNT("m""k") AS marked FROM "s"."t"',
        },
    ]
    plain = JdbcDatabase("jdbc:x", load=load)
    plain.read(spark, "s", "t")
    assert seen[-1] == {"url": "jdbc:x", "dbtable": '"s"."t"'}


def test_a_hanging_table_is_ended_and_repeated(spark, tmp_path):
    """One table's source hangs once: that attempt fails at its limit, is repeated, and another table loads meanwhile."""
    import time

    tries = []

    def hang(batches):
        time.sleep(90)
        yield from batches

    def slow():
        tries.append(1)
        frame = spark.createDataFrame([(1, T0, "x")], "id bigint, ts timestamp_ntz, v string")
        return frame.mapInArrow(hang, frame.schema) if len(tries) == 1 else frame

    store = StateStore(spark, str(tmp_path / "state"))
    store.add_configs([{**CONFIG, "RetryCount": 1, "RetryIntervalSeconds": 0}, {**CONFIG, "SourceTable": "u", "TargetTable": "u"}])
    quick = spark.createDataFrame([(k, T0, "x") for k in range(3)], "id bigint, ts timestamp_ntz, v string")
    sources = Sources(spark, {}, Frames({("src", "t"): slow, ("src", "u"): lambda: quick}))
    began = time.monotonic()
    done = run_pipeline(store, Snapshots(store), sources, "r1", limit_seconds=20)
    assert done.status == "SUCCESS" and time.monotonic() - began < 85
    found = store.current(tables.ATTEMPT).orderBy("ConfigId", "TableLoadAuditId").select("ConfigId", "Status", "ErrorMessage").collect()
    assert [tuple(r) for r in found] == [
        (1, "FAILURE", "The attempt exceeded its time limit of 20 seconds."),
        (1, "SUCCESS", None),
        (2, "SUCCESS", None),
    ]


def test_a_new_driver_closes_published_attempts(spark, tmp_path, monkeypatch):
    """The first run with a store closes what a lost driver had published; later runs do not look again."""
    frame = spark.createDataFrame([(1, T0, "x")], "id bigint, ts timestamp_ntz, v string")
    sources = Sources(spark, {}, Frames({("src", "t"): lambda: frame}))
    store = StateStore(spark, str(tmp_path / "state"))
    store.add_configs([CONFIG])

    class Gone(BaseException):
        pass

    def lost(*args):
        raise Gone

    monkeypatch.setattr("tidegate.plans.load._record_success", lost)
    with pytest.raises(Gone):
        load_table(store, Snapshots(store), sources, 1, "r1")
    monkeypatch.undo()
    store = StateStore(spark, str(tmp_path / "state"))
    run_pipeline(store, Snapshots(store), sources, "r2")
    statuses = [r["Status"] for r in store.current(tables.ATTEMPT).orderBy("TableLoadAuditId").collect()]
    assert statuses == ["SUCCESS", "SUCCESS"] and not store.first_run()


def test_declared_columns_decide_the_fingerprint(spark):
    """Scale of times, length and nullability come from the information schema; a change of any is a drift."""
    base = [("id", "int", None, 10, 0, None, "NO"), ("ts", "datetime2", None, None, None, 7, "NO"), ("v", "nvarchar", -1, None, None, None, "YES"),
            ("day", "date", None, None, None, 0, "YES"), ("n", "decimal", None, 18, 3, None, "YES"), ("b'c", "varchar", 20, None, None, None, "YES")]
    schema = "column_name string, data_type string, l int, p int, s int, d int, is_nullable string"
    asked_for = []

    def source(rows):
        def load(session, options):
            asked_for.append(options.get("query"))
            if "query" in options:
                return session.createDataFrame(rows, schema)
            return session.sql("SELECT 1 AS id, TIMESTAMP_NTZ '2024-01-01' AS TS, '' AS v, DATE '2024-01-01' AS day, 1.5BD AS n, '' AS `b'c`, 2 AS extra")

        return Sources(spark, {"db": JdbcDatabase("jdbc:x", load=load)})

    def print_of(rows):
        sources = source(rows)
        return fingerprint(sources.read("s", "it's", "db").schema, declared=sources.declared("s", "it's", "db"))

    plain = print_of(base)
    assert plain.definition == "id:int:0|TS:datetime2(7):0|v:nvarchar(max):1|day:date:1|n:decimal(18,3):1|b'c:varchar(20):1|extra:int:0"
    assert "table_name = 'it''s'" in asked_for[-1]
    changes = [(1, 5, 3), (1, 6, "YES"), (2, 2, 100), (4, 4, 2), (5, 2, 21)]
    hashes = {print_of([tuple(new if (i, j) == (row, column) else x for j, x in enumerate(r)) for i, r in enumerate(base)]).hash for row, column, new in changes}
    assert len(hashes | {plain.hash}) == 6
    assert JdbcDatabase("jdbc:x", information_schema=False).declared(spark, "s", "t") == []
