"""Operators against brute force: skewed groups, NULL keys, time zones, windows."""

import random
from collections import Counter, defaultdict
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidegate.functions import concat0, iso_utc, object_name, quotename, seconds_between
from catalogue.queries import QUERIES
from tidegate.operators import approvals, attempts, calendar, gates, highwater, lookup, publish, validate
from tidegate.sources import (
    CatalogTables,
    JdbcDatabase,
    ParquetFolder,
    Sources,
    column_catalog,
)
from tidegate.state.vocabulary import LoadError

T0 = datetime(2024, 3, 10)


def test_text_helpers(spark):
    row = spark.sql("SELECT 'a]b' AS s, 't' AS t, CAST(NULL AS STRING) AS n").select(
        quotename("s").alias("q"),
        object_name("s", "t").alias("o"),
        object_name("n", "n").alias("absent"),
        concat0("n", "t", F.lit(3)).alias("c"),
    )
    assert tuple(row.first()) == ("[a]]b]", "[a]]b].[t]", ".", "t3")


def test_seconds_between_counts_boundaries(spark):
    pairs = [
        (datetime(2024, 1, 1, 0, 0, 0, 900000), datetime(2024, 1, 1, 0, 0, 1, 100000)),
        (datetime(2024, 3, 10, 1, 59, 59), datetime(2024, 3, 10, 3, 0, 0)),  # a skipped local hour
        (datetime(2024, 1, 2), datetime(2024, 1, 1)),
        (datetime(2024, 1, 1), None),
    ]
    df = spark.createDataFrame(pairs, "a timestamp_ntz, b timestamp_ntz")
    got = [r[0] for r in df.select(seconds_between("a", "b")).collect()]
    assert got == [1, 3601, -86400, None]
    text = df.select(iso_utc("a")).first()[0]
    assert text == "2024-01-01T00:00:00.9000000Z"


def test_attempt_numbers_split_a_hot_group(spark):
    rng = random.Random(3)
    rows = []
    for i in rng.sample(range(1, 100_000), 6000):
        hot = rng.random() < 0.4
        rows.append((i, "hot" if hot else f"run {rng.randrange(50)}", 1 if hot else rng.choice([1, 2, None])))
    df = spark.createDataFrame(rows, "TableLoadAuditId bigint, AdfPipelineRunId string, ConfigId int")
    got = attempts.attempt_numbers(df, block_bits=9)
    groups = defaultdict(list)
    for i, run, config in sorted(rows):
        groups[run, config].append(i)
    expected = {i: n for ids in groups.values() for n, i in enumerate(ids, start=1)}
    assert {r[0]: r["AttemptNumber"] for r in got.collect()} == expected
    assert got.columns == [*df.columns, "AttemptNumber"]


def test_run_outcomes(spark):
    rows = [
        (1, "a", 1, "FAILURE"),
        (2, "a", 1, "SUCCESS"),
        (3, "a", 2, "FAILURE"),
        (4, "b", 1, "RUNNING"),
        (5, "c", 1, "SUCCESS"),
        (6, "c", 1, "FAILURE"),
    ]
    df = spark.createDataFrame(
        rows, "TableLoadAuditId bigint, AdfPipelineRunId string, ConfigId int, Status string"
    )
    got = {r[0]: (r[1], r[2], r["Status"]) for r in attempts.finalize(df).collect()}
    assert got == {"a": (1, 1, "PARTIAL_SUCCESS"), "b": (0, 0, "SUCCESS"), "c": (0, 1, "FAILURE")}
    latest = {(r[0], r[1]): r["Status"] for r in attempts.latest_attempts(df).collect()}
    assert latest == {("a", 1): "SUCCESS", ("a", 2): "FAILURE", ("b", 1): "RUNNING", ("c", 1): "FAILURE"}
    retries = {r[0]: r[1] for r in attempts.retry_totals(df).collect()}
    assert retries == {"a": 1, "c": 1, None: 2}


def test_gates_with_hot_and_null_keys(spark):
    rng = random.Random(5)
    stage = [rng.choice([7, 7, None, rng.randrange(300)]) for _ in range(2000)]
    target = [rng.choice([9, None, rng.randrange(300)]) for _ in range(2000)]
    s = spark.createDataFrame([(k,) for k in stage], "k int")
    t = spark.createDataFrame([(k,) for k in target], "k int")
    per_key = Counter(target)
    expected = {
        "stage_rows": 2000,
        "target_rows": 2000,
        "duplicate_keys": sum(n > 1 for n in per_key.values()),
        "null_keys": per_key[None],
        "missing_keys": sum(k is None or k not in per_key for k in stage),
    }
    assert gates.reconcile(s, t, "k").first().asDict() == expected
    halves = gates.reconcile(s, t, "k", F.coalesce(F.col("k") % 2, F.lit(0))).collect()
    assert {m: sum(h[m] for h in halves) for m in expected} == expected
    profile = gates.key_profile(t, "k").first()
    assert (profile["rows"], profile["duplicate_keys"], profile["null_keys"]) == (
        2000,
        expected["duplicate_keys"],
        expected["null_keys"],
    )
    empty = gates.gate2(s.limit(0), t.limit(0), "k", full=True)
    assert [r["Result"] for r in empty.collect()] == ["PASS"] * 4
    assert gates.any_failed(gates.gate1(s, t, "k"))
    assert not gates.any_failed(empty)


@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp", "date"])
def test_windows_split_anywhere_and_join_up(spark, kind):
    days = [(i, T0 + timedelta(days=i % 20, hours=0 if kind == "date" else i)) for i in range(60)]
    days.append((60, None))
    df = spark.createDataFrame(days, "id int, ts timestamp_ntz").withColumn("ts", F.col("ts").cast(kind))
    captured = highwater.capture(df, "ts")
    whole = {r.id for r in highwater.window(df, "TS", None, captured).collect()}
    assert whole == set(range(60))
    for cut in (T0, T0 + timedelta(days=7), captured):
        first = [r.id for r in highwater.window(df, "ts", None, cut).collect()]
        found = highwater.capture_window(df, "ts", cut)
        assert found == (captured, 60 - len(first))
        rest = [r.id for r in highwater.window(df, "ts", cut, captured).collect()]
        assert sorted(first + rest) == list(range(60))
    assert highwater.capture_window(df, "ts", None) == (captured, 60)
    assert highwater.capture_window(df.limit(0), "ts", None) == (None, 0)
    assert highwater.capture(df.limit(0), "ts") is None
    assert highwater.window(df, "ts", None, None).count() == 0


def test_window_reaches_the_scan(spark, tmp_path):
    spark.range(10).selectExpr("id", "timestamp_ntz '2024-01-01' AS ts").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    plan = highwater.window(df, "ts", T0, T0 + timedelta(1))._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(ts,2024-03-10T00:00)" in plan and "LessThanOrEqual(ts,2024-03-11T00:00)" in plan


def test_upsert_keeps_null_keys_and_schema(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "k int, v string")
    stage = spark.createDataFrame([(2, "B", 5), (3, "C", 6)], "K bigint, v string, extra int")
    got = publish.upsert(target, stage.withColumnRenamed("K", "k"), "k")
    assert got.dtypes == [("k", "int"), ("v", "string"), ("extra", "int")]
    rows = {tuple(r) for r in got.collect()}
    assert rows == {(1, "a", None), (None, "n", None), (2, "B", 5), (3, "C", 6)}
    assert publish.unpublished(got, target, "k").count() == 2  # key 3 and the NULL key
    with pytest.raises(LoadError, match="1 repeated"):
        publish.require_unique_key(target.unionAll(target.limit(1)), "k")


def test_calendar_covers_whole_years(spark):
    df = spark.createDataFrame([(datetime(2023, 5, 6, 23),), (datetime(2024, 2, 1),), (None,)], "ts timestamp_ntz")
    days = calendar.date_dimension(df, "ts")
    assert days.count() == 365 + 366
    first = days.orderBy("Date").first()
    assert tuple(first) == (date(2023, 1, 1), 2023, 1, "Qtr 1", 1, "January", 1)
    per_day = calendar.by_date(df, "ts", days.select("Date"), "n")
    assert per_day.count() == 731 and per_day.filter("n > 0").count() == 2
    assert calendar.date_dimension(df.limit(0), "ts").count() == 0


def test_rules_report_offenders(spark):
    config = spark.createDataFrame(
        [("s", "a", "Yes", "FULL", None), ("s", "a", "No", "WATERMARK", None), ("s", "b", "x", None, "m")],
        "SourceSchema string, SourceTable string, Load string, LoadType string, WatermarkColumn string",
    )
    found = {r.rule: r.offending for r in validate.validate_config(config).collect()}
    assert found == {
        "LOAD_DOMAIN": 1,
        "LOAD_TYPE_DOMAIN": 1,
        "WATERMARK_NEEDS_COLUMN": 1,
        "51003": 1,
        "UNIQUE_SOURCE": 1,
        "51001": 0,
        "51002": 0,
    }
    none = {r.rule: r.offending for r in validate.validate_config(config.limit(0)).collect()}
    assert none["51001"] == none["51002"] == 1


def test_sources(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "src" / "t"))
    spark.range(4).createOrReplaceTempView("some_view")
    sources = Sources(spark, {"files": ParquetFolder(str(tmp_path))}, CatalogTables())
    frozen = sources.read("src", "t", "files")
    spark.range(2).write.mode("append").parquet(str(tmp_path / "src" / "t"))
    assert frozen.count() == 3  # a load sees the files there were when it began
    assert sources.read("src", "t", "files").count() == 5
    for schema, table, reference in [("src", "absent", "files"), ("default", "absent", None)]:
        with pytest.raises(LoadError) as failure:
            sources.read(schema, table, reference)
        assert failure.value.code == 50012
    split = {"partitionColumn": "id", "lowerBound": 0, "upperBound": 9, "numPartitions": 3}
    db = JdbcDatabase("jdbc:x", {"fetchsize": "1000"}, {("s", 't"q'): split})
    assert db.options("s", 't"q') == {
        "url": "jdbc:x",
        "dbtable": '"s"."t""q"',
        "fetchsize": "1000",
        "partitionColumn": "id",
        "lowerBound": "0",
        "upperBound": "9",
        "numPartitions": "3",
    }
    columns = column_catalog(spark, {"t": sources.read("src", "t", "files")})
    assert [tuple(r) for r in columns.collect()] == [("t", 1, "id", "bigint", True)]


def test_latest_by_and_evidence(spark):
    df = spark.createDataFrame([(1, "a", 1), (2, "a", 1), (3, "b", 2)], "id int, s string, k int")
    got = sorted(tuple(r) for r in lookup.latest_by(df, ["k"], "id", ["id", "s"]).collect())
    assert got == [(1, 2, "a"), (2, 3, "b")]
    assert [r.id for r in lookup.evidence(df, "X", "id").collect()] == [3, 2, 1]


def test_merge_updates_named_columns_only(spark):
    target = spark.createDataFrame([(1, "a", "keep"), (2, "b", "keep"), (None, "n", "keep")], "k int, v string, own string")
    source = spark.createDataFrame([("new", 9, 2), ("ins", 9, 3), ("null", 9, None), ("null", 9, None)], "V string, extra int, K int")
    got = publish.merge(target, source, "k")
    assert got.columns == ["k", "v", "own", "extra"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == sorted(
        [(1, "a", "keep", None), (2, "new", "keep", 9), (3, "ins", None, 9), (None, "n", "keep", None), (None, "null", None, 9), (None, "null", None, 9)],
        key=str,
    )
    with pytest.raises(LoadError):
        publish.merge(target, source.unionAll(source), "k")


def test_first_valid_decision_wins(spark):
    requests = spark.createDataFrame(
        [(1, 7, "h1", "PENDING"), (2, 8, "h2", "APPROVED"), (3, 9, "h3", "PENDING")],
        "SchemaChangeRequestId bigint, ConfigId int, DetectedSchemaHash string, Status string",
    )
    decisions = spark.createDataFrame(
        [(1, 1, "MAYBE", "x"), (2, 1, "APPROVED", "a"), (3, 1, "REJECTED", "b"), (4, 1, "APPROVED", "c"), (5, 2, "REJECTED", "d"), (6, 4, "APPROVED", "e")],
        "DecisionId bigint, SchemaChangeRequestId bigint, Decision string, DecisionBy string",
    )
    applied = {r[0]: r["Status"] for r in approvals.apply_decisions(requests, decisions).collect()}
    assert applied == {1: "APPROVED", 2: "APPROVED", 3: "PENDING"}
    errors = approvals.decision_errors(requests, decisions).collect()
    assert Counter((r[0], r["ErrorCode"]) for r in errors) == Counter({(1, 50001): 1, (1, 50003): 2, (2, 50003): 1, (4, 50002): 1})
    history = spark.createDataFrame([(7, 3)], "ConfigId int, SchemaVersion int")
    versions = approvals.next_versions(requests, decisions, history).collect()
    assert [(r["ConfigId"], r["SchemaVersion"], r["ApprovedBy"]) for r in versions] == [(7, 4, "a")]


@pytest.mark.parametrize("name", ["alert_payloads", "latest_attempt_per_config", "detect_changes", "schema_diff"])
def test_logs_are_not_sorted_to_find_the_newest(spark, name):
    frame = QUERIES[name](spark, "/root/testdata/sf0.001")
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan


def test_nested_keys_are_never_small(spark):
    frame = spark.createDataFrame([([1, 2],)], "k array<int>")
    assert gates.key_profile(frame, "k").first()["key_bytes"] > 1 << 39
