"""Keys under a collation, through gates, upsert, merge and loads."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidegate.operators import gates, publish
from tidegate.operators.keys import COLLATIONS, hashable, key_column
from tidegate.plans.load import load_table
from tidegate.sources import Frames, Sources
from tidegate.state.snapshots import Layout, Snapshots
from tidegate.state.store import StateStore
from tidegate.state.vocabulary import LoadError

LCASE = "UTF8_LCASE_RTRIM"
T0 = datetime(2024, 3, 1)


@pytest.mark.parametrize("collation", COLLATIONS)
def test_equal_keys_hash_alike(spark, collation):
    """Over every character of the basic plane, alone, at the end of a word, and before blanks."""
    codes = spark.range(1, 0xFFFE).filter("id < 55296 OR id > 57343")
    texts = codes.selectExpr("decode(unhex(lpad(hex(id), 4, '0')), 'UTF-16BE') AS c").selectExpr(
        "explode(array(c, concat('a', c), concat(c, 'a'), concat(c, '  '), upper(c), lower(c), concat('A', upper(c)), concat('a', lower(c), ' '))) AS s"
    )
    keys = texts.select(key_column(texts, "s", collation).alias("k"), "s")
    apart = keys.groupBy("k").agg(F.count_distinct(hashable(F.col("s"), collation)).alias("n")).filter("n > 1")
    assert apart.isEmpty()
    merged = keys.agg(F.count_distinct("k"), F.count_distinct("s")).first()
    assert merged[0] < merged[1]


def test_only_text_is_collated(spark):
    df = spark.createDataFrame([(1,), (1,)], "id int")
    assert gates.key_profile(df, "id", LCASE).first()["duplicate_keys"] == 1


def test_profile_and_reconcile(spark):
    staged = spark.createDataFrame([("a",), ("A ",), (" a",), (None,), ("é",), ("É  ",)], "k string")
    found = gates.key_profile(staged, "k", LCASE).first()
    assert (found["rows"], found["duplicate_keys"], found["null_keys"]) == (6, 2, 1)
    assert gates.key_profile(staged, "k").first()["duplicate_keys"] == 0
    target = spark.createDataFrame([("a  ",), (" A",), ("é",), ("e",)], "k string")
    found = gates.reconcile(staged, target, "k", collation=LCASE).first()
    assert (found["missing_keys"], found["duplicate_keys"]) == (1, 0)
    assert publish.unpublished(staged, target, "k", LCASE).collect() == [(None,)]


@pytest.mark.parametrize("small", [True, False])
def test_survivors(spark, small):
    target = spark.createDataFrame([("a", 1), ("B ", 2), (None, 3), ("c", 4)], "k string, n int")
    stage = spark.createDataFrame([("A", 9), ("b", 9), (None, 9)], "k string, n int")
    left = publish.survivors(target, stage, "k", small, LCASE)
    assert left.columns == ["k", "n"] and sorted(r["n"] for r in left.collect()) == [3, 4]


def test_merge_source_must_not_repeat_a_key(spark):
    target = spark.createDataFrame([("a", 1)], "k string, n int")
    source = spark.createDataFrame([("A", 2), ("a ", 3)], "k string, n int")
    assert publish.merge(target, source, "k").count() == 3
    with pytest.raises(LoadError):
        publish.merge(target, source, "k", LCASE)
    merged = publish.merge(target, source.filter("n = 2"), "k", LCASE)
    assert [tuple(r) for r in merged.collect()] == [("A", 2)]


@pytest.mark.parametrize("rows_per_bucket,bytes_", [(3, 1 << 20), (3, 0), (1000, 1 << 20)])
def test_deltas_replace_other_spellings(spark, tmp_path, rows_per_bucket, bytes_):
    """Against a dictionary by lower-cased, right-trimmed key, over many buckets."""
    data, truth = [], {}

    def source():
        return spark.createDataFrame(data, "k string, ts timestamp_ntz, n int")

    store = StateStore(spark, str(tmp_path))
    snapshots = Snapshots(store, Layout(rows_per_bucket, bytes_))
    base = {"SourceTable": "t", "TargetTable": "t", "Load": "Yes", "LoadType": "WATERMARK", "WatermarkColumn": "ts", "PrimaryKeyColumn": "k"}
    store.add_configs([{**base, "KeyCollation": LCASE}])
    words = ["Ab", "ΟΔΟΣ", "straße", "漢字", "x y", "É", "kK", "zz"]
    for step, spell in enumerate((str, str.lower, lambda w: w.upper() if w != "straße" else w, lambda w: w.lower() + "  ")):
        rows = [(spell(w), T0 + timedelta(days=step), step) for k, w in enumerate(words) if step == 0 or k % 3 != step % 3]
        data[:] = rows
        truth |= {w.lower(): (spell(w), step) for w in words if any(r[0] == spell(w) for r in rows)}
        load_table(store, snapshots, Sources(spark, {}, Frames({("src", "t"): source})), 1, f"r{step}")
        assert sorted((r["k"], r["n"]) for r in snapshots.table(1).collect()) == sorted(truth.values())


def test_unknown_collation_is_refused(spark, tmp_path):
    store = StateStore(spark, str(tmp_path))
    row = {"SourceTable": "t", "TargetTable": "t", "Load": "Yes", "LoadType": "FULL", "PrimaryKeyColumn": "k", "KeyCollation": "UNICODE_CI"}
    with pytest.raises(LoadError, match="KeyCollation"):
        store.add_configs([row])


# --- integer keys by bitmaps ------------------------------------------------------


def _range(df, key, files=1):
    columns = gates.key_range_columns(df, key)
    row = df.agg(F.count("*").alias("rows"), *[c.alias(n) for n, c in columns.items()]).first()
    return gates.KeyRange(row["rows"], row["low"], row["high"], files)


@pytest.mark.parametrize(
    "keys",
    [
        list(range(-40000, 70000, 3)),
        [-(2**63), 2**63 - 1, 0, -1, 1, 32768, 32769, -32768],
        [5, None, 6],
        [5, None, None],
        [5, 5, 6, None],
        [7] * 900 + list(range(1000, 1400)),
        [],
    ],
)
def test_integer_profile(spark, keys):
    df = spark.createDataFrame([(k,) for k in keys], "id bigint").repartition(3)
    p = gates.integer_profile(df, "id").first()
    known = [k for k in keys if k is not None]
    assert (p["rows"], p["distinct_keys"], p["null_keys"]) == (len(keys), len(set(known)), len(keys) - len(known))
    plain = gates.key_profile(df, "id").first()
    measured = gates.measured_profile(df, "id", _range(df, "id"))
    assert all(measured[name] == plain[name] for name in ("rows", "duplicate_keys", "null_keys", "key_bytes"))


def test_bitmaps_where_they_pay(spark):
    dense = gates.KeyRange(10_000_000, 1, 10_000_000, 20)
    assert gates.bitmaps_pay(dense)
    assert not gates.bitmaps_pay(gates.KeyRange(10_000_000, 1, 10_000_000, 2000))  # every file may hit every page
    assert not gates.bitmaps_pay(gates.KeyRange(10_000_000, 1, 10**15, 20))
    assert not gates.bitmaps_pay(gates.KeyRange(0, None, None, 0))
    assert gates.key_range_columns(spark.createDataFrame([("a",)], "k string"), "k") == {}


def test_only_bitmaps_are_shuffled(spark):
    plan = gates.integer_profile(spark.range(10).toDF("id"), "id")._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert exchanges and not any("id#" in line for line in exchanges)


def test_sequence_numbers_of_a_frame_differ(spark, tmp_path):
    from tidegate.state import tables

    store = StateStore(spark, str(tmp_path))
    for _ in range(2):
        events = spark.range(50).repartition(4).selectExpr("id AS NotificationAuditId", "'x' AS Payload")
        wanted = [f for f in tables.OUTBOX.schema if f.name not in ("_seq", "LogDate")]
        rows = events.select(*[
            F.col(f.name).cast(f.dataType) if f.name in events.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in wanted
        ])
        store.append_frame(tables.OUTBOX, rows)
    seqs = [r["_seq"] for r in store.read(tables.OUTBOX).select("_seq").collect()]
    assert len(seqs) == len(set(seqs)) == 100
