"""Every stage against its rule on the stage's own input, and the whole against the stages."""

from collections import Counter, defaultdict

import corpus_pipeline
import pytest
from support import docs_frame
from test_decontamination import dc
from test_packing import check
from test_simhash import slow_fingerprint, slow_groups

from tidegate.llm import langid, packing, quality
from tidegate.state.shared import shared_root, stage


@pytest.fixture(scope="module")
def steps(spark, sf_dir):
    """Rows before the first stage and after each one."""
    folder, docs = shared_root(spark), spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = [docs]
    for name, work in corpus_pipeline.STAGES:
        docs = stage(work(spark, docs, sf_dir), f"{folder}/{name}")
        out.append(docs)
    return out


def test_columns(steps):
    assert all(frame.columns == steps[0].columns for frame in steps[1:-1])
    assert steps[-1].columns == packing.COLUMNS


def rows(frame):
    return {r["doc_id"]: tuple(r) for r in frame.collect()}


def test_stages_only_drop_rows(steps):
    for before, after in zip(steps[:-2], steps[1:-1]):
        kept, given = rows(after), rows(before)
        assert kept.items() <= given.items() and len(kept) == after.count()


def test_language_and_quality_keep_clean_documents(spark, steps, sf_dir):
    labels = {r["doc_id"]: r for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    given, first, second = (set(rows(f)) for f in steps[:3])
    assert len(given - first) <= 0.01 * len(given)
    good = {d for d in first if d in labels and labels[d]["quality"] == 1}
    bad = {d for d in first if d in labels and labels[d]["quality"] == 0}
    assert len(good & second) >= 0.98 * len(good)
    assert len(bad & second) <= 0.3 * len(bad)


def test_near_duplicates(steps):
    given, kept = rows(steps[2]), rows(steps[3])
    ids = sorted(given)
    groups = slow_groups([slow_fingerprint(given[d][1]) for d in ids], 3)
    assert set(kept) == {ids[g] for g in groups}


def test_near_duplicates_keep_one_row_of_each_group(spark, sf_dir):
    one, two, three, four = (" ".join(f"{w}{k}" for k in range(60)) for w in ("ape", "bee", "cat", "dog"))
    data = [(None, one), (None, one), (7, one), (7, one), (8, one)]  # an id goes before none
    data += [(None, two), (None, two)]  # no row has an id
    data += [(5, three), (6, three), (3, four), (5, four), (5, "e f g h i j"), (9, "e f g h i j")]  # 5 names two groups
    kept = corpus_pipeline.near_duplicates(spark, docs_frame(spark, data).repartition(3), sf_dir)
    assert sorted((r["text"], r["doc_id"] or 0) for r in kept.collect()) == [(one, 7), (two, 0), (three, 5), (four, 3), ("e f g h i j", 5)]


def test_decontamination(spark, steps, sf_dir):
    items = [dc.normal(r["text"]) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    given, kept = rows(steps[3]), rows(steps[4])
    exact = {d for d, row in given.items() if any(i in dc.normal(row[1]) for i in items)}
    dropped = set(given) - set(kept)
    assert exact <= dropped and len(dropped - exact) <= max(1, len(exact) // 10)


def test_packing(steps):
    documents = [(r["doc_id"], r["text"]) for r in steps[4].collect()]
    assert check(steps[5].collect(), documents) == 0


def test_run_gives_the_last_stage(spark, steps, sf_dir):
    def total(frame):
        sums = defaultdict(int)
        for r in frame.collect():
            sums[r["doc_id"], r["doc_tokens"]] += r["length"]
        return sums

    assert total(corpus_pipeline.run(spark, sf_dir)) == total(steps[-1])


EDGE = [(1, None), (2, ""), (None, "a text without an id that goes on for a while"), (3, " \n"), (4, "x" * 200_000), (5, "same words here " * 20), (5, "same words here " * 20)]


SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def edge_frame(spark, data):
    return docs_frame(spark, [(i, t, "en", "s", 1) for i, t in data], SCHEMA)


@pytest.mark.parametrize("data", [EDGE, []])
def test_stages_on_edge_rows(spark, sf_dir, data):
    frame = edge_frame(spark, data)
    got = {name: work(spark, frame, sf_dir) for name, work in corpus_pipeline.STAGES}
    kept = {name: Counter((r["doc_id"], r["text"]) for r in out.collect()) for name, out in got.items() if name != "packing"}
    given = Counter(data)
    # one language is known, so every text with a letter has it
    assert kept["language_id"] == Counter({row: n for row, n in given.items() if row[1] and row[1].strip()})
    assert kept["quality"] <= kept["language_id"]
    # texts without a word are one group; so are the two equal rows
    assert kept["near_duplicates"] == Counter({row: 1 for row in given if row[0] not in (2, 3)})
    assert kept["decontamination"] == given
    assert check(got["packing"].collect(), data) == 0
    assert langid.predict(frame, langid.train(frame, corpus_pipeline.F.lit(True))).count() == len(data)
    assert quality.classify(frame, quality.train(frame)).count() == len(data)


CLASH = ["_row", "row", "key", "score", "kept", "_judged", "rejected", "quality", "_lang", "lang_pred", "_lowered", "_lettered", "_pattern", "id"]


def test_stages_return_rows_as_given(spark, steps, sf_dir):
    """Also columns that are named like those used inside."""
    frame = steps[0].selectExpr("*", *[f"concat('{c}', doc_id) AS `{c}`" for c in CLASH])
    given = rows(frame)
    for name, work in corpus_pipeline.STAGES[:-1]:
        out = work(spark, frame, sf_dir)
        kept = rows(out)
        assert out.columns == frame.columns and kept.items() <= given.items() and kept, name


def test_rows_without_ids_or_languages_stay(spark, steps, sf_dir):
    docs = steps[0]
    count = docs.count()
    nameless = docs.withColumn("doc_id", corpus_pipeline.F.lit(None).cast("bigint"))
    assert corpus_pipeline.language_id(spark, nameless, sf_dir).count() >= 0.99 * count
    texts = lambda frame: {r["text"] for r in frame.select("text").collect()}
    with_ids, without = (texts(corpus_pipeline.quality_classifier(spark, d, sf_dir)) for d in (docs, nameless))
    assert len(with_ids ^ without) <= 0.02 * len(with_ids)
    speechless = docs.withColumn("lang", corpus_pipeline.F.lit(None).cast("string"))
    assert rows(corpus_pipeline.language_id(spark, speechless, sf_dir)) == rows(speechless)
