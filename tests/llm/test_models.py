"""Language, quality and toxicity: held-out accuracy, folds, edge rows, model pieces."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from support import docs_frame

from tidegate.llm import hashing, langid, quality, toxicity
from tidegate.llm.registry import QUERIES, remainder


def test_words_and_prefixes():
    data = np.frombuffer(b"  One oNE; on one2 \xc3\xa9t", np.uint8)
    start, stop, mark, valid = hashing.words(data, (2,))
    assert [bytes(data[a:b]).lower() for a, b in zip(start, stop)] == [b"one", b"one", b"on", b"one", b"\xc3\xa9t"]
    assert mark[0, 0] == mark[1, 0] == mark[3, 0] != mark[2, 0]
    assert mark[0, 1] == mark[1, 1] and valid[:, 1].tolist() == [True, True, False, True, True]


@pytest.mark.parametrize("limit", [5, 64, 1 << 20])
def test_blocks_hold_whole_texts(limit):
    texts = pa.array(["", None, "one two three four", "x" * 40, "é " * 30])
    parts = {}
    for block in hashing.blocks(texts, limit):
        for k, a, b in zip(block.docs, block.starts, block.stops):
            parts[k] = parts.get(k, b"") + bytes(block.data[a:b])
            assert b - a <= limit
    assert [parts[k].decode() for k in range(5)] == [t or "" for t in texts.to_pylist()]


def test_block_sums_are_per_text():
    block = next(hashing.blocks(pa.array(["ab", "", "c d"])))
    ones = np.ones(len(block.data))
    assert block.sums(ones).tolist() == [3, 1, 4]


# --- language ---------------------------------------------------------------------


def test_language_query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = QUERIES["op2_language_id"](spark, sf_dir).join(docs.select("doc_id", "lang", "text"), "doc_id").collect()
    assert len(out) == docs.count()
    import zlib

    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in out)
    held = [r for r in out if r["held_out"]]
    assert np.mean([r["lang"] == r["lang_pred"] for r in held]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in out) and np.mean([r["rejected"] for r in out]) < 0.01


def test_language_never_sees_the_held_out_fold(spark, sf_dir):
    """Other labels in the fold that is not learned from change nothing."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    spoilt = docs.withColumn("lang", F.when(remainder("doc_id", 4) == 2, "xx").otherwise(F.col("lang")))
    one, two = (langid.train(d, remainder("doc_id", 4) != 2) for d in (docs, spoilt))
    assert one.languages == two.languages and (one.weights == two.weights).all()


def test_language_edge_rows(spark, sf_dir):
    train = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(120)
    model = langid.train(train, F.lit(True))
    rows = [(1, None), (2, ""), (3, "123 !?"), (4, "漢字"), (None, "the and of that"), (5, "the " * 100_000), (5, "the " * 100_000)]
    got = langid.predict(docs_frame(spark, rows), model).select("doc_id", "lang_pred", "score", "rejected").collect()
    assert [r["lang_pred"] for r in got[:3]] == ["und"] * 3 and all(r["rejected"] and r["score"] == 0 for r in got[:3])
    assert got[3]["lang_pred"] in model.languages and got[5][1:] == got[6][1:]
    nothing = langid.train(train.withColumn("lang", F.lit(None).cast("string")), F.lit(True))
    assert {r["lang_pred"] for r in langid.predict(train, nothing).collect()} == {"und"}
    assert langid.predict(docs_frame(spark, []), model).collect() == []


def test_long_text_is_scored_whole():
    """Parts of a long text add up to the score of the text in one piece."""
    rng = np.random.default_rng(1)
    model = langid.Model(["a", "b"], rng.normal(size=(1 << langid.BITS, 2)).astype(np.float32), np.zeros(2, np.float32), 1.0, 0.0)
    text = pa.array(["some words that go on " * 2000])
    whole = langid.logits(text, model)
    limit, hashing.blocks.__defaults__ = hashing.blocks.__defaults__, (1000,)
    try:
        parts = langid.logits(text, model)
    finally:
        hashing.blocks.__defaults__ = limit
    assert np.allclose(whole, parts, atol=0.05)


# --- quality ----------------------------------------------------------------------


def test_posteriors_recover_hidden_classes():
    rng = np.random.default_rng(5)
    good = rng.random(20_000) < 0.8
    n, right = 5, np.array([0.95, 0.9, 0.85, 0.9, 0.8])
    votes = np.where(rng.random((20_000, n)) < right, good[:, None], ~good[:, None]).astype(int)
    votes[(votes == quality.BAD) & good[:, None] & (rng.random((20_000, n)) < 0.9)] = quality.SILENT
    patterns, index, counts = np.unique(votes @ 3 ** np.arange(n), return_inverse=True, return_counts=True)
    posterior, accuracy = quality.posteriors(patterns, counts.astype(float), n)
    assert np.mean((posterior[index] > 0.5) == good) > 0.97
    assert (accuracy > 0.7).all()


def test_quality_query(spark, sf_dir):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    out = QUERIES["op1_quality_classifier"](spark, sf_dir).collect()
    assert len(out) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    kept = {r["doc_id"]: r["kept"] for r in out}
    assert np.mean([kept[d] for d, q in labels.items() if q == 1]) > 0.97
    assert np.mean([kept[d] for d, q in labels.items() if q == 0]) < 0.3


def test_quality_edge_rows(spark, sf_dir):
    model = quality.train(spark.read.parquet(f"{sf_dir}/documents.parquet").limit(150))
    rows = [(1, None), (2, ""), (3, " \n\t"), (None, "Some quiet words that end here."), (4, "word " * 100_000), (4, "word " * 100_000)]
    got = quality.classify(docs_frame(spark, rows), model).collect()
    assert [(r["quality"], r["kept"]) for r in got[:3]] == [(0.0, False)] * 3 and got[4]["quality"] == got[5]["quality"]
    assert quality.classify(docs_frame(spark, []), quality.train(docs_frame(spark, []))).collect() == []


# --- toxicity ---------------------------------------------------------------------


def bags_of(texts, toxic):
    table = pa.table({"toxic": pa.array(toxic, pa.int32()), "features": [[f for s in t for f in s] for t in texts], "sizes": [[len(s) for s in t] for t in texts]})
    return toxicity.Bags.of(table)


def test_a_text_is_sent_once_and_rows_come_back_in_slices(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "a text", "en")], "doc_id bigint, text string, lang string")
    model = quality.Model(np.zeros(1 << quality.BITS, np.float32), 1.0, np.zeros(quality.N_LABELLERS), {})
    sent = []
    monkeypatch.setattr(type(docs), "mapInArrow", lambda frame, run, schema: sent.append((frame.columns, run, schema)))
    quality.judge(docs, model)
    columns, run, schema = sent[0]
    assert columns == ["row"] and schema.fieldNames() == ["row", "quality", "kept"]
    n = 2500
    rows = pa.StructArray.from_arrays([pa.array(range(n)), pa.array([None if k % 7 == 0 else f"text {k}" for k in range(n)]), pa.nulls(n, pa.string())], ["doc_id", "text", "lang"])
    back = list(run(iter([pa.RecordBatch.from_arrays([rows], ["row"])])))
    assert max(b.num_rows for b in back) <= 1024 and sum(b.num_rows for b in back) == n
    table = pa.Table.from_batches(back)
    assert table.column("row").to_pylist() == rows.to_pylist()
    assert table.column("kept").to_pylist() == [k % 7 != 0 for k in range(n)]


def test_noisy_or_finds_the_sentence():
    rng = np.random.default_rng(3)
    toxic = (rng.random(600) < 0.2).astype(int)
    texts = []
    for y in toxic:
        sentences = [np.unique(rng.integers(100, 2000, 8)).tolist() for _ in range(rng.integers(2, 12))]
        if y and rng.random() < 0.9:
            sentences[rng.integers(len(sentences))].append(int(rng.integers(0, 5)))  # five offending words
        texts.append(sentences)
    model = toxicity.fit(bags_of(texts, toxic))
    logit = lambda s: model.weights[s].sum() + model.bias
    assert all(logit([w]) > 0 for w in range(5))
    clean = [s for t, y in zip(texts, toxic) if not y for s in t]
    assert np.mean([logit(s) > 0 for s in clean]) < 0.01 and 0 < model.leak < 0.1


def test_toxicity_query(spark, sf_dir):
    import zlib

    out = QUERIES["op8_toxicity"](spark, sf_dir).collect()
    assert len(out) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in out)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in out)


def test_toxicity_held_out(spark):
    """Large enough to learn from: the given table of the next size."""
    sf_dir = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").join(labels.select("doc_id"), "doc_id", "left_semi")
    model = toxicity.train(docs, labels, remainder("doc_id", 5) != 0)
    held = toxicity.score(docs, model).filter(remainder("doc_id", 5) == 0).join(labels, "doc_id").collect()
    hit = np.mean([r["predicted"] for r in held if r["toxic"] == 1])
    false = np.mean([r["predicted"] for r in held if r["toxic"] == 0])
    assert hit > 0.7 and false < 0.02


def test_toxicity_edge_rows(spark):
    weights = np.zeros(1 << toxicity.BITS, np.float32)
    _, _, mark, _ = hashing.words(np.frombuffer(b"    idiot", np.uint8))
    weights[int(mark[0, 0] >> np.uint64(64 - toxicity.BITS))] = 12.0
    model = toxicity.Model(weights, -8.0, 0.01)
    text = "All is well. You IDIOT### there! Fine."
    rows = [(1, None), (2, ""), (3, "..."), (None, text), (4, "well " * 200_000 + "idiot"), (5, text), (5, text)]
    got = toxicity.score(docs_frame(spark, rows), model).collect()
    assert [round(r["score"], 6) for r in got[:3]] == [0.01] * 3 and [r["predicted"] for r in got] == [0, 0, 0, 1, 1, 1, 1]
    spot = got[5]["offending"]
    assert [text[s["start"] : s["stop"]] for s in spot] == ["You IDIOT### there"]
    place = got[4]["offending"][0]
    assert ("well " * 200_000 + "idiot")[place["start"] : place["stop"]].endswith("idiot")
    assert toxicity.score(docs_frame(spark, []), model).collect() == []


def test_toxicity_labels_of_one_kind(spark):
    docs = docs_frame(spark, [(1, "a b c."), (2, "d e f."), (3, "g")])
    labels = spark.createDataFrame([(1, 0, 0), (2, 0, 0), (3, 0, None), (None, 0, 1)], "doc_id bigint, quality int, toxic int")
    model = toxicity.train(docs, labels, F.lit(True))
    assert {r["score"] for r in toxicity.score(docs, model).collect()} == {0.0}
    empty = toxicity.train(docs, labels.limit(0), F.lit(True))
    assert {r["score"] for r in toxicity.score(docs, empty).collect()} == {0.0}


def test_toxicity_small_table(spark, sf_dir):
    """Ten toxic rows are enough to learn words that only they hold."""
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    out = {r["doc_id"]: r["predicted"] for r in QUERIES["op8_toxicity"](spark, sf_dir).collect()}
    assert np.mean([out[d] for d, y in labels.items() if y == 1]) > 0.5
    assert np.mean([out[d] for d, y in labels.items() if y == 0]) < 0.05


def test_toxicity_many_rare_words(spark):
    """200 words, each in 20 of 4,000 toxic texts, copies counting once; few of them in a sample of 200 rows."""
    rng = np.random.default_rng(2)
    name = lambda k: "".join(chr(97 + int(d)) for d in f"{k * 7919 % 1000:03d}") + "q"
    plain = lambda: " ".join("xyzuvw"[int(a)] + "klmnop"[int(b)] + "rst"[int(c)] for a, b, c in rng.integers(0, (6, 6, 3), (8, 3)))
    rows = [(k, f"{plain()}. {plain()} {name(k % 200)}.") for k in range(4000)] + [(k, f"{plain()}. {plain()}.") for k in range(4000, 12000)]
    docs = docs_frame(spark, rows)
    labels = spark.createDataFrame([(k, int(k < 4000)) for k, _ in rows], "doc_id bigint, toxic int")
    for max_rows in (200, 6000):
        model = toxicity.train(docs, labels, F.lit(True), max_rows=max_rows)
        got = {r["doc_id"]: r["predicted"] for r in toxicity.score(docs, model).collect()}
        assert np.mean([got[k] for k in range(4000)]) > 0.95 and np.mean([got[k] for k in range(4000, 12000)]) < 0.02
