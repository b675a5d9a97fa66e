"""The learned operators against plain loops: every row of their registered queries, from the fitted model's numbers."""

import math
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from support import docs_frame

from tidegate.llm import langid, quality, toxicity
from tidegate.llm.registry import QUERIES, remainder

MASK = (1 << 64) - 1
MIX = 0x9E3779B97F4A7C15


def texts_of(spark, sf_dir):
    return [(r["doc_id"], r["text"] or "") for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]


def is_letter(byte):
    return byte >= 128 or chr(byte).isascii() and chr(byte).isalpha()


def words_of(data):
    """(start, stop) of runs of letter bytes."""
    out, start = [], None
    for k, byte in enumerate(data + b" "):
        if is_letter(byte) and start is None:
            start = k
        elif not is_letter(byte) and start is not None:
            out.append((start, k))
            start = None
    return out


def lower(data):
    return bytes(b + 32 if 65 <= b <= 90 else b for b in data)


def gram_buckets(symbols, blank, sizes, width, bits):
    """Buckets of n-grams that begin at the blank before a text or at one of its symbols."""
    padded = [blank, *symbols, *[blank] * 8]
    for size in sizes:
        for at in range(len(symbols) + 1):
            code = size
            for k in range(size):
                code = (code << width | padded[at + k]) & MASK
            yield (code * MIX & MASK) >> (64 - bits)


# --- quality ----------------------------------------------------------------------


def slow_votes(text):
    for c in quality.WHITE:
        text = text.replace(c, " ")
    words = [w for w in text.split(" ") if w]
    n, different, echoes = len(words), len(set(words)), sum(a == b for a, b in zip(words, words[1:]))
    chars = len(text)
    marks, pipes, upper, shouts, stops = (sum(c in group for c in text) for group in (quality.MARKS, "|", quality.UPPER, "!", ".,;:?"))
    bad, good, silent = quality.BAD, quality.GOOD, quality.SILENT

    def vote(is_bad, is_good):
        return bad if is_bad else good if is_good else silent

    return (
        vote(n >= 8 and different < 0.45 * n**0.9, n >= 8 and different > 0.7 * n**0.9),
        vote(n >= 8 and 5 * echoes > n, n >= 8 and 50 * echoes <= n),
        vote(10 * marks > 2 * n, n >= 5 and marks == 0),
        vote(100 * marks > 3 * chars, n >= 20 and 1000 * marks < chars),
        vote(10 * pipes > 2 * n, False),
        vote(chars >= 20 and 100 * upper > 35 * chars, chars >= 40 and 100 * upper < 8 * chars),
        vote(10 * shouts > 2 * n, False),
        vote(n >= 20 and 200 * stops < n, n >= 5 and 100 * stops >= 4 * n and 2 * stops <= n),
    )


def slow_em(votes, rounds=200):
    """P(good) of every document's votes, by loops over documents."""
    n = len(votes[0])
    good = [0.02 if quality.BAD in v else 0.98 for v in votes]
    for _ in range(rounds):
        share = [(sum(1 - g for g in good) + 1) / (len(votes) + 2), (sum(good) + 1) / (len(votes) + 2)]
        table = [[[2.0, 1.0], [1.0, 2.0]] for _ in range(n)]
        for v, g in zip(votes, good):
            for k in range(n):
                if v[k] != quality.SILENT:
                    table[k][0][v[k]] += 1 - g
                    table[k][1][v[k]] += g
        new = []
        for v in votes:
            logs = [math.log(share[c]) for c in (0, 1)]
            for k in range(n):
                if v[k] != quality.SILENT:
                    for c in (0, 1):
                        logs[c] += math.log(table[k][c][v[k]] / sum(table[k][c]))
            new.append(1 / (1 + math.exp(logs[0] - logs[1])))
        change = max(abs(a - b) for a, b in zip(good, new))
        good = new
        if change < 1e-9:
            break
    return good


def test_posteriors_by_loops(spark, sf_dir):
    votes = [slow_votes(text) for _, text in texts_of(spark, sf_dir)]
    model = quality.train(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    patterns = [sum(v * 3**k for k, v in enumerate(row)) for row in votes]
    assert set(model.good) == set(patterns)
    for pattern, good in zip(patterns, slow_em(votes)):
        assert model.good[pattern] == pytest.approx(good, abs=1e-6)


def slow_quality(text, model):
    if not text.strip():
        return 0.0
    data = text.encode()
    grams = list(gram_buckets([int(quality.KINDS[b]) for b in data], int(quality.KINDS[32]), (3, 5), 4, quality.BITS))
    logit = model.bias + quality.GRAM_WEIGHT * sum(float(model.weights[g]) for g in grams) / len(grams)
    words = [lower(data[a:b]) for a, b in words_of(data)]
    same = sum(a == b for a, b in zip(words, words[1:]))
    near = sum(w in words[max(0, k - quality.WINDOW) : k] for k, w in enumerate(words))
    letters, upper = sum(map(is_letter, data)), sum(65 <= b <= 90 for b in data)
    shares = [same / max(1, len(words)), near / max(1, len(words)), upper / max(1, letters)]
    steps = [sum(bool(s < x) for s in quality.STEPS) for x in shares] + [min(int(math.log2(len(words) + 1)), 15)]
    for k, step in enumerate(steps):
        logit += float(model.weights[(((k + 1) * 64 + step) * MIX & MASK) >> (64 - quality.BITS)])
    return 1 / (1 + math.exp(-max(-40, min(40, logit))))


def test_quality_scores_by_loops(spark, sf_dir):
    model = quality.train(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    texts = dict(texts_of(spark, sf_dir))
    for r in QUERIES["op1_quality_classifier"](spark, sf_dir).collect():
        score = slow_quality(texts[r["doc_id"]], model)
        assert r["quality"] == pytest.approx(score, abs=1e-5) and (r["kept"] == (score >= 0.5) or abs(score - 0.5) < 1e-4)


# --- language ---------------------------------------------------------------------


def test_language_scores_by_loops(spark, sf_dir):
    model = langid.train(spark.read.parquet(f"{sf_dir}/documents.parquet"), remainder("doc_id", 4) != 2)
    texts = dict(texts_of(spark, sf_dir))
    for r in QUERIES["op2_language_id"](spark, sf_dir).collect():
        data = texts[r["doc_id"]].lower().encode()
        if not any(c.isalpha() for c in texts[r["doc_id"]]):
            assert (r["lang_pred"], r["score"], r["rejected"]) == ("und", 0.0, True)
            continue
        grams = Counter(gram_buckets([b if is_letter(b) else 32 for b in data], 32, langid.SIZES, 8, langid.BITS))
        total = sum(n * model.weights[g].astype(float) for g, n in grams.items()) / sum(grams.values()) + model.bias
        odds = np.exp((total - total.max()) / model.temperature)
        best = int(odds.argmax())
        assert r["lang_pred"] == model.languages[best] and r["score"] == pytest.approx(odds[best] / odds.sum(), abs=1e-4)


def test_many_languages_are_learned(spark):
    """400 of them, more than a tenth of the sample's rows; each has an alphabet of its own."""
    rng = np.random.default_rng(1)
    alphabet = [chr(c) for c in range(0x4E00, 0x4E00 + 400 * 6)]
    rows = []
    for k in range(400):
        own = alphabet[6 * k : 6 * k + 6]
        rows += [(len(rows) + i, " ".join("".join(rng.choice(own, 4)) for _ in range(12)), f"l{k:03d}") for i in range(14)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(4)
    model = langid.train(docs, F.col("doc_id") % 7 != 0)
    assert len(model.languages) == 400
    held = langid.predict(docs.filter("doc_id % 7 = 0"), model).select("lang", "lang_pred").collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in held]) > 0.9


# --- toxicity ---------------------------------------------------------------------


def slow_sentences(text):
    """Sets of feature buckets, sentence by sentence."""
    data, out, last = text.encode(), [], None
    for a, b in words_of(data):
        if last is None or any(c in b".!?\n\r" for c in data[last:a]) or len(out[-1]) == toxicity.SENTENCE_WORDS:
            out.append([])
        out[-1].append(lower(data[a:b]))
        last = b
    found = []
    for words in out:
        buckets = set()
        for word in words:
            for column, size in enumerate([len(word), *[k for k in toxicity.PREFIXES if k < len(word)]]):
                place = 0 if column == 0 else 1 + toxicity.PREFIXES.index(size)
                mark = sum((c + 1) * pow(0xD1342543DE82EF95, i, 1 << 64) for i, c in enumerate(word[:size])) + place & MASK
                mark = (mark ^ mark >> 29) * MIX & MASK
                buckets.add((mark ^ mark >> 32) >> (64 - toxicity.BITS))
        found.append(buckets)
    return found


def slow_noisy_or(text, model):
    clean = 1 - model.leak
    for buckets in slow_sentences(text):
        clean *= 1 - 1 / (1 + math.exp(-max(-40, min(40, sum(float(model.weights[b]) for b in buckets) + model.bias))))
    return 1 - clean


def test_toxicity_scores_by_loops(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.train(docs, labels, remainder("doc_id", 5) != 0)
    texts = dict(texts_of(spark, sf_dir))
    for r in QUERIES["op8_toxicity"](spark, sf_dir).collect():
        assert r["score"] == pytest.approx(slow_noisy_or(texts[r["doc_id"]], model), abs=1e-5)


def test_witnesses_by_loops(spark, sf_dir):
    """Copies of sentences count once for their label, a text once for a feature."""
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    agreed = labels.filter("toxic IS NOT NULL").select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    told = docs.select("doc_id", "text").withColumn("own", F.xxhash64("doc_id", "text")).join(agreed, "doc_id").filter("text <> ''")
    counts, totals = toxicity.witnesses(toxicity.bearing(told))
    holder, texts = {}, {}
    for r in told.collect():
        texts[r["own"]] = (r["toxic"], [frozenset(s) for s in slow_sentences(r["text"])])
    for own in sorted(texts):
        for sentence in texts[own][1]:
            holder.setdefault((texts[own][0], sentence), own)
    wanted = defaultdict(set)
    for (toxic, sentence), own in holder.items():
        for feature in sentence:
            wanted[toxic, feature].add(own)
    got = {(y, int(f)): int(counts[y, f]) for y in (0, 1) for f in np.flatnonzero(counts[y])}
    assert got == {key: len(owns) for key, owns in wanted.items()}
    assert totals.tolist() == [len({own for (y, _), own in holder.items() if y == label}) for label in (0, 1)]


def test_one_id_on_a_third_of_the_rows(spark):
    """Different texts under one id are different texts; copies of one are one."""
    rng = np.random.default_rng(7)
    plain = lambda: " ".join("xyzuvw"[int(a)] + "klmnop"[int(b)] + "rst"[int(c)] for a, b, c in rng.integers(0, (6, 6, 3), (8, 3)))
    rows = [(k, f"{plain()}. {plain()} villain.") for k in range(300)] + [(k, f"{plain()}. {plain()}.") for k in range(300, 900)]
    hot = [(300, f"{'. '.join(plain() for _ in range(40))}.") for _ in range(600)] + [(301, rows[301][1])] * 600
    labels = spark.createDataFrame([(k, int(k < 300)) for k in range(900)], "doc_id bigint, toxic int")
    docs = docs_frame(spark, rows + hot).repartition(6)
    model = toxicity.train(docs, labels, F.lit(True))
    got = {(r["doc_id"], r["predicted"]) for r in toxicity.score(docs, model).collect()}
    assert got == {(k, int(k < 300)) for k in range(900)}


# --- all --------------------------------------------------------------------------


def test_models_do_not_depend_on_the_split(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    parts = [docs.repartition(n).sortWithinPartitions("text", ascending=n < 5) for n in (3, 7)]
    one, two = (langid.train(d, F.lit(True), max_rows=60) for d in parts)
    assert one.languages == two.languages and np.array_equal(one.weights, two.weights) and one.threshold == two.threshold
    one, two = (quality.train(d, max_rows=60) for d in parts)
    assert one.good == two.good and np.array_equal(one.weights, two.weights)
    one, two = (toxicity.train(d, labels, F.lit(True), max_rows=40) for d in parts)
    assert np.array_equal(one.weights, two.weights) and one.bias == two.bias
