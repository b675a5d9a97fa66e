"""Spans, phrase collocations, importance resampling and line dedup against brute force on edge rows."""

import hashlib
import math
import random
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute
import pytest
import xxhash
from support import docs_frame, rows_of

from tidegate.llm import collocations, importance, line_dedup, spans

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# --- spans ------------------------------------------------------------------------


@pytest.mark.parametrize("seed", [0, 42, 1 << 63])
def test_hashes_are_xxh64(seed):
    rng = random.Random(seed)
    data = np.frombuffer(rng.randbytes(4000) + b"\n" * 40, np.uint8)
    start = np.array([rng.randrange(3000) for _ in range(2000)])
    stop = start + np.array([rng.choice([0, 1, 3, 4, 7, 8, 9, 15, 31, 32, 33, 63, 64, 100, 256, 257, 700]) for _ in range(2000)])
    expected = [xxhash.xxh64_intdigest(data[a:b].tobytes(), seed) for a, b in zip(start, stop)]
    assert spans.xxh64(data, start, stop, seed).tolist() == expected


def test_table_tells_bytes_apart(monkeypatch):
    rng = random.Random(1)
    data = np.frombuffer(bytes(rng.choice(b"ab") for _ in range(3000)) + b"\n" * 40, np.uint8)
    start = np.array([rng.randrange(2600) for _ in range(5000)])
    stop = start + np.array([rng.choice([0, 1, 2, 5, 8, 9, 16, 17, 300]) for _ in range(5000)])
    for collide in (False, True):
        if collide:  # all keys equal: only the bytes decide
            monkeypatch.setattr(spans, "xxh64", lambda d, a, b, seed=0: np.zeros(len(a), np.uint64))
            start, stop = start[:300], stop[:300]
        table = spans.Table(data, start, stop)
        texts = [data[a:b].tobytes() for a, b in zip(start, stop)]
        slots = defaultdict(set)
        for slot, text in zip(table.slot.tolist(), texts):
            slots[text].add(slot)
        assert all(len(found) == 1 for found in slots.values())
        assert len(slots) == len(table.first) == len({min(found) for found in slots.values()})
        assert {texts[first]: n for first, n in zip(table.first, table.count)} == Counter(texts)


@pytest.mark.parametrize("carry", [0, 3])
def test_cut_texts_give_the_same_words(carry):
    rng = random.Random(2)
    texts = [" ".join(rng.choice(["A", "bc", "é,", "DEF.", "x" * 70]) for _ in range(60)).encode() for _ in range(20)]
    texts += [None, b"", b" ", b"q" * 500, b"q" * 500 + b" r"]
    got = defaultdict(list)
    for words in spans.word_blocks(texts, importance.WORD, carry, limit=40):
        for a, b, doc, new in zip(words.start, words.stop, words.doc, words.new):
            if new:
                got[doc].append(words.data[a:b].tobytes())
    for k, text in enumerate(texts):
        assert got.get(k, []) == re.findall(rb"[0-9a-z\x80-\xff]+", (text or b"").lower())


# --- phrase collocations ----------------------------------------------------------


def slow_collocations(rows, support, max_words, top, cover):
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        n[lang] += 0
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for size in range(1, max_words + 1):
                for i in range(len(words) - size + 1):
                    f[lang][tuple(words[i : i + size])] += 1
    out = []
    for lang, counts in f.items():
        candidates = {p: a for p, a in counts.items() if a >= support and len(p) > 1}
        ranked = []
        for p, a in candidates.items():
            longer = (b for q, b in candidates.items() if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q))))
            if any(100 * b >= cover * a for b in longer):
                continue
            score, _, left, right = min((2000000 * a // (counts[p[:k]] + counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p)))
            ranked.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(ranked)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def phrase_rows():
    rng = random.Random(3)
    vocabulary = ["A", "b", "C\t", "de", "(x)", "é", "\x00", "f.", "g,", "_"]
    rows = [(" ".join(rng.choice(vocabulary) for _ in range(rng.randrange(30))), rng.choice(["en", "fr", None])) for _ in range(120)]
    rows += [(None, "en"), ("", None), (" \t\n..", "xx"), ("one two three four " * 4000, "long"), ("solo solo", "solo")]
    return rows + [("copied text here, copied text", "en")] * 60


@pytest.mark.parametrize("support,max_words,shards,top,bits", [(3, 4, 1, 2000, 27), (12, 4, 4, 7, 16), (30, 3, 5, 5, 27), (4, 2, 2, 2000, 27)])
def test_collocations(spark, monkeypatch, support, max_words, shards, top, bits):
    monkeypatch.setattr(collocations.frequent_phrases, "__defaults__", (30, 4, 4, bits, "lang", "text"))
    rows = phrase_rows()
    docs = docs_frame(spark, [(k, *row) for k, row in enumerate(rows)], "doc_id bigint, text string, lang string").repartition(5)
    got = collocations.top_collocations(docs, support, max_words, top, 80, shards)
    assert sorted(rows_of(got)) == slow_collocations(rows, support, max_words, top, 80)


def test_blocks_are_made_one_at_a_time_and_summed_together(spark, monkeypatch):
    """No block is made before the one ahead of it was used; a phrase of several blocks comes once for all of them."""
    made = []
    real = spans.Words
    monkeypatch.setattr(spans, "Words", lambda *given: made.append(1) or real(*given))
    monkeypatch.setattr(collocations, "_BLOCK", 200)
    text = "one two three four five " * 5
    batch = pa.RecordBatch.from_pydict({"text": [text] * 10 + [None, "", " "]})
    sizes = []
    for blocks in collocations._blocks(batch, 3):
        before = len(made)
        for k, words in enumerate(blocks):
            assert len(made) <= before + k
        sizes.append(k + 1)
    assert max(sizes) == collocations._BLOCKS and sum(sizes) == 5  # two texts in each
    found, sums = collocations._summed([np.array([3, 9], np.uint64), np.array([1, 9], np.uint64)], [np.array([2, 5]), np.array([1, 7])])
    assert (found.tolist(), sums.tolist()) == ([1, 3, 9], [1, 2, 12])


def test_a_block_takes_little_memory():
    rng = random.Random(4)
    text = " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 9))) for _ in range(1500))
    batch = pa.RecordBatch.from_pydict({"text": [text] * 900})
    tracemalloc.start()
    try:
        for blocks in collocations._blocks(batch, 3):
            for words in blocks:
                phrases = collocations.Phrases(words, np.zeros(900, np.int64))
                for _ in range(3):
                    phrases.grow()
        assert tracemalloc.get_traced_memory()[1] < 60e6
    finally:
        tracemalloc.stop()


@pytest.mark.parametrize("given", [None, "7m"])
def test_texts_come_in_batches_of_few_bytes(spark, monkeypatch, tmp_path, given):
    """However many rows: with 6,000 bytes a text, at most 700 in four blocks of a megabyte. The caller's setting stays."""
    setting = "spark.sql.execution.arrow.maxBytesPerBatch"

    def all_words(phrases, shard):
        if phrases.words.doc.max() >= 800:
            raise ValueError(f"text {phrases.words.doc.max()} of a batch")
        yield 1, np.flatnonzero(phrases.counted(1))

    monkeypatch.setattr(collocations, "_all_words", all_words)
    docs = spark.range(0, 3000, 1, 1).selectExpr("repeat('ab cd ', 1000) AS text", "'en' AS lang")
    if given:
        spark.conf.set(setting, given)
    try:
        frequent, totals = collocations.frequent_phrases(docs, str(tmp_path / "phrases"), max_words=2)
        assert spark.conf.get(setting, None) == given
    finally:
        spark.conf.unset(setting)
    assert sorted(rows_of(frequent)) == [("en", 1, "ab", 3_000_000), ("en", 1, "cd", 3_000_000), ("en", 2, "ab cd", 3_000_000), ("en", 2, "cd ab", 2_997_000)]
    assert rows_of(totals) == [("en", 6_000_000)]


class Tasks:
    """Stands for a table: keeps what its tasks would do."""

    def mapInArrow(self, work, schema):
        self.work = work
        return self

    def groupBy(self, *keys):
        return self

    def applyInArrow(self, work, schema):
        self.last = work
        return self


def test_mined_counts_leave_a_task_as_arrays():
    """A row for each range, support and shard of a batch, not one for each pair; a range's sums decide."""
    rng = random.Random(5)
    texts = [" ".join(rng.choice("abcdefghijk") for _ in range(300)) for _ in range(60)]
    shards, least = [k % 2 for k in range(60)], [30 + k % 3 for k in range(60)]
    columns = {"text": texts, "salt": least, "shard": pa.array(shards, pa.int32()), "least": least}
    batch = pa.RecordBatch.from_pydict(columns)

    def pairs(phrases, shard):
        phrases.grow()
        yield 2, np.flatnonzero(phrases.counted(2))

    tasks = collocations._mine(Tasks(), 1, pairs, 7)
    given = list(tasks.work(iter([batch.slice(0, 25), batch.slice(25)])))
    assert sum(rows.num_rows for rows in given) <= 2 * 7 * 6  # batches, ranges, (support, shard)
    found = Counter()
    for part in range(7):
        rows = pa.Table.from_batches(given)
        rows = tasks.last(rows.filter(pa.compute.equal(rows["part"], part)))
        found.update(rows["shard"].to_pylist())
        assert {g % (1 << 64) * 7 >> 64 for g in rows["g"].to_pylist()} <= {part}
    slow = Counter()
    for text, shard, support in zip(texts, shards, least):
        slow.update((shard, support, text[i : i + 3]) for i in range(0, len(text) - 2, 2))
    assert found == Counter(shard for (shard, support, _), n in slow.items() if n >= support)
    assert 0 < found.total() < len(slow)


def test_runs_are_counted_where_their_parts_are_candidates():
    class Bitmap:
        """Holds all but the word x, as a bitmap too small for its phrases does."""

        absent = spans.mixed(spans.xxh64(np.frombuffer(b"x" + b"\n" * 40, np.uint8), np.array([0]), np.array([1])))

        @property
        def value(self):
            return self

        def holds(self, codes):
            return codes != self.absent

    batch = pa.RecordBatch.from_pydict({"text": ["a b c x a b.c"], "salt": [0], "lang": ["en"]})
    found = [r for rows in collocations._count_exactly(Tasks(), Bitmap(), 4).work(iter([batch])) for r in rows.to_pylist()]
    assert {r["phrase"]: r["n"] for r in found} == {"a": 2, "b": 2, "c": 2, "a b": 2, "b c": 1, "a b c": 1}


def test_scores_pass_64_bits(spark):
    a, rest = 9_000_000_000_000_000, 9_100_000_000_000_000
    frequent = spark.createDataFrame([("x", 2, "p q", a), ("x", 1, "p", rest), ("x", 1, "q", rest + 1)], "lang string, size int, phrase string, f long")
    assert rows_of(collocations.scored(frequent, 80)) == [("x", "p q", a, rest, rest + 1, 2000000 * a // (2 * rest + 1))]


def test_no_phrases(spark):
    for rows in ([], [(1, None, None)], [(1, "a b", "en")]):
        docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
        assert rows_of(collocations.top_collocations(docs)) == []


# --- importance resampling --------------------------------------------------------


def slow_features(text, lo, hi):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    return len(words), [" ".join(words[i : i + n]) for n in range(lo, hi + 1) for i in range(len(words) - n + 1)]


def slow_resample(docs, target, percent, min_words, f):
    def counts(texts):
        return Counter(zlib.crc32(x.encode()) % f.buckets for t in texts for x in slow_features(t, f.n_min, f.n_max)[1])

    s, t = counts(text for _, text in docs), counts(target)
    all_s, all_t = sum(s.values()) + f.buckets, sum(t.values()) + f.buckets
    gain = [math.floor(1000 * math.log((t[b] + 1) * all_s / ((s[b] + 1) * all_t))) for b in range(f.buckets)]
    rows = []
    for doc_id, text in docs:
        n_words, features = slow_features(text, f.n_min, f.n_max)
        weight = sum(gain[zlib.crc32(x.encode()) % f.buckets] for x in features)
        h = int(hashlib.sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        rows.append([doc_id, n_words, len(features), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    fit = sorted((r for r in rows if r[1] >= min_words), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[2]))
    for rank, row in enumerate(fit[: len(fit) * percent // 100], 1):
        row[5] = rank
    return Counter(map(tuple, rows))


@pytest.mark.parametrize("features", [importance.Features(), importance.Features(1, 3, 50), importance.Features(2, 2, 7)])
def test_resampling(spark, monkeypatch, features):
    monkeypatch.setattr(importance, "word_blocks", lambda texts, inside, carry: spans.word_blocks(texts, inside, carry, 60))
    rng = random.Random(4)
    vocabulary = ["The", "of", "É2", "naïve", "x-y", "日本", "zz9", "\x00", "q" * 300]
    docs = [(k, " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(40)))) for k in range(150)]
    docs += [(200, None), (201, ""), (202, "--"), (None, "The of the of zz9"), (None, None), (7, "same same same same"), (7, "same same same same")]
    docs += [(300, "hot text of copies")] * 80
    target = ["the of zz9", None, "日本 日本 naïve", "of of"]
    frame = docs_frame(spark, docs).repartition(4)
    wanted = spark.createDataFrame([(k, t) for k, t in enumerate(target)], "item_id bigint, text string")
    got = importance.resample(frame, wanted, 30, 4, features=features)
    assert got.columns == ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    assert Counter(rows_of(got)) == slow_resample(docs, target, 30, 4, features)


def test_resampling_of_little(spark):
    empty, one = (spark.createDataFrame(rows, "doc_id bigint, text string") for rows in ([], [(1, "a b")]))
    assert rows_of(importance.resample(empty, one)) == []
    assert Counter(rows_of(importance.resample(one, empty, 100, 1))) == slow_resample([(1, "a b")], [], 100, 1, importance.Features())


def test_text_ids_and_odd_types(spark):
    docs = spark.createDataFrame([("b", "x y z"), ("a", "x y z"), (None, "x")], "doc_id string, text string")
    got = importance.resample(docs, docs, 100, 1)
    ranks = {r["doc_id"]: r["rank"] for r in got.collect()}
    assert sorted(ranks.values()) == [1, 2, 3] and got.schema["doc_id"].dataType.simpleString() == "string"


# --- line dedup -------------------------------------------------------------------


def slow_lines(rows, min_chars, min_docs):
    def key(line):
        return line.strip(" \t\n\x0b\x0c\r").translate(LOWER)

    order = lambda d: (d is not None, d if d is not None else 0)
    holders = defaultdict(set)
    for doc_id, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders[key(line)].add(doc_id)
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(holders[key(x)]) < min_docs or doc_id == max(holders[key(x)], key=order)]
        out.append((doc_id, text, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return Counter(out)


def line_rows():
    rng = random.Random(5)
    pool = ["shared LINE of text %d" % k for k in range(12)] + ["\tShared line of TEXT 3 \r", "É capital stays É", "é capital stays é", "short", "", "   "]
    rows = [(k, "\n".join(rng.choice([*pool, f"own {k} {rng.random()}"]) for _ in range(rng.randrange(9)))) for k in range(70)]
    rows += [(100, None), (101, ""), (102, "\n\n"), (None, "shared line of text 1\nx"), (None, "only null ids here"), (None, "only null ids here")]
    rows += [(33, "shared line of text 5\nsecond text of id 33"), (33, "shared line of text 5\nsecond text of id 33")]
    return rows + [(500, "hot line of very many\nshared line of text 2")] * 50 + [(k, "hot line of very many") for k in range(600, 680)]


@pytest.mark.parametrize("min_docs,batches,sample", [(2, 6, 1024), (5, 1, 1024), (3, 9, 16), (5, 4, 1024)])
def test_lines(spark, min_docs, batches, sample):
    rows = line_rows()
    kept = line_dedup.dedup_lines(docs_frame(spark, rows).repartition(3), min_chars=8, min_docs=min_docs, batches=batches, sample=sample)
    got = kept.select("row.doc_id", "row.text", "n_lines", "n_dropped", "kept_text")
    assert Counter(rows_of(got)) == slow_lines(rows, 8, min_docs)
    assert {tuple(r) for r in kept.select("row.host", "row.key", "row.score").collect()} == {("x", "x", "x")}


def test_line_runs_are_merged_and_removed(spark, tmp_path):
    runs = line_dedup.LineRuns(spark, str(tmp_path))
    for k in range(5):
        docs = spark.range(20 - 4 * k, 24 - 4 * k).selectExpr("id AS doc", "0L AS mark", f"concat('line {k}', '\nshared by all') AS text")
        repeats = rows_of(runs.add(line_dedup.line_table(docs, 1)).select("doc", "place"))
        # of a batch's own line all but the largest id repeat it; the shared line has its holder in batch 0
        own, shared = [d for d, p in repeats if p == 0], [d for d, p in repeats if p == 1]
        assert len(own) == 3 and len(shared) == (3 if k == 0 else 4)
    assert [level is not None for level in runs.levels] == [True, False, True]
    hashes = [tuple(r) for level in runs.levels if level for r in spark.table(level).select("h1", "h2").collect()]
    assert len(hashes) == len(set(hashes)) == 6
    runs.drop()
    assert runs.database not in [d.name for d in spark.catalog.listDatabases()]


def test_lines_of_nothing_and_text_ids(spark):
    assert rows_of(line_dedup.dedup_lines(spark.createDataFrame([], "doc_id bigint, text string"))) == []
    docs = spark.createDataFrame([(x, "a line\nb") for x in "abc"], "doc_id string, text string")
    got = line_dedup.dedup_lines(docs, min_chars=2, min_docs=3).select("row.doc_id", "kept_text")
    assert sorted(rows_of(got)) == [("a", "b"), ("b", "b"), ("c", "a line\nb")]


def test_line_dedup_plans_have_no_python(spark):
    kept = line_dedup.dedup_lines(spark.createDataFrame([(1, "x")], "doc_id bigint, text string"))
    assert not re.search(r"Python|Arrow|Pandas", kept._jdf.queryExecution().toString())
