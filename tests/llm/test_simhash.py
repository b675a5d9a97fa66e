"""Fingerprints against the definition, links and groups against brute force."""

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F
from support import docs_frame, rows_of

from tidegate.llm import simhash
from tidegate.state.shared import shared_root


def slow_fingerprint(text, k=3):
    words, word = [], ""
    for c in (text or "").translate({c: c + 32 for c in range(65, 91)}):
        if c in " \t\n\x0b\x0c\r":
            words, word = words + [word] * bool(word), ""
        else:
            word += c
    words += [word] * bool(word)
    if not words:
        return 0
    grams = [" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


TEXTS = [
    None, "", " \t\n", "one", "One  TWO", "one two three", "one\x0btwo\x0cthree four", "É é ONE two",
    "a b c a b c a b c", "\xa0x\x85y z", "w " * 70_000, "The quick brown fox jumps over the lazy dog " * 40,
]


@pytest.mark.parametrize("text", TEXTS)
def test_fingerprint(text):
    assert simhash.fingerprint((text or "").encode()) == slow_fingerprint(text)


def slow_groups(fps, radius):
    left, out = set(range(len(fps))), {}
    while left:
        start = min(left)
        todo, seen = [start], {start}
        while todo:
            i = todo.pop()
            for j in list(left - seen):
                if bin(int(fps[i]) ^ int(fps[j])).count("1") <= radius:
                    seen.add(j)
                    todo.append(j)
        for i in seen:
            out[i] = start
        left -= seen
    return [out[i] for i in range(len(fps))]


def clustered(n, seed, flips=5):
    rng = np.random.default_rng(seed)
    centres = rng.integers(0, 1 << 63, size=max(1, n // 10), dtype=np.uint64) * np.uint64(2)
    fps = centres[rng.integers(0, len(centres), n)]
    for k in range(n):
        for b in rng.integers(0, 64, rng.integers(0, flips + 1)):
            fps[k] ^= np.uint64(1) << np.uint64(b)
    return np.unique(fps)


def labels(n, a, b):
    parent = list(range(n))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for x, y in zip(a.tolist(), b.tolist()):
        x, y = root(x), root(y)
        parent[max(x, y)] = min(x, y)
    return [root(x) for x in range(n)]


@pytest.mark.parametrize("radius", [0, 1, 2, 3, 4, 6])
@pytest.mark.parametrize("n", [2, 63, 64, 65, 300])
def test_near_links_one_group(n, radius):
    fps = clustered(n, n + radius)
    a, b = simhash.near_links(fps, np.zeros(len(fps), np.int64), radius)
    assert labels(len(fps), a, b) == slow_groups(fps, radius)
    assert len(a) == len(fps) - len(set(slow_groups(fps, radius)))


def test_near_links_keeps_groups_apart():
    fps = np.concatenate([clustered(40, 1), clustered(5, 2), clustered(90, 3), clustered(40, 1)])
    groups = np.repeat([4, 9, 2, 7], [len(clustered(40, 1)), len(clustered(5, 2)), len(clustered(90, 3)), len(clustered(40, 1))])
    a, b = simhash.near_links(fps, groups, 3)
    assert (groups[a] == groups[b]).all()
    expected, base = [], 0
    for g in (4, 9, 2, 7):
        part = fps[groups == g]
        expected += [base + x for x in slow_groups(part, 3)]
        base += len(part)
    assert labels(len(fps), a, b) == expected


@pytest.mark.parametrize("limit,batch,blocks", [(4096, 1 << 17, 5), (8, 64, 5), (16, 100, 6)])
def test_links_and_components(spark, limit, batch, blocks):
    fps = clustered(400, 11)
    signed = fps.view(np.int64).tolist()
    folder = shared_root(spark)
    frame = spark.createDataFrame([(x,) for x in signed], "fp bigint")
    edges = simhash.links(frame, folder, 3, blocks, limit, batch)
    found = {r["node"]: r["root"] for r in simhash.components(edges, folder).collect()}
    expected = slow_groups(fps, 3)
    smallest = {}
    for x, g in zip(signed, expected):
        smallest[g] = min(smallest.get(g, x), x)
    assert [found.get(x, x) for x in signed] == [smallest[g] for g in expected]


def test_long_chain_is_one_component(spark):
    edges = spark.range(200).select((F.col("id") + 1).alias("a"), F.col("id").alias("b"))
    out = simhash.components(edges, shared_root(spark)).collect()
    assert {r["root"] for r in out} == {0} and len(out) == 201


def test_near_duplicates_edge_rows(spark):
    docs = docs_frame(spark, [(5, "a b c d"), (3, "A  b c D"), (9, None), (2, ""), (None, "a b c d"), (3, "A  b c D"), (7, "x y z")])
    out = sorted(rows_of(simhash.near_duplicates(docs)), key=str)
    fp, other = (np.uint64(slow_fingerprint(t)).astype(np.int64).item() for t in ("a b c d", "x y z"))
    assert out == sorted([(5, fp, 3), (3, fp, 3), (3, fp, 3), (None, fp, 3), (9, 0, 2), (2, 0, 2), (7, other, 7)], key=str)


def test_empty_table(spark):
    assert rows_of(simhash.near_duplicates(docs_frame(spark, []))) == []


def test_query_against_brute_force(spark, sf_dir):
    from tidegate.llm.registry import QUERIES

    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    ids = sorted(docs)
    fps = np.array([slow_fingerprint(docs[i]) for i in ids], np.uint64)
    groups = slow_groups(fps, 3)
    expected = [(i, f"{int(f):016x}", ids[g]) for i, f, g in zip(ids, fps, groups)]
    got = QUERIES["op10_simhash_near_dedup"](spark, sf_dir).select("doc_id", "fingerprint", "component_id")
    assert sorted(rows_of(got)) == expected
