"""Every match against a full alignment of every pair."""

import random

import pytest
from support import docs_frame

from tidegate.llm import decontamination as dc


def slow(item, text):
    """Fewest edits of the whole item against any part of the text."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j - 1] + (a != b), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def edited(rng, text, edits, letters):
    out = list(text)
    for _ in range(edits):
        at = rng.randrange(len(out) + 1)
        kind = rng.randrange(3)
        if kind == 0 and at < len(out):
            del out[at]
        elif kind == 1 and at < len(out):
            out[at] = rng.choice(letters)
        else:
            out.insert(at, rng.choice(letters))
    return "".join(out)


@pytest.mark.parametrize("seed,letters", [(1, "abcdefgh"), (2, "ab"), (3, "aéñ漢😀xyz"), (4, "abc")])
def test_search_against_full_alignment(seed, letters):
    rng = random.Random(seed)
    word = lambda n: "".join(rng.choice(letters) for _ in range(n))
    items = [word(rng.randint(20, 90)) for _ in range(6)] + ["", "short"]
    texts = [None, "", word(10)]
    for item in items[:6]:
        for edits in (0, 1, 3, 5, 8, 12):
            texts.append(word(rng.randint(0, 60)) + edited(rng, item, edits, letters) + word(rng.randint(0, 60)))
        texts += [item[: len(item) // 2], item[2:], item[:-2], item + item]
    index = dc.index_of(tuple(items), 0.1)
    found = {(t, i): (edits, start, stop) for t, i, edits, start, stop in dc.search(texts, index)}
    for t, text in enumerate(texts):
        for i, item in enumerate(items):
            least = slow(item, text or "") if len(item) >= dc.MIN_CHARS else None
            if least is not None and least <= dc.budget(len(item), 0.1):
                edits, start, stop = found.pop((t, i))
                assert edits == least
                part = text[start:stop]
                assert slow(part, item) <= edits + abs(len(item) - len(part)) and slow(item, part) == edits
    assert not found


def test_normal_text_and_budget():
    assert dc.normal(" A\tb\n\nC ") == "a b c"
    for m in range(dc.MIN_CHARS, 500):
        k = dc.budget(m, 0.1)
        assert 0 <= k <= 0.1 * m and m - dc.Q + 1 - k * dc.Q >= dc.MIN_SHARED


def test_matches_and_remove(spark):
    item = "The quick brown fox jumps over the lazy dog, twice on every day."
    rows = [
        (1, f"before {item} after"), (2, None), (3, ""), (4, "nothing of the kind " * 50), (5, item.upper().replace(" ", " \n ")),
        (5, item.replace("lazy", "lazzy")), (None, item), (6, "x " * 60_000 + item), (7, item[:40]),
    ]
    docs = docs_frame(spark, rows)
    benchmark = spark.createDataFrame([(10, item), (11, None), (12, ""), (13, "another item that occurs in no text at all"), (10, item)], "item_id bigint, text string")
    for chars in (1 << 20, 1):
        found = dc.matches(docs, benchmark, block_chars=chars).collect()
        assert sorted((r["doc_id"], r["item_id"], r["edits"]) for r in found if r["doc_id"] is not None) == [
            (1, 10, 0), (1, 10, 0), (5, 10, 0), (5, 10, 0), (5, 10, 1), (5, 10, 1), (6, 10, 0), (6, 10, 0)]
        assert sum(r["doc_id"] is None for r in found) == 2
        kept = dc.remove(docs, benchmark, block_chars=chars)
        assert kept.columns == docs.columns
        assert sorted(r["doc_id"] for r in kept.collect()) == [2, 3, 4, 7]


def test_empty_tables(spark):
    benchmark = spark.createDataFrame([(1, "an item that is long enough to count")], "item_id bigint, text string")
    assert dc.matches(docs_frame(spark, []), benchmark).collect() == []
    docs = docs_frame(spark, [(1, "some text")])
    assert dc.matches(docs, benchmark.limit(0)).collect() == []
    assert dc.remove(docs, benchmark.limit(0)).count() == 1


def test_query_against_brute_force(spark, sf_dir):
    from tidegate.llm.registry import QUERIES

    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    got = {(r["doc_id"], r["item_id"]) for r in QUERIES["op9_benchmark_decontamination"](spark, sf_dir).collect()}
    exact = {(d["doc_id"], i["item_id"]) for d in docs for i in items if dc.normal(i["text"]) in dc.normal(d["text"])}
    assert exact <= got
    near = [p for p in got - exact]
    texts, wanted = {d["doc_id"]: d["text"] for d in docs}, {i["item_id"]: i["text"] for i in items}
    assert all(slow(dc.normal(wanted[i]), dc.normal(texts[d])) <= 0.1 * len(wanted[i]) for d, i in near)


def test_short_items_are_found_exactly():
    items = ["who is he?", "光合作用的产物是什么呢", "a short one of 23 chars", "nine char"]
    index = dc.index_of(tuple(items), 0.1)
    texts = [f"before {item} after" for item in items] + ["who is hee?", "光合作用的产物是水", "nine chair"]
    assert [(t, i) for t, i, edits, *_ in dc.search(texts, index) if edits == 0] == [(k, k) for k in range(4)]
    assert len(list(dc.search(texts, index))) == 4


def free(item, text):
    """Whether a short item stands free in a text: not within a longer word of a script that has blanks."""
    spaced = lambda c: c.isascii() and c.isalnum() or "À" <= c < " "
    for at in range(len(text) - len(item) + 1):
        if text.startswith(item, at):
            stop = at + len(item)
            begun = at > 0 and spaced(text[at - 1]) and spaced(text[at])
            goes_on = stop < len(text) and spaced(text[stop]) and spaced(text[stop - 1])
            if not begun and not goes_on:
                return at
    return None


@pytest.mark.parametrize("seed,letters", [(1, "ab "), (2, "aé漢 ."), (3, "漢字水"), (4, "a😀 \x01")])
def test_items_of_a_few_characters(seed, letters):
    rng = random.Random(seed)
    word = lambda n: dc.normal("".join(rng.choice(letters) for _ in range(n)))
    items = list({word(rng.randint(1, 8)) for _ in range(30)} - {""}) + [""]
    texts = [None, ""] + [word(rng.randint(1, 40)) for _ in range(60)]
    index = dc.index_of(tuple(items), 0.1)
    got = {(t, i): start for t, i, edits, start, stop in dc.search(texts, index) if edits == 0 and stop - start == len(items[i])}
    assert got == {(t, i): free(item, text or "") for t, text in enumerate(texts) for i, item in enumerate(items) if item and free(item, text or "") is not None}


def test_five_letters_and_text_ids(spark):
    docs = docs_frame(spark, [("a", "it is Paris, of course"), ("b", "parisian life"), ("c", "水の分子式はH2Oです")], "doc_id string, text string")
    benchmark = spark.createDataFrame([("q1", "paris"), ("q2", "H2O"), (None, "分子式"), ("q4", "?!")], "item_id string, text string")
    for chars in (1 << 20, 6, 1):  # one block, and several
        found = sorted(((r["doc_id"], r["item_id"]) for r in dc.matches(docs, benchmark, block_chars=chars).collect()), key=str)
        assert found == [("a", "q1"), ("c", "q2"), ("c", None)]  # scripts without blanks bound a word
        assert [r["doc_id"] for r in dc.remove(docs, benchmark, block_chars=chars).collect()] == ["b"]
    assert dc.matches(docs, benchmark, min_letters=6).collect() == []


def test_blocks_give_what_one_index_gives(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    size = sum(len(r["text"]) for r in benchmark.collect())
    whole, parts = (sorted(map(tuple, dc.matches(docs, benchmark, block_chars=n).collect())) for n in (1 << 20, size // 3 + 1))
    assert whole == parts and whole
