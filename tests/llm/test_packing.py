"""Window filling against exhaustive search, ids against the tokenizer, rows by an exact round trip."""

import random
import zlib
from collections import defaultdict
from itertools import product

import numpy as np
import pyarrow as pa
import pytest
from support import docs_frame
from tokenizers import Tokenizer

from tidegate.llm import packing
from tidegate.llm.registry import QUERIES, tokenizer_path


@pytest.mark.parametrize("seed", range(25))
def test_best_multiset(seed):
    rng = random.Random(seed)
    capacity = rng.randint(5, 60)
    counts = {rng.randint(1, capacity): rng.randint(1, 3) for _ in range(rng.randint(1, 5))}
    longest, lengths = max(counts), sorted(counts)
    sums = [
        sum(k * c for k, c in zip(lengths, take))
        for take in product(*[range(counts[k] + 1) for k in lengths])
        if take[-1] >= 1
    ]
    chosen = packing.best_multiset(dict(counts), capacity)
    assert chosen[longest] >= 1 and all(c <= counts[k] for k, c in chosen.items())
    assert sum(k * c for k, c in chosen.items()) == max(x for x in sums if x <= capacity)


TEXTS = [
    "", " ", "Hello, World! it's 3.14\n\tnew", "İstanbul ÉCOLE naïve ﬁ ǆ", "á b\xa0c d\x1fe\x85f", "<|endoftext|> x",
    "<|ENDOFTEXT|> X", "x<|startoftext|>y", "ther### thnd*** a,%%% b!! 漢字 かな 👍🏽 | x |", "don't we'll 'S 'tis o'clock", "words " * 5000,
    "\r\n\x0b\x0c mixed", "12 345 6a7 _under_score", "é́ ́", "ＦＵＬＬ ｗｉｄｔｈ",
]


def test_ids_are_the_tokenizers():
    path = tokenizer_path()
    plain = Tokenizer.from_file(path)
    for limit in (1 << 18, 8):
        words = packing.WordIds(path, limit)
        for text in TEXTS + TEXTS[::-1]:
            assert words.ids(text).tolist() == plain.encode(text, add_special_tokens=False).ids, repr(text)


@pytest.mark.parametrize("limit", [1 << 18, 8])
def test_ids_of_many_texts_together(monkeypatch, limit):
    path = tokenizer_path()
    plain, words, calls = Tokenizer.from_file(path), packing.WordIds(path, limit), []
    encode = words._encode
    monkeypatch.setattr(words, "_encode", lambda texts, plain=False: calls.append(texts) or encode(texts, plain))
    many = TEXTS + [f"text {chr(97 + k % 26)}{chr(97 + k // 26)}x has new words, same{chr(97 + k % 26)}!!" for k in range(200)] + TEXTS[::-1]
    for _ in range(2):
        assert [x.tolist() for x in words.ids_of(many)] == [plain.encode(x, add_special_tokens=False).ids for x in many]
    special = 2 * sum(any(token in x.lower() for token in words.special) for x in many)
    assert len(calls) - special < 20  # new words are learnt for all texts at once, not text by text
    assert words.ids_of([]) == []


def test_rows_are_taken_together_up_to_a_bound(monkeypatch):
    monkeypatch.setattr(packing, "TOGETHER", 10)
    batch = pa.RecordBatch.from_pydict({"doc_id": [1, None, 3, 4, 5], "text": ["abcdef", None, "ghij", "k" * 30, ""]})
    assert list(packing._together(batch)) == [([1, None, 3], ["abcdef", "", "ghij"]), ([4], ["k" * 30]), ([5], [""])]


def test_what_stands_before_stops_and_commas():
    """Whatever the tokenizer joins with a full stop or comma behind it."""
    path = tokenizer_path()
    plain, words = Tokenizer.from_file(path), packing.WordIds(path)
    texts = ["foo_. bar", "see __init__.py", "a_, b", "x\x1c. y\x1f, z", "İ. İ, \u0958. \ufb1d,", "_. ,_ ._", ". a", ",", "a.b,c 3.14 'tis. o',"]
    texts += [f"ab{chr(c)}. c {chr(c)},d" for c in range(0x3100)]
    for text in texts:
        assert words.ids(text).tolist() == plain.encode(text, add_special_tokens=False).ids, repr(text)


def test_ids_of_table(spark, sf_dir):
    path = tokenizer_path()
    plain, words = Tokenizer.from_file(path), packing.WordIds(path)
    for row in spark.read.parquet(f"{sf_dir}/documents.parquet").limit(150).collect():
        assert words.ids(row["text"]).tolist() == plain.encode(row["text"], add_special_tokens=False).ids


def check(rows, documents, capacity=packing.CAPACITY):
    """Every id in one piece, windows gapless, no padding but below a whole window at most."""
    plain = Tokenizer.from_file(tokenizer_path())
    by_doc, windows = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        windows[r["sequence_id"]].append(r)
    expected = defaultdict(list)
    for doc, text in documents:
        expected[doc].append(plain.encode(text or "", add_special_tokens=False).ids + [1])
    assert set(by_doc) == set(expected)
    for doc, pieces in by_doc.items():
        if len(expected[doc]) == 1:
            ids, at = expected[doc][0], 0
            for r in sorted(pieces, key=lambda r: r["start"]):
                part = np.array(ids[at : at + r["length"]], "<u4").tobytes()
                assert (r["start"], r["doc_tokens"], r["ids_crc32"]) == (at, len(ids), zlib.crc32(part))
                at += r["length"]
            assert at == len(ids)
        else:
            assert sum(r["length"] for r in pieces) == sum(map(len, expected[doc]))
    padding = 0
    for pieces in windows.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at and r["length"] > 0
            at += r["length"]
        assert at <= capacity
        padding += 0 if at & (at - 1) == 0 else capacity - at
    return padding


def test_query_round_trip(spark, sf_dir):
    documents = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert check(QUERIES["op3_packing"](spark, sf_dir).collect(), documents) == 0


@pytest.mark.parametrize("pool", [4, 16384])
def test_edge_rows(spark, pool):
    rows = [(1, None), (2, ""), (None, "a null id"), (4, "one two " * 3000), (5, "same"), (5, "same"), (6, "w " * 2047), (7, "ﬁ\n" * 30)]
    rows += [(k, "seven tokens each for the pool ok") for k in range(100, 140)]
    frame = docs_frame(spark, rows).repartition(3)
    assert check(packing.pack(frame, tokenizer_path(), pool=pool).collect(), rows) == 0


def test_empty_table(spark):
    assert packing.pack(docs_frame(spark, []), tokenizer_path()).collect() == []
