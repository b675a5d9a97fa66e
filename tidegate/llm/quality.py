"""Quality classification from weak labels.

Heuristic labellers vote good, bad or nothing on every document. How often each pattern of votes
occurs is counted over all documents; expectation-maximisation on those counts estimates, without
any gold label, how accurate each labeller is and how likely a document with a given pattern is
good (Dawid and Skene, 1979). These posteriors then train a logistic scorer on hashed features,
which also judges documents on which the labellers disagree or are silent.

The patterns are at most 3^labellers rows. The scorer is fitted on about ``max_rows`` different
documents, those of lowest hash of id and text (a documented bound); half of them from patterns
more likely bad, so that rare junk is seen.

Defined cases: a null or blank text is bad (score 0, not kept); an empty table gives no rows;
repeated rows are judged alike; a null id is an id; other columns are carried, not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.llm import hashing
from tidegate.state.shared import shared_root, stage

WHITE = "\t\n\x0b\x0c\r"
MARKS = "#*$%&|<>"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZÀÁÂÃÄÅÆÇÈÉÊËÌÍÎÏÐÑÒÓÔÕÖØÙÚÛÜÝÞ"
BITS = 13
GOOD, BAD, SILENT = 1, 0, 2


# --- labellers --------------------------------------------------------------------


def _without(text: Column, characters: str) -> Column:
    return F.length(text) - F.length(F.translate(text, characters, ""))


def figures(text: Column) -> dict[str, Column]:
    """What the labellers look at. Words are split off once, as a lambda variable."""
    words = F.array_remove(F.split(F.translate(text, WHITE, " " * len(WHITE)), " "), "")
    echoes = lambda w: F.filter(F.zip_with(w, F.slice(w, 2, F.size(w)), lambda a, b: a == b), lambda same: same)
    of_words = F.transform(
        F.array(words), lambda w: F.array(F.size(w), F.size(F.array_distinct(w)), F.size(echoes(w)))
    )[0]
    return {
        "_words": of_words,
        "_chars": F.length(text),
        "_marks": _without(text, MARKS),
        "_pipes": _without(text, "|"),
        "_upper": _without(text, UPPER),
        "_shouts": _without(text, "!"),
        "_stops": _without(text, ".,;:?"),
    }


def votes() -> dict[str, Column]:
    """Labeller -> vote, from the figures. A labeller is silent where its figure says nothing either way."""
    n, different, echoes = (F.col("_words")[k] for k in range(3))
    chars, marks, pipes, upper, shouts, stops = (F.col(f"_{c}") for c in ("chars", "marks", "pipes", "upper", "shouts", "stops"))

    def vote(bad: Column, good: Column) -> Column:
        return F.when(bad, BAD).when(good, GOOD).otherwise(SILENT)

    # a long text repeats its common words, so different words are held against a power of the length
    usual = F.pow(n, F.lit(0.9))
    return {
        "repetition": vote((n >= 8) & (different < 0.45 * usual), (n >= 8) & (different > 0.7 * usual)),
        "echoes": vote((n >= 8) & (5 * echoes > n), (n >= 8) & (50 * echoes <= n)),
        "marks": vote(10 * marks > 2 * n, (n >= 5) & (marks == 0)),
        "mark_density": vote(100 * marks > 3 * chars, (n >= 20) & (1000 * marks < chars)),
        "tables": vote(10 * pipes > 2 * n, F.lit(False)),
        "capitals": vote((chars >= 20) & (100 * upper > 35 * chars), (chars >= 40) & (100 * upper < 8 * chars)),
        "shouting": vote(10 * shouts > 2 * n, F.lit(False)),
        "sentences": vote((n >= 20) & (200 * stops < n), (n >= 5) & (100 * stops >= 4 * n) & (2 * stops <= n)),
    }


def with_pattern(docs: DataFrame, text_col: str) -> DataFrame:
    """``_pattern``: the votes as digits to base three. Figures first, so that each is taken once."""
    seen = figures(F.coalesce(F.col(text_col), F.lit("")))
    total = F.lit(0)
    for k, vote in enumerate(votes().values()):
        total = total + vote * 3**k
    return docs.withColumns(seen).withColumn("_pattern", total).drop(*seen)


N_LABELLERS = 8


# --- expectation-maximisation -----------------------------------------------------


def digits(patterns: np.ndarray, n: int) -> np.ndarray:
    return patterns[:, None] // 3 ** np.arange(n) % 3


def posteriors(patterns: np.ndarray, counts: np.ndarray, n: int, rounds: int = 200, smooth: float = 1.0) -> tuple[np.ndarray, np.ndarray]:
    """(P(good) of each pattern, accuracy of each labeller where it votes).

    Begins with bad wherever some labeller says so: labellers cry out for different kinds of junk,
    so a majority would hide each kind behind those that look for another. Silence is no
    evidence. A labeller's table of P(vote | class) is smoothed by ``smooth`` documents of each
    kind, more of them on the diagonal, so that good stays good.
    """
    votes = digits(patterns, n)
    good = np.where((votes == BAD).any(axis=1), 0.02, 0.98)
    base = smooth * np.array([[2.0, 1.0], [1.0, 2.0]])  # class x vote
    for _ in range(rounds):
        weight = np.stack(((1 - good) * counts, good * counts))  # class x pattern
        share = (weight.sum(axis=1) + 1) / (counts.sum() + 2)
        table = np.stack([[np.bincount(votes[:, k], weight[c], 3)[:2] for c in (BAD, GOOD)] for k in range(n)]) + base
        table /= table.sum(axis=2, keepdims=True)
        heard = np.concatenate((np.log(table), np.zeros((n, 2, 1))), axis=2)  # a silent vote adds nothing
        logs = np.log(share)[:, None] + sum(heard[k][:, votes[:, k]] for k in range(n))
        new = 1 / (1 + np.exp(np.clip(logs[BAD] - logs[GOOD], -700, 700)))
        done = np.abs(new - good).max() < 1e-9
        good = new
        if done:
            break
    right = share[BAD] * table[:, BAD, BAD] + share[GOOD] * table[:, GOOD, GOOD]
    return good, right


# --- hashed features --------------------------------------------------------------

# kinds of bytes: blank, line end, a-z, A-Z, digit, then marks that tell junk apart, then letters beyond ASCII
KINDS = np.full(256, 13, np.uint8)
for _kind, _bytes in enumerate([b" ", b"\n\t\r\x0b\x0c", bytes(range(97, 123)), bytes(range(65, 91)), b"0123456789", b".", b",;:", b"!?", b"|", b"#", b"*$", b"%&<>", b"'\"()-"]):
    KINDS[list(_bytes)] = _kind
KINDS[128:] = 14
KINDS[:9] = KINDS[14:32] = 15
STEPS = np.array([0.02, 0.05, 0.1, 0.15, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9])
WINDOW = 8


def _figures(texts: pa.Array) -> np.ndarray:
    """Bucket numbers for: words equal to the one before, words seen within the last few, capitals."""
    n = len(texts)
    total, same, near, upper, letters = (np.zeros(n) for _ in range(5))
    for block in hashing.blocks(texts):
        start, _, mark, _ = hashing.words(block.data)
        mark = mark[:, 0]
        text = np.searchsorted(block.starts, start, side="right") - 1
        seen = np.zeros(len(start), bool)
        for back in range(1, WINDOW + 1):
            equal = np.zeros(len(start), bool)
            equal[back:] = (mark[back:] == mark[:-back]) & (text[back:] == text[:-back])
            if back == 1:
                np.add.at(same, block.docs, np.bincount(text, equal, len(block.docs)))
            seen |= equal
        np.add.at(total, block.docs, np.bincount(text, minlength=len(block.docs)))
        np.add.at(near, block.docs, np.bincount(text, seen, len(block.docs)))
        np.add.at(upper, block.docs, block.sums(hashing.UPPER[block.data].astype(np.int64)))
        np.add.at(letters, block.docs, block.sums(hashing.LETTER[block.data].astype(np.int64)))
    shares = [same / np.maximum(total, 1), near / np.maximum(total, 1), upper / np.maximum(letters, 1)]
    steps = [np.searchsorted(STEPS, x) for x in shares] + [np.minimum(np.log2(total + 1), 15).astype(np.int64)]
    salted = np.stack([(k + 1) * 64 + x for k, x in enumerate(steps)], 1).astype(np.uint64)
    return ((salted * hashing.MIX) >> np.uint64(64 - BITS)).astype(np.int64)


def _gram_codes(block: hashing.Block) -> list[np.ndarray]:
    kinds = KINDS[block.data]
    return [hashing.grams(kinds, size, BITS, width=4) for size in (3, 5)]


GRAM_WEIGHT = 10.0  # of the mean over all n-grams, against 1 for each figure


def vectors(texts: pa.Array) -> np.ndarray:
    """Dense vectors, for a few texts at a time."""
    out = np.zeros((len(texts), 1 << BITS), np.float32)
    for block in hashing.blocks(texts):
        for code in _gram_codes(block):
            for doc, lo, hi in zip(block.docs, block.starts - 1, block.stops):
                out[doc] += np.bincount(code[lo:hi], minlength=1 << BITS)
    out *= GRAM_WEIGHT / np.maximum(out.sum(axis=1, keepdims=True), 1)
    for column in _figures(texts).T:
        np.add.at(out, (np.arange(len(texts)), column), 1)
    return out


def logits(texts: pa.Array, weights: np.ndarray, bias: float) -> np.ndarray:
    total, places = np.zeros(len(texts)), np.zeros(len(texts))
    for block in hashing.blocks(texts):
        codes = _gram_codes(block)
        np.add.at(total, block.docs, sum(block.sums(weights[code]) for code in codes))
        np.add.at(places, block.docs, len(codes) * (block.stops - block.starts + 1.0))
    return GRAM_WEIGHT * total / np.maximum(places, 1) + weights[_figures(texts)].sum(axis=1) + bias


# --- training ---------------------------------------------------------------------


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    bias: float
    accuracies: np.ndarray  # of the labellers, as estimated
    good: dict[int, float]  # posterior of each pattern of votes


def fit(
    row: np.ndarray, bucket: np.ndarray, value: np.ndarray, good: np.ndarray, stands: np.ndarray, steps: int = 200, rate: float = 0.2, decay: float = 1e-4
) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels by full-batch Adam; ``stands`` is what a row stands for.

    The rows' vectors are sparse: entry k says that ``bucket[k]`` has ``value[k]`` in ``row[k]``.
    """
    stands = stands / stands.sum()
    weights, bias, n = np.zeros(1 << BITS), np.zeros(1), len(good)
    moments = [np.zeros_like(weights), np.zeros_like(weights), np.zeros(1), np.zeros(1)]
    for step in range(1, steps + 1):
        logit = np.bincount(row, weights[bucket] * value, n) + bias
        error = (1 / (1 + np.exp(-np.clip(logit, -700, 700))) - good) * stands
        grads = np.bincount(bucket, error[row] * value, 1 << BITS) + decay * weights, np.array([error.sum()])
        for at, (param, grad) in enumerate(zip((weights, bias), grads)):
            mean, square = moments[2 * at], moments[2 * at + 1]
            mean += 0.1 * (grad - mean)
            square += 0.01 * (grad * grad - square)
            param -= rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    return weights.astype(np.float32), float(bias[0])


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_rows: int = 4000) -> Model:
    """Patterns are counted over all rows; the scorer learns from about ``max_rows`` different rows.

    Chosen are those of lowest hash of id and text, so neither the order of rows, nor a null or
    frequent id, nor a text with many copies decides.
    """
    source = docs.select(F.xxhash64(id_col, text_col).alias("place"), F.coalesce(text_col, F.lit("")).alias("_text"))
    rows = with_pattern(source, "_text").groupBy("_pattern").count().orderBy("_pattern").collect()
    if not rows:
        return Model(np.zeros(1 << BITS, np.float32), 0.0, np.zeros(N_LABELLERS), {})
    patterns = np.array([r["_pattern"] for r in rows])
    counts = np.array([r["count"] for r in rows], float)
    good, accuracies = posteriors(patterns, counts, N_LABELLERS)
    table = dict(zip(patterns.tolist(), good.tolist()))
    bad_rows, good_rows = counts[good < 0.5].sum(), counts[good >= 0.5].sum()
    likely_bad = [int(p) for p, g in table.items() if g < 0.5]
    half = max_rows // 2
    # a little more than the wanted share, written so that votes are taken of these few only
    share = max(hashing.sample_share(rows, half) for rows in (bad_rows, good_rows))
    low = F.col("place").cast("double") + float(1 << 63) <= min(1.0, 1.3 * share + 1e-6) * float(1 << 64)
    folder = shared_root(docs.sparkSession)
    few = with_pattern(stage(source.filter(low).dropDuplicates(["place"]), f"{folder}/few"), "_text")
    bad = F.col("_pattern").isin(likely_bad)
    lowest = [few.filter(side).orderBy("place").limit(half).select("_pattern", "_text") for side in (bad, ~bad)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):  # dense rows only for a few texts at once
                part = batch.slice(at, 64)
                dense = vectors(part.column(1))
                index = [np.flatnonzero(x).astype(np.int32) for x in dense]
                values = [x[i] for x, i in zip(dense, index)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(index, pa.list_(pa.int32())), pa.array(values, pa.list_(pa.float32()))],
                    ["pattern", "buckets", "shares"],
                )

    # max_rows at most
    found = lowest[0].unionByName(lowest[1]).mapInArrow(run, "pattern int, buckets array<int>, shares array<float>").toArrow()
    rows = [(p.as_py(), i.values.to_numpy(), v.values.to_numpy()) for p, i, v in zip(*found.columns)]
    rows.sort(key=lambda r: (r[0], zlib.crc32(r[1].tobytes()), zlib.crc32(r[2].tobytes())))  # whatever order they arrive in
    y = np.array([table[r[0]] for r in rows])
    n_bad = max(1, int((y < 0.5).sum()))
    stands = np.where(y < 0.5, bad_rows / n_bad, good_rows / max(1, len(y) - n_bad))
    owner = np.repeat(np.arange(len(rows)), [len(r[1]) for r in rows])
    weights, bias = fit(owner, np.concatenate([r[1] for r in rows]), np.concatenate([r[2] for r in rows]), y, stands)
    return Model(weights, bias, accuracies, table)


def judge(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """quality (0 to 1) and kept of every row, behind the row itself as the struct ``row``."""

    place = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in hashing.slices(batches):
            texts = rows.column(0).field(place)
            blank = np.array([not (t.as_py() or "").strip() for t in texts], bool)
            score = np.where(blank, 0.0, 1 / (1 + np.exp(-np.clip(logits(texts, model.weights, model.bias), -40, 40))))
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(score), pa.array((score >= 0.5) & ~blank)], ["row", "quality", "kept"])

    # the text is sent once, inside its row
    inner = docs.select(F.struct("*").alias("row"))
    return inner.mapInArrow(run, inner.select("row").schema.add("quality", "double").add("kept", "boolean"))


def classify(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with quality and kept behind its own columns, in place of columns so named (``judge`` keeps those)."""
    names = ["quality", "kept"]
    own = [F.col("row")[c].alias(c) for c in docs.columns if c not in names]
    return judge(docs, model, text_col).select(*own, *names)
