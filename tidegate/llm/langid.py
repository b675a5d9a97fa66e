"""Language identification by averaged hashed subword embeddings.

A text's vector is the mean of the embeddings of its hashed byte n-grams (two to four bytes of
the case-folded letters, blanks included), and a linear softmax on it gives the language. Both are
trained by stochastic gradient descent in numpy on a bounded sample. As mean and softmax input are
linear, scoring needs one number per bucket and language.

The temperature of the softmax is fitted on a part of the sample that is not trained on, and a
text is rejected when its calibrated score lies below a threshold, chosen there so that at most
``reject_share`` of the texts with the right prediction fall under it.

The sample: every language gets the same number of different rows, those of lowest hash of id and
text, about ``max_rows`` in all (a documented bound; see ``train``) but at least ``least_rows`` for each
language, so the sample and the steps of the descent grow with the number of languages and none is left out.

Defined cases: a text that is null or holds no letter gets ``und``, score 0, and is rejected; a
null language is never learned from; a null id is an id; without any labelled row every text is ``und``;
repeated rows are predicted alike; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegate.llm import hashing
from tidegate.state.shared import shared_root, stage

UNKNOWN = "und"
BITS = 15
SIZES = (2, 3, 4)


@dataclass(frozen=True)
class Model:
    languages: list[str]
    weights: np.ndarray  # bucket x language: embedding times softmax weights
    bias: np.ndarray
    temperature: float
    threshold: float


def _buckets(block: hashing.Block) -> list[np.ndarray]:
    folded = hashing.FOLDED[block.data]
    return [hashing.grams(folded, size, BITS) for size in SIZES]


def _lowered(text: Column) -> Column:
    return F.lower(text)


# --- training ---------------------------------------------------------------------


def bucket_counts(docs: DataFrame) -> DataFrame:
    """lang, and the hashed n-grams of text with how often each occurs: at most 2^15 of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):  # dense counts only for a few texts at once
                part = batch.slice(at, 64)
                found = np.zeros((part.num_rows, 1 << BITS), np.int32)
                for block in hashing.blocks(part.column(1)):
                    codes = _buckets(block)
                    for k, lo, hi in zip(block.docs, block.starts - 1, block.stops):
                        for code in codes:
                            found[k] += np.bincount(code[lo:hi], minlength=1 << BITS).astype(np.int32)
                index = [np.flatnonzero(x).astype(np.int32) for x in found]
                counts = [x[i] for x, i in zip(found, index)]
                lists = pa.list_(pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(index, lists), pa.array(counts, lists)], ["lang", "buckets", "counts"]
                )

    return docs.select("lang", _lowered(F.col("text")).alias("text")).mapInArrow(
        run, "lang string, buckets array<int>, counts array<int>"
    )


def fit(
    labels: np.ndarray,
    rows: list[tuple[np.ndarray, np.ndarray]],
    n_languages: int,
    dim: int = 16,
    steps: int = 300,
    batch: int = 64,
    rate: float = 1.0,
    seed: int = 7,
) -> tuple[np.ndarray, np.ndarray]:
    """Embeddings times softmax weights, and bias, by minibatch gradient descent with a falling rate."""
    rng = np.random.default_rng(seed)
    table = rng.normal(0, 1 / dim, (1 << BITS, dim)).astype(np.float32)
    heads = rng.normal(0, 0.1, (dim, n_languages)).astype(np.float32)
    bias = np.zeros(n_languages, np.float32)
    step = 0
    while step < steps:  # as many steps for a small sample as for a full one
        order = rng.permutation(len(rows))
        for at in range(0, len(order), batch):
            now = rate * max(0.0, 1 - step / steps)
            step += 1
            picked = order[at : at + batch]
            index = np.concatenate([rows[k][0] for k in picked])
            share = np.concatenate([rows[k][1] for k in picked])[:, None]
            cuts = np.cumsum([0] + [len(rows[k][0]) for k in picked[:-1]])
            mean = np.add.reduceat(table[index] * share, cuts, axis=0)
            error = _softmax(mean @ heads + bias)
            error[np.arange(len(picked)), labels[picked]] -= 1
            back = (error @ heads.T).astype(np.float32)
            owner = np.repeat(np.arange(len(picked)), np.diff(np.append(cuts, len(index))))
            # an embedding's step is spread over many buckets: scale by their number, as for a mean
            grad = back[owner] * share * np.float32(now * 200 / len(picked))
            for d in range(dim):
                table[:, d] -= np.bincount(index, grad[:, d], 1 << BITS).astype(np.float32)
            heads -= (now * 20 / len(picked)) * (mean.T @ error).astype(np.float32)
            bias -= (now / len(picked)) * error.sum(axis=0).astype(np.float32)
    return table @ heads, bias


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def calibrate(logits: np.ndarray, labels: np.ndarray, reject_share: float) -> tuple[float, float]:
    """(temperature, threshold) from texts that were not trained on."""
    if not len(labels):
        return 1.0, 0.0
    choices = np.exp(np.linspace(np.log(0.05), np.log(20), 60))
    doubt = 1 / (len(labels) + 2)  # as in Platt scaling: a few right answers do not prove certainty
    loss = []
    for t in choices:
        logs = np.log(_softmax(logits / t) + 1e-12)
        own = logs[np.arange(len(labels)), labels]
        loss.append(-((1 - doubt) * own + doubt * (logs.sum(axis=1) - own) / max(1, logs.shape[1] - 1)).mean())
    temperature = float(choices[int(np.argmin(loss))])
    scores = _softmax(logits / temperature)
    right = np.sort(scores.max(axis=1)[scores.argmax(axis=1) == labels])
    if not len(right):
        return temperature, 0.0
    return temperature, float(min(0.5, right[int(reject_share * len(right))]))


def train(
    docs: DataFrame,
    learnable: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    max_rows: int = 3000,
    reject_share: float = 0.001,
    least_rows: int = 10,
) -> Model:
    """Fit on about ``max_rows`` different rows for which ``learnable`` holds, and at least ``least_rows`` a language."""
    folder = shared_root(docs.sparkSession)
    picked = docs.filter(learnable & F.col(lang_col).isNotNull() & (F.col(text_col) != "")).select(
        F.xxhash64(id_col, text_col).alias("place"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text")
    )
    counts = stage(picked.groupBy("lang").agg(F.count("*").alias("rows")), f"{folder}/langs")
    n = counts.count()
    if not n:
        return Model([], np.zeros((1 << BITS, 0), np.float32), np.zeros(0, np.float32), 1.0, 0.0)
    each = max(least_rows, max_rows // n)
    # first a share of the hash range for every language, without sorting or shuffling; then the lowest
    share = F.least(F.lit(1.0), F.lit(1.3 * each + 8) / F.col("rows"))
    within = (F.col("place").cast("double") + float(1 << 63)) <= share * float(1 << 64)
    near = picked.join(counts, "lang").filter(within).select("lang", "place", "text").dropDuplicates(["lang", "place"])
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("place"))
    chosen = near.withColumn("rank", rank).filter(F.col("rank") <= each)
    found = bucket_counts(chosen).toArrow()
    rows = [(lang.as_py(), *(x.values.to_numpy() for x in pair)) for lang, *pair in zip(*found.columns)]
    # the same model, whatever order rows arrive in
    rows.sort(key=lambda r: (r[0], zlib.crc32(r[1].tobytes()), zlib.crc32(r[2].tobytes())))
    languages = sorted({r[0] for r in rows})
    labels = np.array([languages.index(r[0]) for r in rows])
    rows = [(index.astype(np.int64), (count / count.sum()).astype(np.float32)) for _, index, count in rows]
    held = np.arange(len(rows)) % 5 == 0 if len(rows) >= 20 else np.zeros(len(rows), bool)
    steps = max(300, 6 * len(languages))
    dim = max(16, len(languages) // 8)
    weights, bias = fit(labels[~held], [rows[k] for k in np.flatnonzero(~held)], len(languages), dim, steps)
    logits = np.array([share @ weights[index] + bias for index, share in (rows[k] for k in np.flatnonzero(held))])
    temperature, threshold = calibrate(logits, labels[held], reject_share)
    return Model(languages, weights, bias, temperature, threshold)


# --- prediction -------------------------------------------------------------------


def logits(texts: pa.Array, model: Model) -> np.ndarray:
    total = np.zeros((len(texts), len(model.languages)))
    places = np.zeros(len(texts))
    for block in hashing.blocks(texts):
        codes = _buckets(block)
        np.add.at(places, block.docs, len(SIZES) * (block.stops - block.starts + 1.0))
        for k in range(len(model.languages)):
            column = np.ascontiguousarray(model.weights[:, k])
            np.add.at(total[:, k], block.docs, sum(block.sums(column[code]) for code in codes))
    return total / np.maximum(places, 1)[:, None] + model.bias


def judge(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """lang_pred, score and rejected of every row, behind the row itself as the struct ``row``."""
    names = ["row", "lang_pred", "score", "rejected"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in hashing.slices(batches):
            lettered = np.array(batch.column(2).to_pylist(), bool) & bool(model.languages)
            predicted = np.full(batch.num_rows, UNKNOWN, object)
            score = np.zeros(batch.num_rows)
            if lettered.any():
                shares = _softmax(logits(batch.column(1), model) / model.temperature)
                best = shares.argmax(axis=1)
                predicted[lettered] = np.array(model.languages, object)[best[lettered]]
                score[lettered] = shares[np.arange(len(best)), best][lettered]
            rejected = ~lettered | (score < model.threshold)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(predicted, pa.string()), pa.array(score), pa.array(rejected)], names)

    lettered = F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False))
    inner = docs.select(F.struct("*").alias("row"), _lowered(F.col(text_col)).alias("lowered"), lettered.alias("lettered"))
    schema = inner.select("row").schema.add("lang_pred", "string").add("score", "double").add("rejected", "boolean")
    return inner.mapInArrow(run, schema)


def predict(docs: DataFrame, model: Model, text_col: str = "text", pred_col: str = "lang_pred") -> DataFrame:
    """``docs`` with lang_pred, score and rejected behind its own columns, in place of columns so named (``judge`` keeps those)."""
    names = [pred_col, "score", "rejected"]
    own = [F.col("row")[c].alias(c) for c in docs.columns if c not in names]
    return judge(docs, model, text_col).select(*own, F.col("lang_pred").alias(pred_col), "score", "rejected")
