"""Toxicity by multiple-instance learning.

A text is a bag of sentences. A sentence scores the logistic of a bias plus the weights of its
hashed words and word beginnings, each counted once; a text is toxic if any sentence is (noisy-or). Only text labels are known, so the
gradient of the noisy-or tells the sentences apart, and afterwards the sentences with a score of
one half or more are the offending ones. A leak, learned with the rest, takes up labels that no
sentence explains, so that they do not raise every sentence a little.

A sentence ends at ``. ! ?`` or a line end; one of more than ``SENTENCE_WORDS`` words is looked at
in parts of that many, so that no word drowns. Words are runs of letters with A-Z folded, which
leaves marks between and around them without effect.

Features are screened by their witnesses among all labelled rows, counted in Spark. The fit uses
``max_rows`` different labelled texts, those of lowest hash (a documented bound), of which only the
screened features reach the driver, and a few more for each screened feature that none of these has.

Labels meet texts at the scan, by broadcast, while the labelled ids are at most ``BROADCAST_ROWS``;
beyond, the texts that may have a label are shuffled by id. Counting shuffles the different labelled texts once.

Defined cases: a null or empty text has no sentence and scores the leak; labels that are null or
contradict each other for one id are not learned from; without labels of both kinds every score is
the share of toxic labels; repeated rows are scored alike; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegate.llm import hashing
from tidegate.state.shared import shared_root, stage

BITS = 20
SENTENCE_WORDS = 64
PREFIXES = (3, 4, 5, 6, 7, 8)
WITNESSES = 4  # texts fetched for a screened feature that the sample lacks
ENDS = np.isin(np.arange(256), list(b".!?\n\r"))


@dataclass(frozen=True)
class Model:
    weights: np.ndarray  # per hashed feature
    bias: float
    leak: float


def _sentences(block: hashing.Block) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(features, sentence of every feature, text of every sentence, byte span of every sentence)."""
    start, stop, mark, valid = hashing.words(block.data, PREFIXES)
    if not len(start):
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64), np.empty((0, 2), np.int64)
    text = np.searchsorted(block.starts, start, side="right") - 1
    ended = np.cumsum(ENDS[block.data])[start]
    first = np.flatnonzero(np.concatenate(([True], (ended[1:] != ended[:-1]) | (text[1:] != text[:-1]))))
    sizes = np.diff(np.append(first, len(start)))
    parts = -(-sizes // SENTENCE_WORDS)
    within = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
    first = np.repeat(first, parts) + within * SENTENCE_WORDS
    sizes = np.diff(np.append(first, len(start)))
    spans = np.stack((start[first], stop[first + sizes - 1]), 1) - block.starts[text[first]][:, None]
    sentence = np.broadcast_to(np.repeat(np.arange(len(first)), sizes)[:, None], mark.shape)
    return (mark >> np.uint64(64 - BITS)).astype(np.int64)[valid], sentence[valid], text[first], spans


# --- training ---------------------------------------------------------------------


def bags(docs: DataFrame, used: np.ndarray) -> DataFrame:
    """toxic, own, the features in ``used`` of a text sentence by sentence, and how many each sentence has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.zeros(1 << BITS, bool)
        known[used] = True
        for batch in batches:
            found: list[list] = [[] for _ in range(batch.num_rows)]
            sizes: list[list] = [[] for _ in range(batch.num_rows)]
            for block in hashing.blocks(batch.column(1)):
                feature, sentence, text, _ = _sentences(block)
                key = np.unique((sentence << BITS | feature)[known[feature]])
                sentence, feature = key >> BITS, (key & (1 << BITS) - 1).astype(np.int32)
                each = np.bincount(sentence, minlength=len(text))
                owner = block.docs[text]
                for doc in np.unique(owner):
                    found[doc].append(feature[owner[sentence] == doc])
                    sizes[doc].append(each[owner == doc].astype(np.int32))
            join = lambda parts: np.concatenate(parts) if parts else np.empty(0, np.int32)
            lists = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(map(join, found), lists), pa.array(map(join, sizes), lists)],
                ["toxic", "own", "features", "sizes"],
            )

    found = docs.select("toxic", "text", "own").mapInArrow(run, "toxic int, own bigint, features array<int>, sizes array<int>")
    return found.dropDuplicates(["own"])


@dataclass(frozen=True)
class Bags:
    """Texts with their sentences' features, flat."""

    toxic: np.ndarray  # per text
    text: np.ndarray  # per sentence
    sentence: np.ndarray  # per feature
    feature: np.ndarray

    @classmethod
    def of(cls, rows: pa.Table) -> Bags:
        rows = rows.combine_chunks()
        flat = lambda name: rows[name].combine_chunks().flatten().to_numpy()
        lengths = np.array([len(x) for x in rows["sizes"]], np.int64)
        sizes = flat("sizes")
        return cls(
            rows["toxic"].to_numpy().astype(np.int64),
            np.repeat(np.arange(len(lengths)), lengths),
            np.repeat(np.arange(len(sizes), dtype=np.int32), sizes),
            flat("features").astype(np.int32),
        )


NOISE = np.random.default_rng(0).integers(1, 1 << 32, 1 << BITS)


def screened(counts: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """The features whose witnesses (label x feature, of ``totals`` texts) side with a label beyond chance.

    The G statistic has to exceed a bound that grows with the logarithm of the number of texts, as a
    penalty per weight does: few texts need a few witnesses, and of many texts ever smaller shares do.
    """
    both, g = counts.sum(axis=0), np.zeros(counts.shape[1])
    for holds, rows in ((counts, both), (totals[:, None] - counts, totals.sum() - both)):  # with the feature, without
        expected = np.maximum(rows * (totals / max(1.0, totals.sum()))[:, None], 1e-9)
        g += 2 * np.where(holds > 0, holds * np.log(np.maximum(holds, 1e-9) / expected), 0).sum(axis=0)
    return np.flatnonzero(g >= 3 * np.log(max(2.0, totals.sum())))


def _marked(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per block (row << BITS | feature, sentence of each, mark of every sentence); equal sentences have equal marks."""
    for block in hashing.blocks(texts):
        feature, sentence, text, _ = _sentences(block)
        if len(text):
            key = np.unique(sentence << BITS | feature)
            sentence, feature = key >> BITS, key & (1 << BITS) - 1
            first = np.flatnonzero(np.concatenate(([True], sentence[1:] != sentence[:-1])))
            yield block.docs[text][sentence].astype(np.int64) << BITS | feature, sentence, np.add.reduceat(NOISE[feature], first)


PLACES = 26  # bits
BROADCAST_ROWS = 1 << 20  # labelled ids that are sent to every task; more of them meet the texts in a shuffle


def labelled(texts: DataFrame, agreed: DataFrame) -> DataFrame:
    """``texts`` with the label of their id; ``agreed`` (doc_id, toxic) is a written table of unique ids."""
    if agreed.count() <= BROADCAST_ROWS:
        return texts.join(F.broadcast(agreed), "doc_id")
    return maybe_labelled(texts, agreed).join(agreed, "doc_id")


def maybe_labelled(texts: DataFrame, agreed: DataFrame) -> DataFrame:
    """``texts`` without most of those that have no label, so that the join does not shuffle them.

    The hashed ids are a bitmap of 2^``PLACES`` bits however many they are; ids that share a place
    with a labelled one stay, and the join decides.
    """
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << PLACES))
    words = agreed.select(place.alias("p")).groupBy(F.shiftright("p", 5).alias("word")).agg(
        F.expr("bit_or(shiftleft(1L, cast(p % 32 AS int)))").alias("bits")
    )
    rows = words.toArrow()
    bitmap = np.zeros(1 << (PLACES - 5), np.uint32)
    bitmap[rows["word"].to_numpy()] = rows["bits"].to_numpy().astype(np.uint32)
    shared = texts.sparkSession.sparkContext.broadcast(bitmap)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = batch.column(batch.num_columns - 1).to_numpy()
            held = shared.value[p >> 5] >> (p & 31).astype(np.uint32) & 1
            yield batch.select(range(batch.num_columns - 1)).filter(pa.array(held == 1))

    return texts.withColumn("place", place).mapInArrow(run, texts.schema)


def fresh_sentences(told: DataFrame) -> DataFrame:
    """(own, fresh): for every text the marks of the sentences that no text of its label and lower ``own`` holds.

    ``own`` is a hash of id and text, so an id with many texts is many keys, and equal rows are one.
    """

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, sentence, marks in _marked(batch.column(2)):
                first = np.flatnonzero(np.concatenate(([True], sentence[1:] != sentence[:-1])))
                at = pa.array(key[first] >> BITS)
                yield pa.RecordBatch.from_arrays([*(batch.column(k).take(at) for k in range(2)), pa.array(marks)], ["toxic", "own", "mark"])

    marks = told.select("toxic", "own", "text").mapInArrow(mark, "toxic int, own bigint, mark bigint")
    first = marks.groupBy("toxic", "mark").agg(F.min("own").alias("own"))
    return first.groupBy("own").agg(F.collect_list("mark").alias("fresh"))  # no more than the text has sentences


def _witnessed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per batch of (toxic, own, fresh, text): labels, owns, and row << BITS | feature of the fresh sentences."""
    for batch in batches:
        own = [set(marks) for marks in batch.column(2).to_pylist()]
        found = []
        for key, sentence, marks in _marked(batch.column(3)):
            at = key >> BITS
            first = np.flatnonzero(np.concatenate(([True], sentence[1:] != sentence[:-1])))
            new = np.array([m in mine for m, mine in zip(marks.tolist(), map(own.__getitem__, at[first].tolist()))], bool)
            found.append(np.unique(key[new[sentence]]))
        keys = np.unique(np.concatenate(found)) if found else np.empty(0, np.int64)
        yield batch.column(0).to_numpy(), batch.column(1).to_numpy(), keys


def bearing(told: DataFrame) -> DataFrame:
    """(toxic, own, fresh, text) of every different text that has a fresh sentence: the only shuffle of labelled texts."""
    once = told.select("toxic", "own", "text").dropDuplicates(["own"])
    return once.join(fresh_sentences(told), "own").select("toxic", "own", "fresh", "text")


def witnesses(told: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(label x feature, texts by label) over ``bearing`` rows of all labelled texts.

    A text bears witness to a feature once, and only by its fresh sentences, so that copies count
    once. Features of few texts cannot pass, and so cannot memorise them.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, (1 << BITS) + 1), np.int64)  # behind the features, the texts
        for label, _, key in _witnessed(batches):
            for y in (0, 1):
                chosen = key[label[key >> BITS] == y]
                counts[y, :-1] += np.bincount(chosen & (1 << BITS) - 1, minlength=1 << BITS)
                counts[y, -1] += np.unique(chosen >> BITS).size
        at = np.flatnonzero(counts.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), *(pa.array(c[at]) for c in counts)], ["feature", "clean", "toxic"])

    each = told.mapInArrow(count, "feature int, clean bigint, toxic bigint")
    rows = each.groupBy("feature").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).toArrow()  # 2^20 at most
    counts = np.zeros((2, (1 << BITS) + 1))
    for y, name in enumerate(("clean", "toxic")):
        counts[y, rows["feature"].to_numpy()] = rows[name].to_numpy()
    return counts[:, :-1], counts[:, -1]


def witness_rows(told: DataFrame, side: np.ndarray, each: int) -> DataFrame:
    """(feature, own) of the ``each`` lowest ``bearing`` texts of label side[feature] for features with a side (else -1)."""
    shared = told.sparkSession.sparkContext.broadcast(side)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for label, own, key in _witnessed(batches):
            feature, row = key & (1 << BITS) - 1, key >> BITS
            at = shared.value[feature] == label[row]
            yield pa.RecordBatch.from_arrays([pa.array(feature[at].astype(np.int32)), pa.array(own[row[at]])], ["feature", "own"])

    place = F.row_number().over(Window.partitionBy("feature").orderBy("own"))
    return told.mapInArrow(run, "feature int, own bigint").withColumn("place", place).filter(F.col("place") <= each).drop("place")


def screen(bags: Bags) -> np.ndarray:
    """``screened`` for texts in the driver, counted as in ``witnesses``."""
    mark = np.bincount(bags.sentence, NOISE[bags.feature].astype(float), len(bags.text))
    size = np.bincount(bags.sentence, minlength=len(bags.text))
    label = bags.toxic[bags.text]
    fresh = np.zeros(len(bags.text), bool)
    fresh[np.unique(np.stack((label, size, mark), 1), axis=0, return_index=True)[1]] = True
    use = fresh[bags.sentence]
    pairs = np.unique(bags.text[bags.sentence[use]] << BITS | bags.feature[use])
    owner, feature = pairs >> BITS, pairs & (1 << BITS) - 1
    counts = np.stack([np.bincount(feature[bags.toxic[owner] == y], minlength=1 << BITS) for y in (0, 1)]).astype(float)
    totals = np.array([np.unique(owner[bags.toxic[owner] == y]).size for y in (0, 1)], float)
    return screened(counts, totals)


def fit(bags: Bags, stands: np.ndarray | None = None, used: np.ndarray | None = None, steps: int = 200, rate: float = 0.2) -> Model:
    """Full-batch Adam on the likelihood of the labels under a leaky noisy-or, over screened features.

    ``stands`` is how many texts each one stands for, where they were sampled unequally.
    """
    toxic, n = bags.toxic, len(bags.toxic)
    stands = np.ones(n) if stands is None else stands
    share = float((stands * toxic).sum() / stands.sum()) if n else 0.0
    if share in (0.0, 1.0):
        return Model(np.zeros(1 << BITS, np.float32), -40.0, share)
    used = screen(bags) if used is None else used
    number = np.full(1 << BITS, -1, np.int32)
    number[used] = np.arange(len(used))
    known = number[bags.feature]
    sentences, sentence = np.unique(bags.sentence[known >= 0], return_inverse=True)
    known = known[known >= 0]
    if not len(known):
        return Model(np.zeros(1 << BITS, np.float32), -40.0, share)
    owner = bags.text[sentences]
    plain = np.bincount(bags.text, minlength=n) - np.bincount(owner, minlength=n)  # sentences without a known feature
    stands = stands / stands.sum()
    weights, free = np.zeros(len(used)), np.array([-6.0, np.log(share / 2 / (1 - share / 2))])  # bias and leak
    moments = [np.zeros_like(weights), np.zeros_like(weights), np.zeros(2), np.zeros(2)]
    decay = 0.1 / n
    for step in range(1, steps + 1):
        p = _logistic(np.bincount(sentence, weights[known], len(sentences)) + free[0])
        p0, leak = _logistic(free)
        log_clean = np.bincount(owner, np.log1p(-np.minimum(p, 1 - 1e-9)), n) + plain * np.log1p(-p0)
        none = np.maximum((1 - leak) * np.exp(log_clean), 1e-12)  # no sentence is toxic
        pull = stands * np.where(toxic == 1, -none / np.maximum(1 - none, 1e-9), 1.0)  # d loss / d(-log none)
        by_sentence = pull[owner] * p
        grad_w = np.bincount(known, by_sentence[sentence], len(used)) + decay * weights
        grad_f = np.array([by_sentence.sum() + (pull * plain).sum() * p0, pull.sum() * leak])
        fading = min(1.0, 2 * (1 - step / (steps + 1)))
        for at, (value, grad) in enumerate(((weights, grad_w), (free, grad_f))):
            mean, square = moments[2 * at], moments[2 * at + 1]
            mean += 0.1 * (grad - mean)
            square += 0.01 * (grad * grad - square)
            value -= rate * fading * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    full = np.zeros(1 << BITS, np.float32)
    full[used] = weights
    return Model(full, float(free[0]), float(_logistic(free[1])))


def _logistic(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def train(
    docs: DataFrame,
    labels: DataFrame,
    learnable: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    max_rows: int = 6000,
) -> Model:
    """Fit on ``max_rows`` different labelled texts, half of either label, for which ``learnable`` (of the labels) holds.

    Chosen are the texts of lowest hash of id and text, so neither the order of rows nor a frequent
    id decides. Screened features that none of them has bring ``WITNESSES`` texts each, which
    stand for all texts of their label that bear witness to the feature.
    """
    folder = shared_root(docs.sparkSession)
    known = labels.filter(learnable & F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1))
    one = known.groupBy(F.col(id_col).alias("doc_id")).agg(F.min(label_col).alias("low"), F.max(label_col).cast("int").alias("toxic"))
    agreed = stage(one.filter(F.col("low") == F.col("toxic")).select("doc_id", "toxic"), f"{folder}/agreed")
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).filter(F.col("text") != "")
    told = labelled(texts.withColumn("own", F.xxhash64("doc_id", "text")), agreed)

    owns = stage(told.select("toxic", "own").distinct(), f"{folder}/owns")
    rows = {r["toxic"]: r["count"] for r in owns.groupBy("toxic").count().collect()}
    half = max_rows // 2
    lowest = [owns.filter(F.col("toxic") == y).orderBy("own").limit(half) for y in (0, 1)]
    chosen = stage(lowest[0].unionByName(lowest[1]).select("own"), f"{folder}/chosen")  # max_rows at most

    witnessing = stage(bearing(told), f"{folder}/bearing")
    counts, totals = witnesses(witnessing)
    used = screened(counts, totals)
    sample = bags(told.join(F.broadcast(chosen), "own"), used).toArrow().sort_by("own")
    found = Bags.of(sample)
    stands = np.array([rows.get(y, 0) / max(1, min(rows.get(y, 0), half)) for y in (0, 1)])[found.toxic]

    rare = np.setdiff1d(used, found.feature)
    if len(rare):
        side = np.full(1 << BITS, -1, np.int8)
        side[rare] = counts[1, rare] * totals[0] > counts[0, rare] * totals[1]
        picked = witness_rows(witnessing, side, WITNESSES).toPandas()
        each = counts[side[picked["feature"]], picked["feature"]] / picked.groupby("feature")["own"].transform("size")
        weight = each.groupby(picked["own"]).max()
        weight = weight[~weight.index.isin(sample["own"].to_pandas())]
        owners = docs.sparkSession.createDataFrame([(int(own),) for own in weight.index], "own bigint")  # WITNESSES a feature
        more = bags(told.join(F.broadcast(owners), "own"), used).toArrow().sort_by("own")
        stands = np.concatenate((stands, weight[more["own"].to_pandas()].to_numpy()))
        found = Bags.of(pa.concat_tables([sample, more]))
    return fit(found, stands, used)


# --- scoring ----------------------------------------------------------------------


def score_batch(texts: pa.Array, model: Model, locate: float = 0.5) -> tuple[np.ndarray, list[list[dict]]]:
    """Noisy-or score of every text, and the byte spans of its sentences that score ``locate`` or more."""
    clean = np.zeros(len(texts))
    spans: list[list[dict]] = [[] for _ in range(len(texts))]
    for block in hashing.blocks(texts):
        feature, sentence, text, span = _sentences(block)
        if not len(text):
            continue
        known = np.flatnonzero(model.weights[feature])  # few: the rest weighs nothing
        key = np.unique(sentence[known] << BITS | feature[known])
        p = _logistic(np.bincount(key >> BITS, model.weights[key & (1 << BITS) - 1], len(text)) + model.bias)
        doc = block.docs[text]
        np.add.at(clean, doc, np.log1p(-np.minimum(p, 1 - 1e-9)))
        for k in np.flatnonzero(p >= locate):
            lo, hi = (span[k] + block.begins[text[k]]).tolist()  # from the text's own beginning
            spans[doc[k]].append({"start": lo, "stop": hi, "score": float(p[k])})
    return 1 - (1 - model.leak) * np.exp(clean), spans


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score, predicted and the offending sentences' byte spans."""

    used, bias, leak = np.flatnonzero(model.weights), model.bias, model.leak
    values = model.weights[used]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(np.zeros(1 << BITS, np.float32), bias, leak)  # only the weights in use are sent
        model.weights[used] = values
        kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64()), ("score", pa.float64())]))
        for batch in batches:
            scores, spans = score_batch(batch.column(1), model)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores), pa.array((scores >= 0.5).astype(np.int32)), pa.array(spans, kind)],
                ["doc_id", "score", "predicted", "offending"],
            )

    picked = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = picked.schema["doc_id"].dataType.simpleString()
    return picked.mapInArrow(
        run, f"doc_id {kind}, score double, predicted int, offending array<struct<start:bigint,stop:bigint,score:double>>"
    )
