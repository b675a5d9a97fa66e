"""Target-distribution importance resampling over hashed n-grams.

A feature is a run of ``n_min`` to ``n_max`` words; its bucket is the CRC-32 of its bytes modulo
``buckets``. All documents and all target texts are counted by bucket, the logarithm of the two
smoothed shares is the bucket's gain, and a document weighs the sum of its features' gains. Adding
a Gumbel number that depends on the id alone and taking the highest scores draws documents without
replacement in proportion to the exponential of their weights.

Within a task the n-grams of a batch are interned in an open-addressed table (``spans.Table``): keys
are XXH64, equal keys are verified by their bytes, a slot stores its bucket and how often it occurs.
So the CRC is taken once per different n-gram, bucket counts are sums over slots, and a document's
weight gathers the gains by the slots of its occurrences.

What leaves the tasks: at most ``buckets`` counts each (summed by Spark, ``buckets`` rows reach the
driver, whose size the parameter bounds) and one row of numbers per document. The drawing order
is a range partitioning of these rows; a rank is the place within the partition plus the sizes of the
partitions before, so no task sees all rows.

Defined cases: a null or blank text has no words and weight 0; a null id takes part under the empty
id and is the last of ties; rows that agree in id and score are taken in the order of feature
counts, then any (their rows are told apart by no column); repeated rows are ranked one by one;
without target texts every gain follows from t = 0; no documents give no rows. The input's other
columns are not read, so their names cannot clash.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.llm.spans import Table, Words, byte_class, word_blocks
from tidegate.state.shared import shared_root, stage

# digits, lower-case letters (capitals are lowered first) and everything beyond ASCII
WORD = byte_class(bytes([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]))


@dataclass(frozen=True)
class Features:
    n_min: int = 1
    n_max: int = 1
    buckets: int = 10_000


def _texts(column: pa.Array) -> list[bytes | None]:
    return column.cast(pa.binary()).to_pylist()


def _slots(words: Words, features: Features) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per n-gram length: (document and slot of every occurrence, bucket of every slot)."""
    if not len(words):
        return
    data, start, stop = (words.data, words.start, words.stop) if features.n_max == 1 else words.spaced()
    raw = data.tobytes()
    for n in range(features.n_min, features.n_max + 1):
        last = np.arange(n - 1, len(start))
        first = last - (n - 1)
        fits = words.new[last] & (words.doc[last] == words.doc[first])
        first, last = first[fits], last[fits]
        table = Table(data, start[first], stop[last])
        spans = zip(start[first[table.first]].tolist(), stop[last[table.first]].tolist())
        bucket = np.fromiter((zlib.crc32(raw[a:b]) % features.buckets for a, b in spans), np.int64, len(table.first))
        yield words.doc[last], table, bucket


def bucket_counts(texts: DataFrame, text_col: str = "text", features: Features = Features()) -> DataFrame:
    """(bucket, n): how many features of all texts fall into each bucket; empty buckets are absent."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(features.buckets, np.int64)
        for batch in batches:
            for words in word_blocks(_texts(batch.column(0)), WORD, features.n_max - 1):
                for _, table, bucket in _slots(words, features):
                    total += np.bincount(bucket, table.count, features.buckets).astype(np.int64)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["bucket", "n"])

    partial = texts.select(F.col(text_col).alias("text")).mapInArrow(count, "bucket long, n long")
    return partial.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(source: DataFrame, target: DataFrame, buckets: int) -> np.ndarray:
    """1000 times the smoothed log ratio of target to source, floored, for every bucket."""
    sides = []
    for counts in (source, target):
        vector = np.zeros(buckets, np.int64)
        for row in counts.collect():  # at most one row per bucket
            vector[row["bucket"]] = row["n"]
        sides.append(vector)
    s, t = sides
    all_s, all_t = float(s.sum() + buckets), float(t.sum() + buckets)
    ratios = ((t + 1.0) * all_s) / ((s + 1.0) * all_t)
    return np.array([math.floor(1000 * math.log(x)) for x in ratios.tolist()], np.int64)


def weigh(docs: DataFrame, gain: np.ndarray, id_col: str = "doc_id", text_col: str = "text", features: Features = Features()) -> DataFrame:
    """(id, n_words, n_features, weight) of every row."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(gain)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums = np.zeros((3, batch.num_rows), np.int64)
            for words in word_blocks(_texts(batch.column(1)), WORD, features.n_max - 1):
                np.add.at(sums[0], words.doc[words.new], 1)
                for doc, table, bucket in _slots(words, features):
                    np.add.at(sums[1], doc, 1)
                    np.add.at(sums[2], doc, shared.value[bucket][table.slot])
            names = ["doc_id", "n_words", "n_features", "weight"]
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, sums)], names)

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(work, f"doc_id {kind}, n_words long, n_features long, weight long")


def noise(id_col: str, seed: int) -> Column:
    """A Gumbel number in thousandths, from the first 32 bits of a SHA-256 of seed and id."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = 10,
    min_words: int = 20,
    seed: int = 2024,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_col: str = "text",
    features: Features = Features(),
) -> DataFrame:
    """Every document's doc_id, n_words, n_features, weight, score, and rank where it is drawn.

    Of the documents with at least ``min_words`` words, ``percent`` of a hundred are drawn.
    """
    folder = shared_root(docs.sparkSession)
    source, wanted = bucket_counts(docs, text_col, features), bucket_counts(target, target_col, features)
    weighed = weigh(docs, gains(source, wanted, features.buckets), id_col, text_col, features)
    scored = stage(
        weighed.withColumn("score", F.col("weight") + noise("doc_id", seed)).withColumn("row", F.monotonically_increasing_id()),
        f"{folder}/scored",
    )
    eligible = F.col("n_words") >= min_words
    # the row number makes every sort key different, so equal scores spread over partitions too
    order = [(~eligible).asc(), F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("n_features").asc(), F.col("row").asc()]
    # after the sort, the high bits of the number are the partition and the low bits the place in it
    sorted_rows = scored.repartitionByRange(*order).sortWithinPartitions(*order).drop("row")
    placed = stage(sorted_rows.withColumn("place", F.monotonically_increasing_id()), f"{folder}/placed")
    part, inner = F.shiftright("place", 33), F.col("place").bitwiseAND((1 << 33) - 1)
    sizes = placed.groupBy(part.alias("part")).agg(F.count("*").alias("n"), F.count_if(eligible).alias("fit")).orderBy("part").collect()
    before = np.concatenate(([0], np.cumsum([r["n"] for r in sizes])))[:-1].tolist()
    drawn = sum(r["fit"] for r in sizes) * percent // 100
    offsets = docs.sparkSession.createDataFrame([(r["part"], b) for r, b in zip(sizes, before)], "part long, before long")
    rank = F.col("before") + inner + 1
    return (
        placed.withColumn("part", part)
        .join(F.broadcast(offsets), "part")  # one row per shuffle partition
        .select("doc_id", "n_words", "n_features", "weight", "score", F.when(eligible & (rank <= drawn), rank).alias("rank"))
    )
