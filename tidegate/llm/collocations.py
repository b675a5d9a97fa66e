"""Phrase collocations by SON partitioning: mine shards at lowered support, then count all candidates exactly.

Documents are dealt to ``shards`` sets by a hash of their text. A phrase that occurs ``support`` times
in its language occurs, in at least one shard, ``support`` times the shard's share of the language's
words (rounded up). So every shard is mined completely at that support, level by level:

1. all words are counted;
2. all pairs of locally frequent words that stand side by side;
3. all longer phrases whose pairs are all locally frequent.

The union of the locally frequent phrases holds every globally frequent one. One more pass counts
these candidates over all documents by their text, not by hashes, and the global support decides. What
is frequent has frequent parts only, so runs are looked up where both parts of one word less were found.
A shard is not a task: its counts meet by ranges of hashes, so neither a shard nor a hot word meets in
one place. Tasks sum up four blocks of text. Words then go to a Spark aggregation one by one; the far more
runs of levels 2 and 3 go as arrays, a row for each range, and a range, of about 2^21 words of the input, is
one group. One block's arrays are held at a time, and texts reach a task in batches of four blocks' bytes.
Keep ``shards`` well below the support, or the lowered support is 1 and prunes nothing.

While mining, phrases are 64-bit hashes salted by language; equal hashes can only add candidates.
Which phrases are frequent is sent to the tasks as a bitmap of hashed places: 16 bits for each
phrase, up to ``max_bits`` in all, which bounds what is sent; beyond that it prunes less and the result stays.
In the last pass words are interned with their bytes verified, and phrases are sequences of word numbers.

Phrases do not cross ``BREAKS``; words are runs of anything else but blanks and tabs, A-Z lowered.
Defined cases: a null language is ``und``; null, empty and blank texts have no words; repeated rows
count as often as given; ties in rank fall to the phrase in byte order; no documents, or no frequent
phrase, give no rows. The input's other columns are not read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.llm.spans import Table, Words, byte_class, mixed, strings, word_blocks, xxh64
from tidegate.state.shared import shared_root, stage

BREAKS = b".,;:!?\n\x0b\x0c\r"
WORD = byte_class(b" \t" + BREAKS)
_BREAK = ~byte_class(BREAKS)
_STEP = np.uint64(0x9E3779B97F4A7C15)  # 2^64 / golden ratio
_BLOCK = 1 << 20  # bytes of text looked at together
_BLOCKS = 4  # so many blocks' counts are summed before they are given out
_PART = 1 << 21  # so many words of the input for each range of hashes
_PAGE = 32768  # bits in one value of bitmap_construct_agg
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


class Phrases:
    """Runs of words of one block: their hashes, and where a run of n words may begin."""

    def __init__(self, words: Words, salts: np.ndarray):
        self.words = words
        piece = np.cumsum(_BREAK[words.data])[words.start]
        self.hash = xxh64(words.data, words.start, words.stop)
        self.joined = piece[1:] == piece[:-1]
        self.codes = [mixed(self.hash ^ salts[words.doc].astype(np.uint64))]
        self.fits = [np.ones(len(words), bool)]

    def grow(self) -> None:
        """From runs of n to runs of n + 1 words."""
        n = len(self.codes)
        self.codes.append(mixed(self.codes[-1][:-1] * _STEP + self.hash[n:]))
        self.fits.append(self.fits[-1][:-1] & self.joined[n - 1 :])

    def counted(self, n: int) -> np.ndarray:
        """Which runs of n words are to be counted: inside a piece, and not counted in the part before."""
        return self.fits[n - 1] & self.words.new[n - 1 :]


class Bitmap:
    """Hashes of phrases (and their shard) as bits, one at ``2^bits`` places; unlike phrases may share one."""

    def __init__(self, pages: dict[int, bytes], bits: int):
        self.bits = bits
        self.data = np.zeros(max(1, (1 << bits) // _PAGE) * (_PAGE // 8), np.uint8)
        for page, content in pages.items():
            self.data[page * (_PAGE // 8) : (page + 1) * (_PAGE // 8)] = np.frombuffer(content, np.uint8)

    def holds(self, codes: np.ndarray, shards: np.ndarray | int = 0) -> np.ndarray:
        turned = np.asarray(shards, np.uint64) << np.uint64(self.bits - 8)
        place = ((codes ^ turned) & np.uint64((1 << self.bits) - 1)).astype(np.int64)
        return (self.data[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1


def _bitmap(frequent: DataFrame, max_bits: int, by_shard: bool) -> Bitmap:
    """The bitmap of (g, shard) rows; its pages are made by Spark and bounded by ``max_bits`` bits."""
    bits = min(max_bits, max(16, (16 * frequent.count()).bit_length()))
    turned = F.shiftleft(F.col("shard").cast("long"), bits - 8) if by_shard else F.lit(0).cast("long")
    place = F.col("g").bitwiseXOR(turned).bitwiseAND((1 << bits) - 1) + 1
    pages = (
        frequent.select(place.alias("place"))
        .groupBy(F.bitmap_bucket_number("place").alias("page"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("content"))
        .collect()
    )
    return Bitmap({row["page"] - 1: bytes(row["content"]) for row in pages}, bits)


def _staged(frame: DataFrame, folder: str) -> DataFrame:
    """``stage``, with rows sent to Python by their bytes: 10,000 texts at once are held several times on either side."""
    conf = frame.sparkSession.conf
    before = conf.get(_BATCH, None)
    conf.set(_BATCH, str(_BLOCK * _BLOCKS))
    try:
        return stage(frame, folder)
    finally:
        conf.unset(_BATCH) if before is None else conf.set(_BATCH, before)


def _by_group(group: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(group, its places) for every group that occurs."""
    order = np.argsort(group.astype(np.int16) if len(group) and group.max() < 1 << 15 else group, kind="stable")
    cuts = np.flatnonzero(np.diff(group[order])) + 1
    for places in np.split(order, cuts):
        if len(places):
            yield int(group[places[0]]), places


def _blocks(batch: pa.RecordBatch, carry: int) -> Iterator[Iterator[Words]]:
    """Blocks, ``_BLOCKS`` at most together; each is made when it is asked for."""
    texts = (text.as_py() for text in batch.column("text").cast(pa.binary()))
    blocks = filter(len, word_blocks(texts, WORD, carry, _BLOCK))
    for first in blocks:
        yield chain((first,), islice(blocks, _BLOCKS - 1))


def _summed(codes: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Different codes and the sums of their counts."""
    every = np.concatenate(codes)
    order = np.argsort(every)
    every = every[order]
    first = np.flatnonzero(np.concatenate(([True], every[1:] != every[:-1])))
    return every[first], np.add.reduceat(np.concatenate(counts)[order], first)


Level = Callable[[Phrases, np.ndarray], Iterator[tuple[int, np.ndarray]]]


def _counts(batches: Iterator[pa.RecordBatch], carry: int, level: Level, by: str) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(value of ``by``, shard, codes in order, counts) of the runs that ``level`` picks in some blocks, given the phrases and each word's shard."""
    for batch in batches:
        shards, salts, given = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("shard", "salt", by))
        pairs, group_of = np.unique(np.stack((given, shards)), axis=1, return_inverse=True)
        for blocks in _blocks(batch, carry):
            held: dict[int, list[np.ndarray]] = defaultdict(list)  # group -> codes
            for words in blocks:
                phrases, shard, group = Phrases(words, salts), shards[words.doc], group_of[words.doc]
                for n, places in level(phrases, shard):
                    codes = phrases.codes[n - 1][places]
                    for g, members in _by_group(group[places]):
                        held[g].append(codes[members])
            while held:
                g, codes = held.popitem()
                yield int(pairs[0, g]), int(pairs[1, g]), *np.unique(np.concatenate(codes), return_counts=True)


def _count_words(rows: DataFrame) -> DataFrame:
    """(salt, shard, g, n): counts of all words."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for salt, shard, found, count in _counts(batches, 0, _all_words, "salt"):
            same = [pa.array(np.full(len(found), salt)), pa.array(np.full(len(found), shard, np.int32))]
            yield pa.RecordBatch.from_arrays([*same, pa.array(found.view(np.int64)), pa.array(count)], ["salt", "shard", "g", "n"])

    counted = rows.mapInArrow(work, "salt long, shard int, g long, n long")
    return counted.groupBy("salt", "shard", "g").agg(F.sum("n").alias("n"))


def _mine(rows: DataFrame, carry: int, level: Level, parts: int) -> DataFrame:
    """(shard, g): the runs that ``level`` picks whose count in a language and shard reaches its ``least``.

    Counts of some blocks go out as arrays, one for each of ``parts`` ranges of hashes; a range meets in one group.
    """
    edges = np.array([(part << 64) // parts for part in range(1, parts)], np.uint64)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for least, shard, found, count in _counts(batches, carry, level, "least"):
            cuts = np.concatenate(([0], np.searchsorted(found, edges), [len(found)]))
            part = np.flatnonzero(np.diff(cuts))
            offsets = pa.array(np.append(cuts[part], len(found)).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(part.astype(np.int32)),
                    pa.array(np.full(len(part), least)),
                    pa.array(np.full(len(part), shard, np.int32)),
                    pa.ListArray.from_arrays(offsets, pa.array(found.view(np.int64))),
                    pa.ListArray.from_arrays(offsets, pa.array(count.astype(np.int32))),
                ],
                ["part", "least", "shard", "codes", "counts"],
            )

    counted = rows.mapInArrow(work, "part int, least long, shard int, codes array<long>, counts array<int>")
    return counted.groupBy("part").applyInArrow(_frequent, "shard int, g long")


def _frequent(counted: pa.Table) -> pa.Table:
    """(shard, g): the codes of one range whose counts sum up to the lowered support of their language and shard."""
    least, shards = (counted.column(c).to_numpy().astype(np.int64) for c in ("least", "shard"))
    pairs, group = np.unique(np.stack((least, shards)), axis=1, return_inverse=True)
    group = np.repeat(group, pc.list_value_length(counted.column("codes")).to_numpy())
    codes, counts = (pc.list_flatten(counted.column(c)).to_numpy() for c in ("codes", "counts"))
    shard, frequent = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
    for g, members in _by_group(group):
        found, count = _summed([codes[members]], [counts[members].astype(np.int64)])
        frequent.append(found[count >= pairs[0, g]])
        shard.append(np.full(len(frequent[-1]), pairs[1, g], np.int32))
    return pa.table({"shard": np.concatenate(shard), "g": np.concatenate(frequent)})


def _all_words(phrases: Phrases, shard: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    yield 1, np.flatnonzero(phrases.counted(1))


def _pairs(bitmap) -> Level:
    def level(phrases: Phrases, shard: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        frequent = bitmap.value.holds(phrases.codes[0], shard)
        phrases.grow()
        yield 2, np.flatnonzero(phrases.counted(2) & frequent[:-1] & frequent[1:])

    return level


def _longer(bitmap, max_words: int) -> Level:
    def level(phrases: Phrases, shard: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        phrases.grow()
        pair = bitmap.value.holds(phrases.codes[1], shard[:-1]) & phrases.fits[1]
        whole = pair
        for n in range(3, max_words + 1):
            phrases.grow()
            whole = whole[:-1] & pair[n - 2 :]
            yield n, np.flatnonzero(phrases.counted(n) & whole)

    return level


def _count_exactly(rows: DataFrame, bitmap, max_words: int) -> DataFrame:
    """(lang, size, phrase, n): exact counts, by some blocks, of every run whose hash, and its parts' hashes, are candidates'."""
    keys = ["lang", "size", "phrase"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            salts = batch.column("salt").to_numpy(zero_copy_only=False).astype(np.int64)
            group_of = np.unique(salts, return_inverse=True)[1]
            for blocks in _blocks(batch, max_words - 1):
                found = [part for words in blocks for part in counted(words, batch.column("lang"), salts, group_of)]
                if found:
                    table = pa.Table.from_batches(found).group_by(keys, use_threads=False).aggregate([("n", "sum")])
                    yield from table.select([*keys, "n_sum"]).rename_columns([*keys, "n"]).to_batches()

    def counted(words: Words, langs: pa.Array, salts: np.ndarray, group_of: np.ndarray) -> Iterator[pa.RecordBatch]:
        phrases, group = Phrases(words, salts), group_of[words.doc]
        number = Table(words.data, words.start, words.stop).slot
        data, start, stop = words.spaced()
        for n in range(1, max_words + 1):
            if n == 1:
                whole = np.ones(len(words), bool)
            else:  # both parts of n - 1 words must be candidates as well
                phrases.grow()
                whole = whole[:-1] & whole[1:] & phrases.fits[n - 1]
            maybe = np.flatnonzero(whole)
            whole[maybe] = bitmap.value.holds(phrases.codes[n - 1][maybe])
            places = np.flatnonzero(phrases.counted(n) & whole)
            same = number[places]
            for k in range(1, n):  # the run as one number: a rank of its beginning, then the next word
                same = same if k == 1 else np.unique(same, return_inverse=True)[1]
                same = (same << 32) | number[places + k]
            for _, members in _by_group(group[places]):
                _, first, count = np.unique(same[members], return_index=True, return_counts=True)
                at = places[members[first]]
                yield pa.RecordBatch.from_arrays(
                    [
                        langs.take(pa.array(words.doc[at])),
                        pa.array(np.full(len(at), n, np.int32)),
                        strings(data, start[at], stop[at + n - 1]),
                        pa.array(count.astype(np.int64)),
                    ],
                    [*keys, "n"],
                )

    return rows.mapInArrow(work, "lang string, size int, phrase string, n long")


def frequent_phrases(
    docs: DataFrame,
    folder: str,
    support: int = 30,
    max_words: int = 4,
    shards: int = 4,
    max_bits: int = 27,
    lang_col: str = "lang",
    text_col: str = "text",
) -> tuple[DataFrame, DataFrame]:
    """(lang, size, phrase, f) of every phrase with at least ``support`` occurrences, and (lang, n) words."""
    if not 1 <= shards <= 256:
        raise ValueError("shards must be 1 to 256")
    share = docs.sparkSession.sparkContext.broadcast
    lang = F.coalesce(F.col(lang_col), F.lit("und"))
    rows = docs.select(
        lang.alias("lang"),
        F.xxhash64(lang).alias("salt"),
        F.pmod(F.xxhash64(text_col), F.lit(shards)).cast("int").alias("shard"),
        F.col(text_col).alias("text"),
    )
    mined = rows.drop("lang")
    counted = _staged(_count_words(mined), f"{folder}/words")
    sizes = counted.groupBy("salt", "shard").agg(F.sum("n").alias("words"))
    totals = sizes.groupBy("salt").agg(F.sum("words").alias("all_words"))
    # a row for each language and shard: the lowered support, rounded up
    least = _staged(
        sizes.join(totals, "salt").select("salt", "shard", "words", F.expr(f"({support} * words + all_words - 1) div all_words").alias("least")),
        f"{folder}/least",
    )
    words = least.agg(F.sum("words")).first()[0] or 0
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), words // _PART)
    mined = mined.join(least.drop("words"), ["salt", "shard"])

    levels = [_staged(counted.join(least, ["salt", "shard"]).filter("n >= least").select("shard", "g"), f"{folder}/frequent_words")]
    if max_words > 1:
        pairs = _mine(mined, 1, _pairs(share(_bitmap(levels[0], max_bits, True))), parts)
        levels.append(_staged(pairs, f"{folder}/frequent_pairs"))
    if max_words > 2:
        longer = _mine(mined, max_words - 1, _longer(share(_bitmap(levels[1], max_bits, True)), max_words), parts)
        levels.append(_staged(longer, f"{folder}/frequent_longer"))
    candidates = levels[0]
    for level in levels[1:]:
        candidates = candidates.unionByName(level)
    exact = _count_exactly(rows, share(_bitmap(candidates, max_bits, False)), max_words)
    found = exact.groupBy("lang", "size", "phrase").agg(F.sum("n").alias("f")).filter(F.col("f") >= support)
    names = docs.select(lang.alias("lang")).distinct().withColumn("salt", F.xxhash64("lang"))
    return _staged(found, f"{folder}/frequent"), names.join(totals, "salt").select("lang", F.col("all_words").alias("n"))


# floor(2000000 a / (l + r)); the product may pass 64 bits
_SCORE = "CAST((CAST(a AS DECIMAL(20, 0)) * CAST(2000000 AS DECIMAL(7, 0))) div CAST(l + r AS DECIMAL(20, 0)) AS BIGINT)"
_PARTS = "transform(sequence(2, size - 1), m -> transform(sequence(1, size - m + 1), s -> array_join(slice(w, s, m), ' ')))"


def scored(frequent: DataFrame, cover_percent: int) -> DataFrame:
    """(lang, phrase, a, l, r, score): candidates by their lowest cut, without those that a longer one covers."""
    phrases = frequent.filter("size > 1").select("lang", "phrase", F.col("f").alias("a"), "size", F.split("phrase", " ").alias("w"))
    cuts = phrases.select("lang", "phrase", "a", "size", "w", F.explode(F.expr("sequence(1, size - 1)")).alias("k")).selectExpr(
        "lang", "phrase", "a", "k", "array_join(slice(w, 1, k), ' ') AS head", "array_join(slice(w, k + 1, size - k), ' ') AS tail"
    )
    known = frequent.select("lang", "phrase", "f")
    heads, tails = known.toDF("lang", "head", "l"), known.toDF("lang", "tail", "r")
    best = (
        cuts.join(heads, ["lang", "head"])
        .join(tails, ["lang", "tail"])
        .withColumn("score", F.expr(_SCORE))
        .groupBy("lang", "phrase", "a")
        .agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    )
    covers = (
        phrases.filter("size > 2")
        .select("lang", "a", F.explode(F.flatten(F.expr(_PARTS))).alias("phrase"))
        .groupBy("lang", "phrase")
        .agg(F.max("a").alias("longer"))
    )
    free = best.join(covers, ["lang", "phrase"], "left").filter(
        F.col("longer").isNull() | (100 * F.col("longer") < cover_percent * F.col("a"))
    )
    return free.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")


def top_collocations(
    docs: DataFrame,
    support: int = 30,
    max_words: int = 4,
    top: int = 2000,
    cover_percent: int = 80,
    shards: int = 4,
    lang_col: str = "lang",
    text_col: str = "text",
) -> DataFrame:
    """Each language's ``top`` phrases: lang, rank, phrase, a, l, r, n, score."""
    folder = shared_root(docs.sparkSession)
    frequent, totals = frequent_phrases(docs, folder, support, max_words, shards, lang_col=lang_col, text_col=text_col)
    order = "ORDER BY score DESC, a DESC, phrase"
    # first within parts of a language, so that only their best rows meet
    parts = scored(frequent, cover_percent).withColumn("part", F.expr("pmod(xxhash64(phrase), 64)"))
    inner = parts.withColumn("rank", F.expr(f"row_number() OVER (PARTITION BY lang, part {order})")).filter(F.col("rank") <= top)
    ranked = inner.withColumn("rank", F.expr(f"CAST(row_number() OVER (PARTITION BY lang {order}) AS BIGINT)")).filter(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
