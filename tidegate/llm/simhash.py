"""SimHash fingerprints and near-duplicate groups by bit-sliced comparison.

Fingerprint: the majority, per bit, of the XXH64 hashes of all word shingles of a text. Two texts
link when their fingerprints differ in at most ``radius`` bits; a group is a connected component.

How pairs are found without comparing everything: the 64 bits are cut into ``blocks`` pieces. Two
fingerprints within the radius agree on at least ``blocks - radius`` whole pieces, so every such
choice of pieces is a table keyed by the agreeing bits. Equal texts are reduced to one
fingerprint first. Within a key the fingerprints are compared by bit slices (``near_links``), and
only links that join two groups of the key are passed on, so a key of m members gives at most
m - 1 links. A key with more than ``bucket_limit`` members is dealt out as pairs of chunks, which
compares the same pairs in many tasks.

More pieces make keys longer and fuller tables rarer: 5 (10 tables of 26 bits) fit up to about a
thousand million different texts, 6 (20 tables of 32 bits) some hundred times as many. The result
is the same for every choice.

Defined cases: a null or blank text has fingerprint zero and links like any other; a text of fewer
words than a shingle is one shingle; rows with a null id take part, but never name a group unless
no member has an id; repeated rows are returned as often as given; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tidegate.state.shared import shared_root, stage

BITS = 64
SEED = 42
EDGES_A_TASK = 1 << 16


# --- fingerprints -----------------------------------------------------------------


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """``bytes.lower`` and ``bytes.split`` know exactly A-Z and the six ASCII white spaces."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, SEED)
    stops = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], stops[:-1] + 1))[: len(words) - shingle + 1].tolist()
    stops = stops[shingle - 1 :].tolist()
    pieces = map(joined.__getitem__, map(slice, starts, stops))
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, pieces, repeat(SEED)), np.uint64, len(starts))
    ones = np.zeros(BITS, np.int64)
    for part in np.split(hashes, range(1 << 15, len(hashes), 1 << 15)):  # bounded however long the text
        bits = np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """doc_id and fp, the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            marks = np.fromiter((fingerprint(t.as_py() or b"", shingle) for t in texts), np.uint64, len(texts))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(marks.view(np.int64))], ["doc_id", "fp"])

    picked = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = picked.schema["doc_id"].dataType.simpleString()
    return picked.mapInArrow(run, f"doc_id {kind}, fp bigint")


# --- bit-sliced comparison --------------------------------------------------------


def _pack(flags: np.ndarray) -> np.ndarray:
    """Booleans (last axis) as 64-bit words, with one spare word at the end."""
    wide = np.zeros((*flags.shape[:-1], (flags.shape[-1] // BITS + 2) * BITS), np.uint8)
    wide[..., : flags.shape[-1]] = flags
    return np.packbits(wide, axis=-1, bitorder="little").view("<u8")


def _unpack(words: np.ndarray) -> np.ndarray:
    return np.unpackbits(words.astype("<u8").view(np.uint8), bitorder="little").astype(bool)


def near_links(fps: np.ndarray, groups: np.ndarray, radius: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect all fingerprints within ``radius`` bits of each other in the same group.

    ``groups`` marks equal neighbours as one group. The fingerprints are lanes of 64 bit planes.
    Step s compares every lane with the lane s places on, all at once: the differing bits of plane
    after plane go into carry-save counters that start so that they overflow beyond the radius,
    and words of 64 lanes that have all overflowed are given up. Groups lie in order of falling
    size, so later steps touch ever fewer words. Returned as positions (member, root).
    """
    n = len(fps)
    if n < 2:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    first = np.flatnonzero(np.concatenate(([True], groups[1:] != groups[:-1])))
    sizes = np.diff(np.concatenate((first, [n])))
    by_size = np.argsort(-sizes, kind="stable")
    sizes = sizes[by_size]
    lane_size = np.repeat(sizes, sizes)
    starts = np.cumsum(sizes) - sizes
    place = np.arange(n) - np.repeat(starts, sizes)
    source = np.repeat(first[by_size], sizes) + place  # lane -> position in the input
    lanes = fps[source].astype(np.uint64)
    bits = np.unpackbits(lanes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    planes = _pack(np.ascontiguousarray(bits.T))
    n_counters = max(1, int(radius).bit_length())
    begin = (1 << n_counters) - (radius + 1)  # counters overflow at radius + 1 differences
    parent = np.arange(n)
    full = np.uint64(0xFFFFFFFFFFFFFFFF)
    for step in range(1, int(sizes[0])):
        count = int(np.searchsorted(-lane_size, -step, side="left"))  # lanes of groups larger than step
        open_lanes = _pack((place[:count] + step) < lane_size[:count])[: count // BITS + 1]
        alive = np.flatnonzero(open_lanes)
        word, bit = divmod(step, BITS)
        over = ~open_lanes[alive]
        counters = [np.full(len(alive), full if begin >> k & 1 else 0, np.uint64) for k in range(n_counters)]
        for plane in range(BITS):
            row = planes[plane]
            low = np.take(row, alive + word, mode="clip")
            if bit:
                high = np.take(row, alive + word + 1, mode="clip")
                low = (low >> np.uint64(bit)) | (high << np.uint64(BITS - bit))
            carry = low ^ row[alive]
            for k in range(n_counters):
                counters[k], carry = counters[k] ^ carry, counters[k] & carry
            over |= carry
            if plane % 4 == 3:
                keep = over != full
                if not keep.all():
                    alive, over = alive[keep], over[keep]
                    counters = [c[keep] for c in counters]
                    if not len(alive):
                        break
        if len(alive):
            near = _unpack(~over).reshape(-1, BITS)
            at, lane = np.nonzero(near)
            left = alive[at] * BITS + lane
            parent = _join(parent, left, left + step)
    member = np.flatnonzero(parent != np.arange(n))
    return source[member], source[parent[member]]


def _join(parent: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Union by smallest lane; ``parent`` always points straight to the root."""
    a, b = parent[left], parent[right]
    apart = a != b
    if not apart.any():
        return parent
    for x, y in np.unique(np.stack((a[apart], b[apart]), 1), axis=0).tolist():
        while parent[x] != x:
            x = parent[x]
        while parent[y] != y:
            y = parent[y]
        parent[max(x, y)] = min(x, y)
    while True:
        flat = parent[parent]
        if (flat == parent).all():
            return flat
        parent = flat


# --- links between all fingerprints -----------------------------------------------


def table_keys(fp: Column, radius: int, blocks: int) -> Column:
    """One long per table: the table's number and the bits of its pieces, hashed where they are many."""
    edges = [BITS * k // blocks for k in range(blocks + 1)]
    masks = [((1 << (hi - lo)) - 1) << lo for lo, hi in zip(edges, edges[1:])]
    keys = []
    for number, chosen in enumerate(combinations(range(blocks), blocks - radius)):
        mask = sum(masks[k] for k in chosen)
        keys.append(F.xxhash64(F.lit(number), fp.bitwiseAND(F.lit(mask - (mask >> 63 << 64)))))
    return F.array(*keys)


def links(
    distinct: DataFrame, folder: str, radius: int = 3, blocks: int = 5, bucket_limit: int = 4096, batch: int = 1 << 17
) -> DataFrame:
    """Columns a, b: links among the distinct fingerprints ``fp`` that keep every component whole."""
    keyed = distinct.select("fp", F.explode(table_keys(F.col("fp"), radius, blocks)).alias("key"))
    sizes = keyed.groupBy("key").count().filter(F.col("count") > bucket_limit)
    hot = stage(sizes.select("key", F.ceil(F.col("count") / bucket_limit).alias("chunks")), f"{folder}/hot")
    # a hot key's members meet those of every other chunk once; elsewhere there is one cell
    chunk = F.pmod(F.xxhash64("fp"), "chunks")
    cells = F.transform(
        F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1),
        lambda other: F.least(other, chunk) * F.col("chunks") + F.greatest(other, chunk),
    )
    dealt = keyed.join(hot, "key", "left").select(
        "fp", "key", F.explode(F.when(F.col("chunks").isNull(), F.array(F.lit(0).cast("long"))).otherwise(cells)).alias("cell")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(fps: np.ndarray, group: np.ndarray) -> pa.RecordBatch:
            again = np.concatenate(([False], group[1:] == group[:-1]))
            again[:-1] |= again[1:]  # a key with one member has no pair
            fps, group = fps[again], group[again]
            a, b = near_links(fps.view(np.uint64), group, radius)
            return pa.RecordBatch.from_arrays([pa.array(fps[a]), pa.array(fps[b])], ["a", "b"])

        fps = np.empty(0, np.int64)
        keys = np.empty((0, 2), np.int64)
        for arrived in batches:
            fps = np.concatenate((fps, arrived.column(0).to_numpy(zero_copy_only=False)))
            keys = np.concatenate((keys, np.stack([arrived.column(k).to_numpy(zero_copy_only=False) for k in (1, 2)], 1)))
            if len(fps) < batch:
                continue
            new = np.concatenate(([True], (keys[1:] != keys[:-1]).any(axis=1)))
            cut = int(np.flatnonzero(new)[-1])  # the last key may go on in the next batch
            if cut:
                yield found(fps[:cut], np.cumsum(new[:cut]))
                fps, keys = fps[cut:], keys[cut:]
        if len(fps):
            new = np.concatenate(([True], (keys[1:] != keys[:-1]).any(axis=1)))
            yield found(fps, np.cumsum(new))

    grouped = dealt.repartition("key", "cell").sortWithinPartitions("key", "cell")
    return stage(grouped.mapInArrow(run, "a bigint, b bigint").distinct(), f"{folder}/links")


# --- components -------------------------------------------------------------------


def components(edges: DataFrame, folder: str) -> DataFrame:
    """node, root for every node of ``edges`` (a, b): root is the component's smallest node.

    Alternating large-star and small-star steps (Kiveris et al., 2014): every step moves edges
    towards smaller nodes and the work stays proportional to the edges. Each step is a written
    table; its row count and a checksum are observed while it is written. A task takes up to
    ``EDGES_A_TASK`` edges, so a handful of edges needs no shuffle.
    """
    made = 0

    def write(frame: DataFrame) -> tuple[DataFrame, tuple]:
        nonlocal made
        made += 1
        seen = Observation()
        check = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        out = stage(frame.distinct().observe(seen, F.count("*").alias("rows"), check.alias("check")), f"{folder}/step-{made}")
        return out.coalesce(max(1, -(-seen.get["rows"] // EDGES_A_TASK))), (seen.get["rows"], seen.get["check"])

    turned = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    current, before = write(turned.filter("a <> b"))
    while before[0]:
        both = current.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("e")).select("e.*")
        lowest = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large, _ = write(both.filter("b > a").join(lowest, "a").select(F.col("b").alias("a"), F.col("m").alias("b")))
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(lowest, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
        current, after = write(small.select("e.*").filter("a <> b"))
        if after == before:
            break
        before = after
    roots = current.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 3,
    radius: int = 3,
    blocks: int = 5,
    bucket_limit: int = 4096,
) -> DataFrame:
    """doc_id, fp (signed long) and component_id of every row of ``docs``."""
    folder = shared_root(docs.sparkSession)
    marked = stage(fingerprints(docs, id_col, text_col, shingle), f"{folder}/fingerprints")
    distinct = stage(marked.groupBy("fp").agg(F.min("doc_id").alias("first_id")), f"{folder}/distinct")
    edges = links(distinct, folder, radius, blocks, bucket_limit)
    roots = components(edges, folder)
    owned = distinct.join(roots, distinct["fp"] == roots["node"], "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root"))
    smallest = owned.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = stage(owned.join(smallest, "root").select("fp", "component_id"), f"{folder}/named")
    return marked.join(named, "fp").select("doc_id", "fp", "component_id")


def hex_digits(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
