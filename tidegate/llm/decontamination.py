"""Benchmark decontamination by the q-gram lemma.

A benchmark item of m characters that occurs in a text with at most k edits shares at least
T = m - q + 1 - k * q of its q-grams with it, all on neighbouring diagonals (place in the text minus
place in the item): k edits move the alignment by at most k. Diagonals are therefore counted in
bands of 2 (k + 1), each half overlapped by the next, so that every window of k + 1 diagonals lies
whole in some band. Bands with fewer than T shared q-grams cannot hold the item; the others are
verified by an alignment banded to these diagonals and k more on either side.

Texts and items are compared case-folded, with runs of white space as one blank. The edit budget is
``edit_share`` of the item, lowered where the lemma would need fewer than ``MIN_SHARED`` q-grams.
Items shorter than ``MIN_CHARS`` have too few q-grams of that size. They are searched for without edits, each
as one gram of its own length, and have to stand free: in scripts that set words apart, not within
a longer word. ``min_letters`` leaves out items with fewer letters and digits (none by default).

The benchmark is the stated query set. It is read in blocks of at most ``block_chars`` characters
(one longer item is a block of its own), and the documents are passed once for each block; a block's
text is all that is sent to the tasks. No document leaves its task.

Defined cases: null and empty texts or items match nothing; an empty benchmark or document table
gives no match; repeated documents and items match as often as given; among equal regions of a
document and item the one with fewest edits, then the first, is reported.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

Q = 8  # as many as bytes in a word
MIN_CHARS = 9  # for MIN_SHARED q-grams; under 17 characters items are searched for without edits
MIN_SHARED = 2
EDIT_SHARE = 0.1
CHARS = 1 << 19  # of texts looked at together
ROWS = 512  # texts taken out of a batch together
MIX = np.uint64(0x9E3779B97F4A7C15)
SPAN = 1 << 20  # start places in a cost, see _align


def normal(text: str) -> str:
    return " ".join(text.lower().split())


def points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def _codes(chars: np.ndarray) -> np.ndarray:
    """Each q-gram as one number. Characters count by one byte; equal q-grams stay equal."""
    folded = _folded(chars)
    n = max(0, len(folded) - Q + 1)
    return np.ndarray((n,), "<u8", buffer=folded.tobytes(), strides=(1,)).copy() if n else np.empty(0, np.uint64)


def budget(m: int, edit_share: float) -> int:
    return max(0, min(int(edit_share * m), (m - Q + 1 - MIN_SHARED) // Q))


@dataclass(frozen=True)
class Index:
    """The q-grams of a block of items."""

    items: list[np.ndarray]
    edits: np.ndarray  # budget k of every item
    shared: np.ndarray  # T of every item
    grams: np.ndarray  # sorted, different
    first: np.ndarray  # of each gram in item and place
    item: np.ndarray
    place: np.ndarray
    bits: int
    hit: np.ndarray  # which hashes some gram has
    short: dict[int, tuple[np.ndarray, np.ndarray]]  # by length: sorted codes of short items, and the items


@lru_cache(maxsize=2)
def index_of(texts: tuple[str, ...], edit_share: float, min_letters: int = 0) -> Index:
    normals = [normal(t) for t in texts]
    items = [points(t if sum(map(str.isalnum, t)) >= min_letters else "") for t in normals]
    edits = np.array([budget(len(x), edit_share) for x in items], np.int64)
    shared = np.array([len(x) - Q + 1 - k * Q for x, k in zip(items, edits)], np.int64)
    use = [k for k, x in enumerate(items) if len(x) >= MIN_CHARS]
    parts = [_codes(items[k]) for k in use]
    codes = np.concatenate(parts) if parts else np.empty(0, np.uint64)
    item = np.concatenate([np.full(len(p), k) for k, p in zip(use, parts)]) if parts else np.empty(0, np.int64)
    place = np.concatenate([np.arange(len(p)) for p in parts]) if parts else np.empty(0, np.int64)
    order = np.argsort(codes, kind="stable")
    grams, first = np.unique(codes[order], return_index=True)
    bits = max(16, int(len(grams) * 16).bit_length())
    hit = np.zeros(1 << bits, bool)
    hit[(grams * MIX) >> np.uint64(64 - bits)] = True
    short = {}
    for m in range(1, MIN_CHARS):
        own = np.array([k for k, x in enumerate(items) if len(x) == m], np.int64)
        if len(own):
            eight = np.concatenate([_eights(items[k])[:1] for k in own]) & _mask(m)
            sort = np.argsort(eight, kind="stable")
            short[m] = eight[sort], own[sort]
    return Index(items, edits, shared, grams, np.append(first, len(codes)), item[order], place[order], bits, hit, short)


def _mask(m: int) -> np.uint64:
    return np.uint64((1 << 8 * m) - 1)


def _folded(chars: np.ndarray) -> np.ndarray:
    return (chars ^ (chars >> 8) * 151 ^ (chars >> 16) * 29).astype(np.uint8)


def _eights(chars: np.ndarray) -> np.ndarray:
    """The folded bytes of eight characters from every place on; zero behind the end."""
    wide = np.concatenate((_folded(chars), np.zeros(Q, np.uint8)))
    return np.ndarray((len(chars),), "<u8", wide, 0, (1,))


def _spaced(chars: np.ndarray) -> np.ndarray:
    """Letters and digits of scripts that set words apart."""
    return ((chars >= 48) & (chars <= 57)) | ((chars >= 97) & (chars <= 122)) | ((chars >= 0xC0) & (chars < 0x2000))


def short_matches(chars: np.ndarray, starts: np.ndarray, stops: np.ndarray, index: Index) -> Iterator[tuple[int, int, int, int, int]]:
    """(text, item, 0, start, stop) of the first free-standing place of every short item in every text."""
    if not index.short or not len(chars):
        return
    eights = _eights(chars)
    word = np.concatenate(([False], _spaced(chars), [False]))
    for m, (codes, items) in index.short.items():
        own = eights & _mask(m)
        at = np.flatnonzero(codes[np.minimum(np.searchsorted(codes, own), len(codes) - 1)] == own)
        lo, hi = np.searchsorted(codes, own[at]), np.searchsorted(codes, own[at], side="right")
        item = items[np.repeat(lo - (np.cumsum(hi - lo) - (hi - lo)), hi - lo) + np.arange(int((hi - lo).sum()))]
        at = np.repeat(at, hi - lo)
        text = np.searchsorted(starts, at, side="right") - 1
        fits = at + m <= stops[text]
        at, item, text = at[fits], item[fits], text[fits]
        if not len(at):
            continue
        letters = chars[at[:, None] + np.arange(m)]
        same = (letters == np.stack([index.items[i] for i in item])).all(axis=1)
        begun = word[at] & word[at + 1] & (at > starts[text])
        goes_on = word[at + m] & word[at + m + 1] & (at + m < stops[text])
        keep = np.flatnonzero(same & ~begun & ~goes_on)
        if not len(keep):
            continue
        for k in keep[np.unique(np.stack((text[keep], item[keep]), 1), axis=0, return_index=True)[1]]:
            begin = int(at[k] - starts[text[k]])
            yield int(text[k]), int(item[k]), 0, begin, begin + m


def candidates(chars: np.ndarray, starts: np.ndarray, index: Index) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, item, lowest diagonal) of the bands with enough shared q-grams; texts begin at ``starts``."""
    none = (np.empty(0, np.int64),) * 3
    if not len(index.grams):
        return none
    codes = _codes(chars)
    at = np.flatnonzero(index.hit[(codes * MIX) >> np.uint64(64 - index.bits)])
    if not len(at):
        return none
    found = np.minimum(np.searchsorted(index.grams, codes[at]), len(index.grams) - 1)
    same = index.grams[found] == codes[at]
    if not same.any():
        return none
    at, found = at[same], found[same]
    copies = index.first[found + 1] - index.first[found]
    where = np.repeat(index.first[found] - (np.cumsum(copies) - copies), copies) + np.arange(copies.sum())
    at, item, place = np.repeat(at, copies), index.item[where], index.place[where]
    longest = max(map(len, index.items))
    half = (at - place + longest) // (index.edits[item] + 1) + 1
    # A diagonal lies in the band that begins in its half and in the one before. First all hits of
    # a band are counted, by sorting one number each; few bands have enough.
    halves = int(half.max()) + 1
    band = np.concatenate((item * halves + half, item * halves + half - 1))
    order = np.sort(band)
    begin = np.flatnonzero(np.concatenate(([True], order[1:] != order[:-1])))
    counts, keys = np.diff(np.append(begin, len(order))), order[begin]
    keys = keys[counts >= index.shared[keys // halves]]
    if not len(keys):
        return none
    known = keys[np.minimum(np.searchsorted(keys, band), len(keys) - 1)] == band
    hit = np.flatnonzero(known) % len(at)
    # then, in these, the different places of the item, text by text
    text = np.searchsorted(starts, at[hit], side="right") - 1
    rows = np.unique(np.stack((text, band[known], place[hit]), 1), axis=0)
    begin = np.flatnonzero(np.concatenate(([True], (rows[1:, :2] != rows[:-1, :2]).any(axis=1))))
    text, band = rows[begin, 0], rows[begin, 1]
    item, half = np.divmod(band, halves)
    enough = np.diff(np.append(begin, len(rows))) >= index.shared[item]
    low = (half - 1) * (index.edits[item] + 1) - longest
    return text[enough], item[enough], low[enough]


def _align(chars: np.ndarray, begins: np.ndarray, ends: np.ndarray, items: list[np.ndarray], lows: np.ndarray, edits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Fewest edits (or edits + 1 if more), start and stop of items of one length in their texts.

    One row per item character, one column per diagonal from ``lows - edits`` to
    ``lows + 3 edits + 1``; all candidates at once. A cost carries its start place in the low digits,
    so that the least cost is also the first start.
    """
    item = np.stack(items)
    n, m = item.shape
    width = 4 * edits + 2
    left = lows - edits
    columns = np.arange(width)
    cost = np.broadcast_to(columns.astype(np.int64), (n, width)).copy()  # free start on every diagonal
    step = columns * SPAN
    # the texts' characters under the band; outside a text every character differs
    place = left[:, None] + np.arange(width + m)
    inside = (place >= begins[:, None]) & (place < ends[:, None])
    letters = np.where(inside, chars[np.where(inside, place, 0)], np.uint32(0xFFFFFFFF))
    for row in range(m):
        change = cost + (letters[:, row : row + width] != item[:, row : row + 1]) * np.int64(SPAN)
        np.minimum(change[:, :-1], cost[:, 1:] + SPAN, out=change[:, :-1])  # item character left out
        change -= step
        cost = np.minimum.accumulate(change, axis=1) + step  # text character put in
    best = cost.argmin(axis=1)
    value = cost[np.arange(n), best]
    return value // SPAN, left + value % SPAN, left + best + m


def verify(chars: np.ndarray, starts: np.ndarray, stops: np.ndarray, found: tuple, index: Index, group: int = 256) -> list[tuple[int, int, int, int, int]]:
    """(text, item, edits, start, stop) of the candidates within budget, the best one per text and item."""
    text, item, low = found
    best: dict[tuple[int, int], tuple[int, int, int]] = {}
    lengths = np.array([len(x) for x in index.items], np.int64)
    for m in np.unique(lengths[item]):
        own = np.flatnonzero(lengths[item] == m)
        for at in range(0, len(own), group):
            k = own[at : at + group]
            edits = int(index.edits[item[k[0]]])
            cost, begin, end = _align(chars, starts[text[k]], stops[text[k]], [index.items[i] for i in item[k]], low[k], edits)
            for c, t, i, b, e in zip(cost.tolist(), text[k].tolist(), item[k].tolist(), begin.tolist(), end.tolist()):
                if c <= edits:
                    region = (c, max(b, int(starts[t])) - int(starts[t]), min(e, int(stops[t])) - int(starts[t]))
                    best[t, i] = min(best.get((t, i), region), region)
    return [(t, i, *region) for (t, i), region in sorted(best.items())]


def search_batch(texts: pa.Array, index: Index) -> Iterator[tuple[int, int, int, int, int]]:
    """``search`` over an Arrow column, some rows at a time."""
    for at in range(0, len(texts), ROWS):
        for text, *rest in search(texts.slice(at, ROWS).to_pylist(), index):
            yield at + text, *rest


def search(texts: list[str | None], index: Index) -> Iterator[tuple[int, int, int, int, int]]:
    """(text, item, edits, start, stop) for all texts; places are those of the normal text."""
    at, parts, size = 0, [], 0
    for k, text in enumerate(texts):
        parts.append(normal(text or ""))
        size += len(parts[-1])
        if size >= CHARS or k == len(texts) - 1:
            chars = points("\0".join(parts))
            lengths = np.fromiter(map(len, parts), np.int64, len(parts))
            starts = np.cumsum(lengths + 1) - lengths - 1
            stops = starts + lengths
            for t, *rest in verify(chars, starts, stops, candidates(chars, starts, index), index):
                yield at + t, *rest
            for t, *rest in short_matches(chars, starts, stops, index):
                yield at + t, *rest
            at, parts, size = k + 1, [], 0


# --- on Spark ---------------------------------------------------------------------


def benchmark_blocks(benchmark: DataFrame, id_col: str, text_col: str, block_chars: int) -> Iterator[tuple[list, tuple[str, ...]]]:
    """(ids, texts) of consecutive items, at most ``block_chars`` characters at a time."""
    ids, texts, size = [], [], 0
    items = benchmark.filter(F.col(text_col).isNotNull()).select(id_col, text_col)
    for item, text in items.toLocalIterator():
        if texts and size + len(text) > block_chars:
            yield ids, tuple(texts)
            ids, texts, size = [], [], 0
        ids.append(item)
        texts.append(text)
        size += len(text)
    if texts:
        yield ids, tuple(texts)


def matches(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    edit_share: float = EDIT_SHARE,
    block_chars: int = 1 << 20,
    min_letters: int = 0,
) -> DataFrame:
    """doc_id, item_id, edits, start, stop: one row for every item found in a document."""
    picked = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    schema = picked.schema["doc_id"].dataType.simpleString()
    kind = to_arrow_type(benchmark.schema[item_col].dataType)
    schema = f"doc_id {schema}, item_id {benchmark.schema[item_col].dataType.simpleString()}, edits int, start bigint, stop bigint"

    def one(ids: list, texts: tuple[str, ...]) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = index_of(texts, edit_share, min_letters)
            for batch in batches:
                rows = list(search_batch(batch.column(1), index))
                text, item, edits, start, stop = zip(*rows) if rows else ((),) * 5
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(text, pa.int64())),
                        pa.array([ids[i] for i in item], kind),
                        pa.array(edits, pa.int32()),
                        pa.array(start, pa.int64()),
                        pa.array(stop, pa.int64()),
                    ],
                    ["doc_id", "item_id", "edits", "start", "stop"],
                )

        return picked.mapInArrow(run, schema)

    parts = [one(*block) for block in benchmark_blocks(benchmark, item_col, item_text_col, block_chars)]
    return reduce(DataFrame.unionAll, parts) if parts else docs.sparkSession.createDataFrame([], schema)


def remove(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    edit_share: float = EDIT_SHARE,
    block_chars: int = 1 << 20,
    min_letters: int = 0,
) -> DataFrame:
    """``docs`` without the rows in whose text some item occurs."""
    place = docs.columns.index(text_col)

    def one(frame: DataFrame, texts: tuple[str, ...]) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = index_of(texts, edit_share, min_letters)
            for batch in batches:
                clean = np.ones(batch.num_rows, bool)
                clean[[row[0] for row in search_batch(batch.column(place), index)]] = False
                yield batch.filter(pa.array(clean))

        return frame.mapInArrow(run, frame.schema)

    blocks = benchmark_blocks(benchmark, item_col, item_text_col, block_chars)
    return reduce(lambda frame, block: one(frame, block[1]), blocks, docs)
