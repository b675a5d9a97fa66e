"""Texts of a batch as one byte array, and hashed features of it, for tasks that work in numpy.

Working memory depends on ``LIMIT``, not on the length of a text: longer texts are cut at blanks
into parts, whose sums are added up again by document.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

LIMIT = 1 << 19  # bytes looked at together
GAP = b"    "  # blanks between texts, so that no n-gram of up to five bytes spans two of them

_BYTES = np.arange(256)
LETTER = ((_BYTES | 32) >= 97) & ((_BYTES | 32) <= 122) & (_BYTES < 128) | (_BYTES >= 128)
UPPER = (_BYTES >= 65) & (_BYTES <= 90)
FOLDED = np.where(UPPER, _BYTES + 32, np.where(LETTER, _BYTES, 32)).astype(np.uint8)  # lower case, else blank
MIX = np.uint64(0x9E3779B97F4A7C15)  # 2^64 / golden ratio, as in Fibonacci hashing


class Block:
    """Some texts (or parts of long ones) side by side: ``data``, with text k at starts[k]:stops[k].

    ``docs`` numbers the texts, ``begins`` tells where in its text a part begins.
    """

    def __init__(self, docs: list[int], begins: list[int], parts: list[bytes]):
        self.docs, self.begins = np.array(docs, np.int64), np.array(begins, np.int64)
        self.data = np.frombuffer(GAP + GAP.join(parts) + GAP, np.uint8)
        sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        self.starts = len(GAP) + np.cumsum(sizes + len(GAP)) - sizes - len(GAP)
        self.stops = self.starts + sizes

    def sums(self, values: np.ndarray) -> np.ndarray:
        """Of one value per byte, the sum over each text, with the blank before it."""
        edges = np.stack((self.starts - 1, self.stops), 1).ravel()
        return np.add.reduceat(values, edges)[::2].astype(np.float64)


def blocks(texts: pa.Array, limit: int = LIMIT) -> Iterator[Block]:
    """All texts in order; a null text is an empty one."""
    docs, begins, parts, held = [], [], [], 0
    for k, text in enumerate(texts.cast(pa.binary())):
        data = text.as_py() or b""
        lo = 0
        while True:
            hi = len(data)
            if hi - lo > limit:
                cut = data.rfind(b" ", lo + 1, lo + limit)
                hi = cut if cut > lo else lo + limit
            docs.append(k)
            begins.append(lo)
            parts.append(data[lo:hi])
            held += hi - lo
            if held >= limit or len(parts) >= 1 << 14:
                yield Block(docs, begins, parts)
                docs, begins, parts, held = [], [], [], 0
            lo = hi
            if lo >= len(data):
                break
    if parts:
        yield Block(docs, begins, parts)


def slices(batches: Iterable[pa.RecordBatch], rows: int = 1024) -> Iterator[pa.RecordBatch]:
    """The batches in slices, so that rows on their way back take little memory on either side."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def grams(symbols: np.ndarray, size: int, bits: int, width: int = 8) -> np.ndarray:
    """A bucket (below 2^bits) for the ``size`` symbols from each place on; wraps round at the end."""
    code = np.full(len(symbols), size, np.uint64)
    for k in range(size):
        code = (code << np.uint64(width)) | np.roll(symbols, -k)
    return ((code * MIX) >> np.uint64(64 - bits)).astype(np.int32)


_tables: list[np.ndarray] = []  # the longest powers made so far, kept by the worker


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """At least n powers of an odd number and of its inverse modulo 2^64."""
    if _tables and len(_tables[0]) >= n:
        return _tables[0], _tables[1]
    base, n = 0xD1342543DE82EF95, max(n, LIMIT + LIMIT // 4)
    up, down = np.full(n, base, np.uint64), np.full(n, pow(base, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    made = [np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)]
    if n <= 4 * LIMIT:  # texts of no usual size leave nothing behind
        _tables[:] = made
    return made[0], made[1]


def words(data: np.ndarray, prefixes: tuple[int, ...] = ()) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(start, stop, 64-bit hashes, valid) of every run of letters, case folded for A-Z.

    Hashes has a column for the whole word and one for each prefix length in bytes; valid tells
    which words are longer than the prefix.
    """
    letter = np.concatenate(([False], LETTER[data], [False]))
    edges = np.flatnonzero(letter[1:] != letter[:-1])
    start, stop = edges[::2], edges[1::2]
    up, down = _powers(len(data) + 1)
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum((FOLDED[data].astype(np.uint64) + np.uint64(1)) * up[: len(data)], dtype=np.uint64)))
    ends = np.stack([stop, *[np.minimum(start + k, stop) for k in prefixes]], 1)
    valid = np.stack([np.ones(len(start), bool), *[start + k < stop for k in prefixes]], 1)
    mark = (total[ends] - total[start][:, None]) * down[start][:, None] + np.arange(len(prefixes) + 1, dtype=np.uint64)
    mark = (mark ^ (mark >> np.uint64(29))) * MIX
    return start, stop, mark ^ (mark >> np.uint64(32)), valid


def sample_share(rows: int, wanted: int) -> float:
    """Which share of hashes gives ``wanted`` of ``rows``."""
    return 1.0 if rows <= wanted else wanted / rows
