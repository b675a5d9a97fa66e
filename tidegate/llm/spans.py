"""Words of texts as byte spans, their XXH64 hashes, and an open-addressed table that interns them.

Everything works on numpy arrays over the UTF-8 bytes of some texts at a time. Working memory follows
``limit`` and the longest word, not the longest text: longer texts are cut between words.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash

LIMIT = 1 << 20  # bytes looked at together
_PAD = b"\n" * 40  # so that eight bytes can be read from every place
_CODES = np.arange(256)
LOWERED = np.where((_CODES >= 65) & (_CODES <= 90), _CODES + 32, _CODES).astype(np.uint8)  # A-Z only


def byte_class(outside: bytes) -> np.ndarray:
    """Which bytes belong to words: all but those named (a class of ASCII characters)."""
    inside = np.ones(256, bool)
    inside[list(outside)] = False
    return inside


class Words:
    """The words of some texts: ``data`` (A-Z lowered), spans, number of their text, and whether they are new.

    A word that is not new was seen in the part before; it only serves runs of words that cross the cut.
    """

    def __init__(self, docs: list[int], parts: list[bytes], news: list[int], inside: np.ndarray):
        self.data = LOWERED[np.frombuffer(b"\n" + b"\n".join(parts) + _PAD, np.uint8)]
        sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        begins = 1 + np.cumsum(sizes + 1) - sizes - 1
        mask = inside[self.data]
        edges = np.flatnonzero(mask[1:] != mask[:-1]) + 1
        self.start, self.stop = edges[::2], edges[1::2]
        part = np.searchsorted(begins, self.start, "right") - 1
        self.doc = np.array(docs, np.int64)[part]
        self.new = self.start >= (begins + np.array(news, np.int64))[part]

    def __len__(self) -> int:
        return len(self.start)

    def spaced(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(bytes, start, stop) of the words set one blank apart."""
        sizes = self.stop - self.start + 1
        stop = np.cumsum(sizes) - 1
        start = stop + 1 - sizes
        source = np.repeat(self.start - start, sizes) + np.arange(int(sizes.sum()))
        data = np.concatenate((self.data[source], np.frombuffer(_PAD, np.uint8)))
        data[stop] = 32
        return data, start, stop


def word_blocks(texts: Iterable[bytes | None], inside: np.ndarray, carry: int = 0, limit: int = LIMIT) -> Iterator[Words]:
    """The words of the texts, whole texts together up to ``limit`` bytes.

    A longer text comes in parts; each part but the first begins with the last ``carry`` words of
    the one before. ``inside`` must not hold the line feed, which parts texts.
    """
    docs: list[int] = []
    parts: list[bytes] = []
    news: list[int] = []
    held, raw = 0, inside[LOWERED]  # capitals are not lowered yet where a text is cut
    for k, text in enumerate(texts):
        lo = new = 0
        while text and new < len(text):
            hi = _cut(text, new, limit, raw)
            docs.append(k)
            parts.append(text[lo:hi])
            news.append(new - lo)
            held += hi - lo + 64
            if held >= limit:
                yield Words(docs, parts, news, inside)
                docs, parts, news, held = [], [], [], 0
            lo, new = _back(text, hi, carry, raw) if hi < len(text) else hi, hi
    if parts:
        yield Words(docs, parts, news, inside)


def _cut(text: bytes, lo: int, limit: int, inside: np.ndarray) -> int:
    """Where a part from ``lo`` on ends: before a byte outside words, or at the end of the text."""
    if len(text) - lo <= limit:
        return len(text)
    outside = np.flatnonzero(~inside[np.frombuffer(text, np.uint8, limit, lo)])
    if len(outside) and outside[-1] > 0:
        return lo + int(outside[-1])
    at = lo + limit
    while at < len(text):
        outside = np.flatnonzero(~inside[np.frombuffer(text, np.uint8, min(limit, len(text) - at), at)])
        if len(outside):
            return at + int(outside[0])
        at += limit
    return len(text)


def _back(text: bytes, cut: int, carry: int, inside: np.ndarray) -> int:
    """Where the last ``carry`` words before the cut begin."""
    if carry == 0:
        return cut
    reach = 256
    while True:
        lo = max(0, cut - reach)
        mask = np.concatenate(([False], inside[np.frombuffer(text, np.uint8, cut - lo, lo)]))
        begins = np.flatnonzero(mask[1:] & ~mask[:-1])
        if lo and len(begins) and begins[0] == 0:
            begins = begins[1:]  # may be the middle of a word
        if len(begins) >= carry:
            return lo + int(begins[-carry])
        if lo == 0:
            return 0
        reach *= 2


# --- hashes -----------------------------------------------------------------------

# the five primes of XXH64, fixed values of its definition
_P1, _P2, _P3, _P4, _P5 = map(
    np.uint64, (11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261)
)
_LONG = 256  # spans of more bytes are hashed and compared one by one


def _turn(x: np.ndarray, bits: int) -> np.ndarray:
    return (x << np.uint64(bits)) | (x >> np.uint64(64 - bits))


def _round(acc: np.ndarray, lane: np.ndarray) -> np.ndarray:
    return _turn(acc + lane * _P2, 31) * _P1


def _eights(data: np.ndarray) -> np.ndarray:
    """The eight bytes from every place on, as a number (a view, nothing is copied)."""
    return np.ndarray(len(data) - 7, "<u8", data, 0, (1,))


def mixed(h: np.ndarray) -> np.ndarray:
    """The last steps of XXH64: every bit of the result depends on every bit given."""
    h = (h ^ (h >> np.uint64(33))) * _P2
    h = (h ^ (h >> np.uint64(29))) * _P3
    return h ^ (h >> np.uint64(32))


def xxh64(data: np.ndarray, start: np.ndarray, stop: np.ndarray, seed: int = 0) -> np.ndarray:
    """XXH64 of every span; the data must go on for eight bytes behind the last."""
    eight, size = _eights(data), stop - start
    at, left = start.copy(), size.copy()
    acc = np.full(len(start), (seed + int(_P5)) & (1 << 64) - 1, np.uint64)
    wide = np.flatnonzero((size >= 32) & (size <= _LONG))
    if len(wide):
        seeds = [seed + int(_P1) + int(_P2), seed + int(_P2), seed, seed - int(_P1)]
        lanes = [np.full(len(wide), s & (1 << 64) - 1, np.uint64) for s in seeds]
        for stripe in range(int(size[wide].max()) // 32):
            on = np.flatnonzero(size[wide] >= 32 * (stripe + 1))
            for j in range(4):
                lanes[j][on] = _round(lanes[j][on], eight[start[wide[on]] + 32 * stripe + 8 * j])
        total = _turn(lanes[0], 1) + _turn(lanes[1], 7) + _turn(lanes[2], 12) + _turn(lanes[3], 18)
        for lane in lanes:
            total = (total ^ _round(np.zeros(len(wide), np.uint64), lane)) * _P1 + _P4
        acc[wide] = total
        at[wide] += size[wide] // 32 * 32
        left[wide] %= 32
    acc += size.astype(np.uint64)
    left[size > _LONG] = 0
    for _ in range(3):
        on = np.flatnonzero(left >= 8)
        lane = _round(np.zeros(len(on), np.uint64), eight[at[on]])
        acc[on] = _turn(acc[on] ^ lane, 27) * _P1 + _P4
        at[on] += 8
        left[on] -= 8
    on = np.flatnonzero(left >= 4)
    acc[on] = _turn(acc[on] ^ ((eight[at[on]] & np.uint64(0xFFFFFFFF)) * _P1), 23) * _P2 + _P3
    at[on] += 4
    left[on] -= 4
    for _ in range(3):
        on = np.flatnonzero(left > 0)
        acc[on] = _turn(acc[on] ^ (data[at[on]].astype(np.uint64) * _P5), 11) * _P1
        at[on] += 1
        left[on] -= 1
    out = mixed(acc)
    for k in np.flatnonzero(size > _LONG):
        out[k] = xxhash.xxh64_intdigest(data[start[k] : stop[k]].tobytes(), seed)
    return out


def equal_spans(data: np.ndarray, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether the ``size`` bytes from a on are those from b on."""
    eight = _eights(data)
    spare = np.uint64(8) * (np.uint64(8) - np.minimum(size, 8).astype(np.uint64))
    out = (((eight[a] ^ eight[b]) << np.minimum(spare, np.uint64(63))) == 0) | (size == 0)
    at = 8
    on = np.flatnonzero(out & (size > at) & (size <= _LONG))
    while len(on):
        here = np.minimum(at, size[on] - 8)  # the last eight bytes overlap those before
        out[on] = eight[a[on] + here] == eight[b[on] + here]
        at += 8
        on = on[out[on] & (size[on] > at)]
    for k in np.flatnonzero(out & (size > _LONG)):
        out[k] = np.array_equal(data[a[k] : a[k] + size[k]], data[b[k] : b[k] + size[k]])
    return out


class Table:
    """Open addressing over spans of one byte array: equal bytes share a slot, different ones never do.

    All spans are put in together, round by round: those at an empty slot claim it, those whose key
    and bytes are the slot's are done, and the others go on to the next slot. ``slot`` tells each
    span's slot, numbered without gaps; ``first`` gives the span that each slot stands for, and
    ``count`` how many spans it holds.
    """

    def __init__(self, data: np.ndarray, start: np.ndarray, stop: np.ndarray):
        n = len(start)
        mask = (1 << max(4, (2 * n - 1).bit_length())) - 1
        keys, size = xxh64(data, start, stop), stop - start
        holder = np.full(mask + 1, -1, np.int64)
        place = (keys & np.uint64(mask)).astype(np.int64)
        todo = np.arange(n)
        while len(todo):
            free = todo[holder[place[todo]] < 0]
            holder[place[free][::-1]] = free[::-1]  # of several at a slot, the first is written last
            held = holder[place[todo]]
            same = (keys[held] == keys[todo]) & (size[held] == size[todo])
            near = np.flatnonzero(same)
            same[near] = equal_spans(data, start[held[near]], start[todo[near]], size[todo[near]])
            todo = todo[~same]
            place[todo] = (place[todo] + 1) & mask
        used = np.flatnonzero(holder >= 0)
        number = np.empty(mask + 1, np.int64)
        number[used] = np.arange(len(used))
        self.slot, self.first = number[place], holder[used]
        self.count = np.bincount(self.slot, minlength=len(used))
        self.key = keys[self.first]


def strings(data: np.ndarray, start: np.ndarray, stop: np.ndarray) -> pa.Array:
    """The spans as Arrow strings."""
    sizes = stop - start
    ends = np.cumsum(sizes)
    source = np.repeat(start - (ends - sizes), sizes) + np.arange(int(sizes.sum()))
    offsets = np.concatenate((np.zeros(1, np.int64), ends))
    return pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(offsets), pa.py_buffer(data[source])).cast(pa.string())
