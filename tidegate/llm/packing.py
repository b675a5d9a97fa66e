"""Token packing by minimum bin slack.

Every document is tokenised once. Whole windows of ``capacity`` tokens are cut off its front; what
remains is shorter than a window and is kept in one piece. The remaining pieces of a task are
gathered, and each window is the multiset of remaining lengths, the longest among them, whose sum
comes closest to the capacity: a subset-sum dynamic program over bitsets, with the counts of every
length found by going back through its layers. A multiset that fills its window is used as often
as the counts allow before the next one is sought. Pieces that no longer fill a window are put end
to end and cut.

No row leaves its task: tokens are never shuffled, and a task holds at most ``pool`` pieces. The
last tokens of a task are cut at powers of two, which need no padding either.

Texts are tokenised word by word through a bounded cache: the tokenizer drops blanks, so a text's
ids are those of its blank-separated words in a row (``WordIds`` says when that holds). Texts are
taken some at a time, so that each of their words is looked up once, and new words are learnt together.

Defined cases: a null or empty text is the end token alone; repeated rows and null ids are packed
like any others; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import json
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer, normalizers, pre_tokenizers

CAPACITY = 2048
END = 1
REORDER = 32
TOGETHER = 1 << 20  # characters whose words are looked up together
MARKS = ".,;:!?#*$%&|)"


# --- choosing lengths -------------------------------------------------------------


def by_frequency(counts: dict[int, int]) -> list[int]:
    return sorted(counts, key=lambda k: (-counts[k], -k))


def best_multiset(counts: dict[int, int], capacity: int, order: list[int] | None = None) -> dict[int, int]:
    """Length -> how often: holds the longest piece, and no other such choice comes closer to ``capacity``.

    Bit s of a layer says that sum s can be reached with the lengths so far. The most frequent
    lengths come first, each taken in powers of two, so that c pieces cost log c layers. The
    search ends as soon as the capacity itself is reached; otherwise it has seen every length.
    ``order`` holds every length, and may hold some that are used up.
    """
    longest = max(counts)
    mask = (1 << (capacity + 1)) - 1
    layers, reach = [], 1 << longest
    for length in order or by_frequency(counts):
        left = min(counts.get(length, 0) - (length == longest), (capacity - longest) // length)
        take = 1
        while left > 0:
            take = min(take, left)
            layers.append((length, take, reach))
            reach |= (reach << (length * take)) & mask
            left -= take
            take *= 2
        if reach >> capacity & 1:
            break
    total, chosen = reach.bit_length() - 1, defaultdict(int)
    for length, take, before in reversed(layers):
        if not before >> total & 1:
            chosen[length] += take
            total -= length * take
    chosen[longest] += 1
    return dict(chosen)


def full_windows(counts: dict[int, int], capacity: int, keep: int = 0) -> Iterator[tuple[dict[int, int], int]]:
    """(multiset, how often) while more than ``keep`` pieces are left and windows come out whole.

    ``counts`` is reduced by what is given out. The order of the lengths is a matter of speed only
    and is brought up to date after every ``REORDER`` multisets.
    """
    left = sum(counts.values())
    for turn in count():
        if left <= keep:
            return
        if turn % REORDER == 0:
            order = by_frequency(counts)
        chosen = best_multiset(counts, capacity, order)
        if sum(k * c for k, c in chosen.items()) < capacity:
            return
        times = min(counts[k] // c for k, c in chosen.items())
        for k, c in chosen.items():
            counts[k] -= c * times
            left -= c * times
            if not counts[k]:
                del counts[k]
        yield chosen, times


def powers_of_two(total: int) -> list[int]:
    """Falling powers of two with this sum."""
    return [1 << b for b in range(total.bit_length() - 1, -1, -1) if total >> b & 1]


# --- token ids --------------------------------------------------------------------


class _Index(dict):
    """Word -> number; an unknown word gets the next number and is noted in ``new``."""

    def __init__(self, words: list[str] = ()):
        super().__init__(zip(words, range(len(words))))
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        self.new.append(word)
        return number


def _latin(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


# a full stop or comma behind anything but these may be joined with it by the tokenizer: marks, '_',
# control characters, letters that come apart when normalised
JOINED = re.compile(r"[.,](?<=[^0-9A-Za-zÀ-ÖØ-öø-ÿ \t\n][.,])")


class WordIds:
    """Token ids of texts, by blank-separated words, with a cache of about ``limit`` words.

    Holds for tokenizers that drop white space, fold case, and take letters, digits and runs of
    marks apart. Only the ASCII blank, tab and line feed separate words here; every other white
    space stays inside a word and is left to the tokenizer. Where every full stop and comma stands
    behind a blank, a digit or a Latin-1 letter, they begin words of their own; texts of Latin-1
    letters are folded beforehand. A text that may hold a special token's string is encoded as a
    whole.
    """

    _NONE = np.empty(0, np.uint32)

    def __init__(self, path: str, limit: int = 1 << 18):
        self.tokenizer, self.plain, self.limit = Tokenizer.from_file(path), Tokenizer.from_file(path), limit
        # folded words of letters need none of the patterns of the full pipeline
        self.plain.normalizer = normalizers.Sequence([])
        self.plain.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        with open(path, encoding="utf-8") as file:
            vocabulary = json.load(file)["model"]["vocab"]
        self.ends = np.zeros(max(vocabulary.values()) + 8, bool)
        self.ends[[number for token, number in vocabulary.items() if token.endswith("</w>")]] = True
        self.special = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        self.release()

    def release(self) -> None:
        """Forget all words, so that a worker that waits for its next task holds no cache."""
        self.index = _Index()
        self.flat, self.used = np.empty(1 << 16, np.uint32), 0
        self.starts, self.sizes, self.uses = (np.zeros(1 << 12, np.int64) for _ in range(3))

    def _encode(self, texts: list[str], plain: bool = False) -> list[list[int]]:
        tokenizer = self.plain if plain else self.tokenizer
        return [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _store(self, numbers: list[int], flat: np.ndarray, sizes: np.ndarray) -> None:
        while self.used + len(flat) > len(self.flat):
            self.flat = np.concatenate((self.flat, np.empty_like(self.flat)))
        self.flat[self.used : self.used + len(flat)] = flat
        self.sizes[numbers] = sizes
        self.starts[numbers] = self.used + np.cumsum(sizes) - sizes
        self.used += len(flat)

    def _learn(self, folded: bool) -> None:
        """Letters, and letters with a run of marks behind, go through many at a time.

        Such a word has at least one or two pre-tokens, and the last token of each is an
        end-of-word token; so if a run of words has as many in all as expected, each word has.
        """
        new, self.index.new = self.index.new, []
        base = len(self.index) - len(new)
        while len(self.index) > len(self.starts):
            self.starts, self.sizes, self.uses = (np.concatenate((x, np.zeros_like(x))) for x in (self.starts, self.sizes, self.uses))
        numbers, texts, expected, other = [], [], [], []
        for number, word in enumerate(new, base):
            if word.isalpha():
                numbers.append(number)
                texts.append(word)
                expected.append(1)
            elif (stem := word.rstrip(MARKS)).isalpha():
                numbers.append(number)
                texts.append(f"{stem} {word[len(stem) :]}")
                expected.append(2)
            else:
                other.append(number)
        for at in range(0, len(numbers), 256):
            run, parts = numbers[at : at + 256], np.cumsum(expected[at : at + 256])
            ids = np.array(self._encode([" ".join(texts[at : at + 256])], plain=folded)[0], np.uint32)
            stops = np.flatnonzero(self.ends[ids]) + 1
            if len(stops) == parts[-1] and stops[-1] == len(ids):
                self._store(run, ids, np.diff(stops[parts - 1], prepend=0))
            else:  # letters that fall apart when normalised
                other += run
        if other:
            ids = self._encode([new[k - base] for k in other])
            sizes = np.fromiter(map(len, ids), np.int64, len(ids))
            self._store(other, np.fromiter((i for x in ids for i in x), np.uint32, int(sizes.sum())), sizes)

    def _forget(self) -> None:
        """Keep the words that came up again, unless these are too many as well."""
        kept = np.flatnonzero(self.uses[: len(self.index)] > 2)
        kept = kept if len(kept) <= self.limit // 2 else kept[:0]
        words = list(self.index)
        sizes = self.sizes[kept]
        flat = self._gather(kept)
        self.index, self.used, self.uses = _Index([words[k] for k in kept]), 0, np.zeros_like(self.uses)
        self._store(list(range(len(kept))), flat, sizes)

    def _gather(self, numbers: np.ndarray) -> np.ndarray:
        sizes = self.sizes[numbers]
        shift = np.repeat(self.starts[numbers] - (np.cumsum(sizes) - sizes), sizes)
        return self.flat[shift + np.arange(len(shift))]

    def ids(self, text: str) -> np.ndarray:
        return self.ids_of([text])[0]

    def ids_of(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of every text. Each word of these texts is looked up once, new ones are learnt together."""
        out: list[np.ndarray] = [self._NONE] * len(texts)
        prepared: dict[bool, dict[int, str]] = {True: {}, False: {}}  # folded -> place -> text
        for k, text in enumerate(texts):
            lowered = text.lower()
            if any(token in lowered for token in self.special):
                out[k] = np.array(self._encode([text])[0], np.uint32)
                continue
            folded = text.isascii() or _latin(text)  # Latin-1: one lower case, nothing to compose
            if folded:
                text = lowered
            if not JOINED.search(text):
                text = text.replace(",", " ,").replace(".", " .")
            prepared[folded][k] = text.replace("\n", " ").replace("\t", " ")
        for folded, members in prepared.items():
            if members:
                for k, ids in zip(members, self._look_up(list(members.values()), folded)):
                    out[k] = ids
        return out

    def _look_up(self, texts: list[str], folded: bool) -> list[np.ndarray]:
        split = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
        coded = split.values.dictionary_encode()
        words, of_word = coded.dictionary.to_numpy(zero_copy_only=False), coded.indices.to_numpy()
        at = np.fromiter(map(self.index.__getitem__, words), np.int64, len(words))
        if self.index.new:
            self._learn(folded)
        self.uses[at] += np.bincount(of_word, minlength=len(words))
        numbers = at[of_word]
        ends = np.concatenate((np.zeros(1, np.int64), np.cumsum(self.sizes[numbers])))
        cuts = ends[split.offsets.to_numpy()].tolist()
        ids = self._gather(numbers)
        if len(self.index) > self.limit:
            self._forget()
        return [ids[lo:hi] for lo, hi in zip(cuts, cuts[1:])]


_LOADED: dict[str, WordIds] = {}


def _word_ids(path: str) -> WordIds:
    """One per Python worker, kept between its tasks."""
    if path not in _LOADED:
        _LOADED[path] = WordIds(path)
    return _LOADED[path]


def _together(batch: pa.RecordBatch) -> Iterator[tuple[list, list[str]]]:
    """(ids, texts) of successive rows, up to about ``TOGETHER`` characters; one text may be longer."""
    docs, texts, held = [], [], 0
    for doc, text in zip(batch.column(0), batch.column(1)):
        docs.append(doc.as_py())
        texts.append(text.as_py() or "")
        held += len(texts[-1])
        if held >= TOGETHER:
            yield docs, texts
            docs, texts, held = [], [], 0
    if docs:
        yield docs, texts


def _crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


# --- packing a task's documents ---------------------------------------------------


class Packer:
    """Takes documents one by one and gives rows (doc, start, length, crc, doc_tokens, window, offset)."""

    def __init__(self, capacity: int, pool: int, first_window: int):
        self.capacity, self.pool, self.window = capacity, pool, first_window
        self.waiting: dict[int, list] = defaultdict(list)  # length -> pieces
        self.held = 0
        self.rows: list[tuple] = []

    def add(self, doc, ids: np.ndarray) -> None:
        n, c = len(ids), self.capacity
        for start in range(0, n - n % c, c):
            self._place([(doc, start, ids[start : start + c], n)])
        if n % c:
            self.waiting[n % c].append((doc, n - n % c, ids[n - n % c :].copy(), n))
            self.held += 1
        if self.held >= self.pool:
            self._pack(self.pool // 2)
            if self.held >= self.pool:  # lengths that fill no window among themselves
                self._cut(last=False)

    def _place(self, pieces: list) -> None:
        offset = 0
        for doc, start, ids, n in pieces:
            self.rows.append((doc, start, len(ids), _crc(ids), n, self.window, offset))
            offset += len(ids)
        self.window += 1

    def _pack(self, keep: int) -> None:
        counts = {k: len(v) for k, v in self.waiting.items() if v}
        for chosen, times in full_windows(counts, self.capacity, keep):
            for _ in range(times):
                pieces = [self.waiting[k].pop() for k, c in chosen.items() for _ in range(c)]
                self.held -= len(pieces)
                self._place(pieces)

    def _cut(self, last: bool) -> None:
        """Pieces end to end, cut into whole windows and, at last, falling powers of two."""
        pieces = [p for k in sorted(self.waiting) for p in self.waiting[k]]
        total = sum(len(p[2]) for p in pieces)
        sizes = [self.capacity] * (total // self.capacity)
        if last:
            sizes += powers_of_two(total % self.capacity)
        for size in sizes:
            window, room = [], size
            while room:
                doc, start, ids, n = pieces.pop()
                if len(ids) > room:
                    pieces.append((doc, start + room, ids[room:], n))
                    ids = ids[:room]
                window.append((doc, start, ids, n))
                room -= len(ids)
            self._place(window)
        self.waiting.clear()
        for piece in pieces:
            self.waiting[len(piece[2])].append(piece)
        self.held = len(pieces)

    def finish(self) -> None:
        self._pack(0)
        self._cut(last=True)


COLUMNS = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def pack(
    docs: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    pool: int = 1 << 14,
) -> DataFrame:
    """One row per piece; ``tokenizer`` is the path of a tokenizer file that every executor has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, end = _word_ids(tokenizer), np.array([END], np.uint32)
        packer = Packer(capacity, pool, TaskContext.get().partitionId() << 40)
        kind = pa.int64()

        def rows(least: int) -> Iterator[pa.RecordBatch]:
            if len(packer.rows) >= least:
                columns = list(zip(*packer.rows)) or [()] * len(COLUMNS)
                packer.rows = []
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[0], kind), *[pa.array(c, pa.int64()) for c in columns[1:]]], COLUMNS
                )

        for batch in batches:
            kind = batch.schema.field(0).type
            for docs, texts in _together(batch):
                for doc, ids in zip(docs, words.ids_of(texts)):
                    packer.add(doc, np.concatenate((ids, end)))
                yield from rows(1 << 13)
        packer.finish()
        words.release()
        yield from rows(1)

    picked = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = picked.schema["doc_id"].dataType.simpleString()
    return picked.mapInArrow(run, f"doc_id {kind}, " + ", ".join(f"{c} bigint" for c in COLUMNS[1:]))
