"""Chat formatting by incremental black-box rendering.

A template is any function from a list of turns (role, text) to a string. Where a turn ends up in
the formatted conversation is not asked of the template but seen from outside: the conversation is
rendered turn by turn, and each rendering must continue the one before. What is new belongs to the
new turn. Within it, two renderings of the turn with different probe texts show what stands before
and after the text. Where a rendering does not continue the one before, the template rewrites
history; the turn is reported and the conversation gets no loss mask.

The bundled template marks turns with ``<s> </s> [INST] [/INST] [SYS] [/SYS] [ROLE=...] [/ROLE]``.
Inside texts and role names such strings get a backslash after their first character, and one more
if they have some already, so that escaping can be undone and a text can never end its own turn.

Defined cases: null texts and roles are empty; turns go by number, ties by role and text, null
numbers first; turns without a conversation id form one conversation; repeated rows are turns like
any others; a conversation's turns are one row, as their formatted text is; an empty table gives no
rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Turn = tuple[str, str]
Template = Callable[[list[Turn]], str]

# --- the bundled template ---------------------------------------------------------

_NAMES = r"/?s>|/?INST\]|/?SYS\]|/?ROLE(?:=|\])"
_PLAIN = re.compile(rf"([<\[])(\\*)({_NAMES})")
_ESCAPED = re.compile(rf"([<\[])(\\*)\\({_NAMES})")


def escape(text: str) -> str:
    return _PLAIN.sub(r"\1\2\\\3", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1\2\3", text)


def _escape_role(role: str) -> str:
    return role.replace("\\", "\\\\").replace("]", "\\]")


def _unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", r"\1", role, flags=re.S)


def bracket_template(turns: list[Turn]) -> str:
    return "<s>" + "".join(_format(role, text) for role, text in turns)


@lru_cache(maxsize=1 << 12)
def _format(role: str, text: str) -> str:
    """A turn; kept while its conversation is rendered, as growing prefixes ask for it again and again."""
    text = escape(text)
    if role == "user":
        return f"[INST] {text} [/INST]"
    if role == "assistant":
        return f" {text}</s>"
    if role == "system":
        return f"[SYS] {text} [/SYS]"
    return f"[ROLE={_escape_role(role)}] {text} [/ROLE]"


_ROLE = re.compile(r"\[ROLE=((?:[^\\\]]|\\.)*)\] ", re.S)


def parse(formatted: str) -> list[Turn]:
    """The turns, read back from what ``bracket_template`` made."""
    if not formatted.startswith("<s>"):
        raise ValueError("no beginning")
    at, turns = 3, []
    while at < len(formatted):
        if formatted.startswith("[INST] ", at):
            role, begin, close = "user", at + 7, " [/INST]"
        elif formatted.startswith("[SYS] ", at):
            role, begin, close = "system", at + 6, " [/SYS]"
        elif formatted.startswith(" ", at):
            role, begin, close = "assistant", at + 1, "</s>"
        elif m := _ROLE.match(formatted, at):
            role, begin, close = _unescape_role(m[1]), m.end(), " [/ROLE]"
        else:
            raise ValueError(f"no turn at {at}")
        end = formatted.index(close, begin)
        turns.append((role, unescape(formatted[begin:end])))
        at = end + len(close)
    return turns


# --- rendering --------------------------------------------------------------------


@dataclass(frozen=True)
class Rendered:
    text: str
    spans: list[tuple[int, int]]  # of every turn with its marks
    contents: list[tuple[int, int]]  # of every turn's text
    rewritten: list[int]  # turns whose addition changed what stood before


PROBES = ("①", "②")  # any two texts that begin and end differently


def _same_head(a: str, b: str) -> int:
    """How many characters two strings begin with in common, by halving."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


def render(turns: list[Turn], template: Template = bracket_template) -> Rendered:
    before, spans, contents, rewritten = template([]), [], [], []
    for k, (role, _) in enumerate(turns):
        now = template(turns[: k + 1])
        begin = len(before)
        if not now.startswith(before):
            rewritten.append(k)
            begin = _same_head(before, now)
        spans.append((begin, len(now)))
        one, two = (template([*turns[:k], (role, probe)]) for probe in PROBES)
        # what both share with the rendering before needs no second look
        known = len(before) if one.startswith(before) and two.startswith(before) else 0
        one, two = one[known:], two[known:]
        head, tail = _same_head(one, two), _same_head(one[::-1], two[::-1])
        contents.append((known + head, max(known + head, len(now) - tail)))
        before = now
    if rewritten:  # places found before a change no longer hold
        contents = []
    return Rendered(before, spans, contents, rewritten)


def loss_spans(turns: list[Turn], rendered: Rendered) -> list[tuple[int, int]]:
    """Places of the assistant's texts in the formatted conversation."""
    return [span for (role, _), span in zip(turns, rendered.contents) if role == "assistant"]


# --- on Spark ---------------------------------------------------------------------


def format_conversations(
    turns: DataFrame,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    template: Template = bracket_template,
    batch: int = 64,
) -> DataFrame:
    """conv_id, formatted, spans, loss_spans and rewritten_turns of every conversation."""
    turn = F.struct(
        F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    gathered = turns.select(F.col(id_col).alias("conv_id"), turn.alias("t")).groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))
    kind = gathered.schema["conv_id"].dataType.simpleString()
    pair = "array<struct<start:int,stop:int>>"
    pairs = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        as_rows = lambda spans: [{"start": a, "stop": b} for a, b in spans]
        for arrived in batches:
            for at in range(0, arrived.num_rows, batch):
                part = arrived.slice(at, batch)
                lists = [[(t["role"], t["text"]) for t in row] for row in part.column(1).to_pylist()]
                done = []
                for turns in lists:
                    done.append(render(turns, template))
                    _format.cache_clear()  # no texts of earlier conversations stay in the worker
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array([r.text for r in done]),
                        pa.array([as_rows(r.spans) for r in done], pairs),
                        pa.array([as_rows(loss_spans(t, r)) for t, r in zip(lists, done)], pairs),
                        pa.array([r.rewritten for r in done], pa.list_(pa.int32())),
                    ],
                    ["conv_id", "formatted", "spans", "loss_spans", "rewritten_turns"],
                )

    return gathered.mapInArrow(
        run, f"conv_id {kind}, formatted string, spans {pair}, loss_spans {pair}, rewritten_turns array<int>"
    )


def digests(formatted: DataFrame) -> DataFrame:
    """What can be read back from formatted conversations of the bundled template."""
    kind = formatted.schema["conv_id"].dataType.simpleString()
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def one(text: str, spans: list[dict]) -> tuple:
        turns = parse(text)
        told = "".join(f"{role}\n{said}\n" for role, said in turns)
        masked = "".join(unescape(text[s["start"] : s["stop"]]) for s in spans)
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        return len(turns), sha(told), len(masked), sha(masked), len(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        for batch in batches:
            rows = [one(t.as_py(), s.as_py()) for t, s in zip(batch.column(1), batch.column(2))]
            columns = list(zip(*rows)) or [()] * 5
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, columns, kinds)], names)

    return formatted.select("conv_id", "formatted", "loss_spans").mapInArrow(
        run,
        f"conv_id {kind}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint",
    )
