"""WARC archives: written with deduplicated payloads, read back, and indexed in global order.

Writing. Payloads are hashed where they are read; the smallest id of every payload is an aggregate
with map-side combining, and a join brings it to the records (a payload that a third of all rows
share is split by adaptive execution). The record with the smallest id is a ``response``; the others
are ``revisit`` records without payload that name it. Tasks put records together to archives of
about ``archive_bytes``, and Spark's text writer stores one archive per file, so that any file
system that Spark knows will do. A file is a gzip stream of WARC/1.1 records.

Reading. Every archive is parsed by its content lengths; payload length and digest are taken from
the payload itself, and checked against the header.

Index. The captures of an archive, sorted by (URL key, timestamp, id), are a run. Runs are written
as a table and dealt out by ranges of that key; each range merges the pieces of all runs with a tree
of losers. Ranges follow each other, so the captures come out in global order: all captures of a URL
together, oldest first. The id is part of the key, so even a URL with a third of all captures spreads
over ranges. A task holds the index rows of its range (about ``rows_per_range``), never payloads.

A page table without capture times gets them from the id: ``EPOCH`` plus id seconds.

Defined cases: a null payload is empty; a null URL has the empty key; a null id sorts first and
is written as ``null``, and is a response only if no record with the same payload has an id; of
rows that share id and payload each is a response, if that id is the smallest; an empty table gives
no rows. Line ends inside URLs are written percent-encoded.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator, Sequence
from datetime import UTC, datetime, timedelta

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.state.shared import shared_root, stage

EPOCH = datetime(2024, 1, 1, tzinfo=UTC)
END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


# --- records ----------------------------------------------------------------------


def _urn(page_id: int | None) -> str:
    return f"<urn:page:{'null' if page_id is None else page_id}>"


def record(page_id: int | None, url: str | None, captured: str, payload: bytes, first_id: int | None, kind: str) -> str:
    """One WARC record without its closing blank lines; the payload is UTF-8 text."""
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {_urn(page_id)}", f"WARC-Date: {captured}"]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    head.append(f"WARC-Payload-Digest: sha1:{base32_sha1(payload)}")
    body = payload.decode()
    if kind == "revisit":
        head += [f"WARC-Refers-To: {_urn(first_id)}", f"WARC-Profile: {PROFILE}", f"X-Payload-Length: {len(payload)}"]
        payload, body = b"", ""
    head += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {len(payload)}"]
    return "\r\n".join(head) + END + body


def parse(archive: bytes) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(offset, header fields, content) of every record."""
    at = 0
    while at < len(archive):
        split = archive.index(END.encode(), at)
        lines = archive[at:split].decode().split("\r\n")
        if lines[0] != "WARC/1.1":
            raise ValueError(f"no record at {at}")
        fields = dict(line.split(": ", 1) for line in lines[1:])
        begin = split + len(END)
        stop = begin + int(fields["Content-Length"])
        if archive[stop : stop + len(END)] != END.encode():
            raise ValueError(f"record at {at} is cut off")
        yield at, fields, archive[begin:stop]
        at = stop + len(END)


def _id(urn: str | None) -> int | None:
    text = urn[len("<urn:page:") : -1] if urn else "null"
    return None if text == "null" else int(text)


def url_key(url: str | None) -> str:
    """Host labels from the top down, then the rest: neighbours in a site sort together."""
    if not url or "://" not in url:
        return url or ""
    rest = url.split("://", 1)[1]
    cut = min((k for k in (rest.find(c) for c in "/?#") if k >= 0), default=len(rest))
    host, port = (rest[:cut].lower().split(":", 1) + [""])[:2]
    return ",".join(reversed(host.split("."))) + (f":{port}" if port else "") + ")" + rest[cut:]


# --- writing ----------------------------------------------------------------------


def write_archives(
    pages: DataFrame,
    folder: str,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    time_col: str | None = None,
    least_bytes: int = 0,
    archive_bytes: int = 1 << 23,
) -> None:
    """Write every row as a record; payloads of at least ``least_bytes`` are kept once."""
    payload = F.coalesce(F.col(payload_col).cast("string"), F.lit(""))
    captured = F.col(time_col) if time_col else F.timestamp_seconds(F.lit(int(EPOCH.timestamp())) + F.coalesce(F.col(id_col), F.lit(0)))
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"),
        F.col(url_col).alias("url"),
        F.unix_micros(captured.cast("timestamp")).alias("captured"),
        payload.alias("payload"),
        F.sha1(F.encode(payload, "UTF-8")).alias("digest"),
    )
    # found in a pass of its own: the aggregate needs ids and digests only
    first = rows.groupBy("digest").agg(F.min("page_id").alias("first_id"))
    again = (F.octet_length("payload") >= least_bytes) & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    joined = rows.join(first, "digest").select(
        "page_id", "url", "captured", "payload", "first_id", F.when(again, "revisit").otherwise("response").alias("kind")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def archive() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([END.join(held)])], ["archive"])

        for batch in batches:
            texts = batch.column(3).cast(pa.binary())
            for k in range(batch.num_rows):
                page_id, url, at, first_id, kind = (batch.column(c)[k].as_py() for c in (0, 1, 2, 4, 5))
                when = (datetime(1970, 1, 1) + timedelta(microseconds=at or 0)).isoformat() + "Z"
                held.append(record(page_id, url, when, texts[k].as_py(), first_id, kind))
                size += len(held[-1])
                if size >= archive_bytes:
                    yield archive()
                    held, size = [], 0
        if held:
            yield archive()

    archives = joined.mapInArrow(run, "archive string")
    archives.write.option("lineSep", END).option("compression", "gzip").option("maxRecordsPerFile", 1).text(folder)


# --- reading back -----------------------------------------------------------------

CAPTURE = (
    "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, "
    "url_key string, captured string, run string, offset bigint"
)
_TYPES = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64()]
_NAMES = [part.strip().split(" ")[0] for part in CAPTURE.split(",")]


def _key(row: Sequence) -> tuple:
    """(URL key, timestamp, id), a null id first; the offset settles what is left."""
    return row[5], row[6], row[0] is not None, row[0] or 0, row[7], row[8]


def captures(archive: bytes, name: str) -> list[tuple]:
    """The archive's captures as a sorted run."""
    rows = []
    for offset, fields, content in parse(archive):
        kind, digest = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha1:")
        if kind == "response":
            size, refers = len(content), None
            if base32_sha1(content) != digest:
                raise ValueError(f"damaged payload at {offset} of {name}")
        else:
            size, refers = int(fields["X-Payload-Length"]), _id(fields["WARC-Refers-To"])
        key = url_key(fields.get("WARC-Target-URI"))
        rows.append((_id(fields["WARC-Record-ID"]), size, digest, kind, refers, key, fields["WARC-Date"], name, offset))
    return sorted(rows, key=_key)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(_NAMES)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _TYPES)], _NAMES)


def read_runs(spark, folder: str) -> DataFrame:
    """All captures of the archives, each archive's in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0), batch.column(1)):
                archive = zlib.decompress(content.as_py(), wbits=31)
                rows = captures(archive, name.as_py().rsplit("/", 1)[-1])
                for at in range(0, len(rows), 1 << 13):
                    yield _batch(rows[at : at + (1 << 13)])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt.gz").load(folder)
    return files.select("path", "content").mapInArrow(run, CAPTURE)


# --- merging ----------------------------------------------------------------------


def merge(runs: list[list], key) -> Iterator:
    """All rows of sorted runs in order, by a tree of losers: one comparison per level and row.

    Leaf k holds the head of run k. An inner node keeps the loser of the match played there, and
    the winner goes up; after a row is given out, only the path from its leaf is played again.
    """
    k = len(runs)
    if not k:
        return
    heads = [0] * k
    keys = [key(run[0]) if run else None for run in runs]

    def before(a: int, b: int) -> bool:  # an exhausted run loses; equal keys keep the order of the runs
        if keys[a] is None or keys[b] is None:
            return keys[b] is None and (keys[a] is not None or a < b)
        return keys[a] < keys[b] or keys[a] == keys[b] and a < b

    losers = [0] * k
    winners = [0] * k + list(range(k))
    for node in range(k - 1, 0, -1):
        a, b = winners[2 * node], winners[2 * node + 1]
        winners[node], losers[node] = (a, b) if before(a, b) else (b, a)
    best = winners[1] if k > 1 else 0
    while keys[best] is not None:
        run = runs[best]
        yield run[heads[best]]
        heads[best] += 1
        keys[best] = key(run[heads[best]]) if heads[best] < len(run) else None
        node = (best + k) // 2
        while node:
            if before(losers[node], best):
                losers[node], best = best, losers[node]
            node //= 2


def merged_index(runs: DataFrame, rows_per_range: int = 1 << 18) -> DataFrame:
    """The captures in global order; ``runs`` must be a written table."""
    ranges = max(1, -(-runs.count() // rows_per_range))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces: dict[str, list[tuple]] = {}
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                pieces.setdefault(row[7], []).append(row)
        for rows in pieces.values():
            # a run's rows may arrive in several blocks; only then is its piece out of order
            if any(_key(b) < _key(a) for a, b in zip(rows, rows[1:])):
                rows.sort(key=_key)
        out = []
        for row in merge(list(pieces.values()), _key):
            out.append(row)
            if len(out) == 1 << 13:
                yield _batch(out)
                out = []
        if out:
            yield _batch(out)

    return runs.repartitionByRange(ranges, "url_key", "captured", "page_id").mapInArrow(run, CAPTURE)


def archive_and_index(pages: DataFrame, **options) -> DataFrame:
    """Write ``pages`` to archives in the shared folder, read them back, merge the index."""
    spark = pages.sparkSession
    folder = shared_root(spark)
    write_archives(pages, f"{folder}/archives", **options)
    return merged_index(stage(read_runs(spark, f"{folder}/archives"), f"{folder}/runs"))
