"""Exact removal of lines that many documents share, by levelled sorted runs of line hashes.

The store of lines seen so far is a set of runs: bucketed, sorted tables of line hashes, each hash in
one run only, with its holder (the largest document id that has the line). Documents come in
batches, largest ids first. The lines of a batch are merge-anti-joined with every run, one after the
other; what no run knows is new and becomes a run of its own on level 0. Two runs of a level are
merged into one of the next, so after b batches there are at most log2(b) + 1 runs and every hash was
rewritten that often. Runs and batches are bucketed alike: a batch is shuffled once, the runs never.

A line occurrence that is not its line's holder is a repeat; repeats are written down, and a line with
``min_docs - 1`` or more documents among its repeats is frequent. Repeats of frequent lines are
dropped from their texts. The counting joins use hash and document together or rows that are already
aggregated by line, so a line that a third of all documents have is spread like any other.

Nothing but DataFrame functions is used. Hashes are two 64-bit numbers (XXH64 under two seeds), so
that among 10^12 different lines the chance of any mix-up is below 10^-14. Texts are shuffled
once, to meet the places of their dropped lines; runs and repeats hold hashes only.

Defined cases: a null or empty text is one empty line, never dropped; rows that share an id are one
document when documents are counted, and each row loses its own lines; null ids are together one
document, smaller than all others; a line twice in the holder stays twice; lines of equal keys but
different spelling are the same line; an empty table gives no rows. Columns of the input are carried
in a struct, so their names cannot clash with those used inside.
"""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.state.shared import shared_root, stage

BLANKS = " \t\n\x0b\x0c\r"
HASH = ["h1", "h2"]


def _let(value: Column, body) -> Column:
    """Evaluate ``value`` once and hand it to ``body``."""
    return F.transform(F.array(value), body)[0]


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _lowered(text: Column) -> Column:
    """A-Z in lower case; where all is ASCII, the faster general function does the same."""
    ascii_only = F.length(text) == F.octet_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, ascii_uppercase, ascii_lowercase))


def line_table(docs: DataFrame, min_chars: int) -> DataFrame:
    """(h1, h2, doc, mark, place) of every line whose key has at least ``min_chars`` code points.

    ``mark`` is a hash of the whole text; with the id it names the row (or equal copies of it).
    """
    keys = F.transform(lines_of(_lowered(F.col("text"))), lambda line: F.btrim(line, F.lit(BLANKS)))
    return (
        docs.select("doc", "mark", F.posexplode(keys).alias("place", "key"))
        .filter(F.length("key") >= min_chars)
        .select(F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), F.col("key")).alias("h2"), "doc", "mark", "place")
    )


class LineRuns:
    """The levelled runs. Tables live in a database of their own in the shared folder; ``drop`` removes them.

    ``buckets`` is the session's number of shuffle partitions, so that aggregates, joins and runs
    are partitioned alike; set it by the number of different lines (about a million a bucket).
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.database = f"line_runs_{uuid4().hex}"
        self.levels: list[str | None] = []  # at most one run of each level between two batches
        self.made = 0
        spark.sql(f"CREATE DATABASE {self.database} LOCATION '{folder}/runs'")

    def drop(self) -> None:
        self.spark.sql(f"DROP DATABASE {self.database} CASCADE")

    def _write(self, rows: DataFrame) -> str:
        name = f"{self.database}.run_{self.made}"
        self.made += 1
        rows.write.bucketBy(self.buckets, *HASH).sortBy(*HASH).saveAsTable(name)
        return name

    def add(self, lines: DataFrame) -> DataFrame:
        """Take in a batch of ``line_table`` rows, none of whose ids is larger than one added before.

        Returns the repeats: the rows that do not belong to the holder of their line.
        """
        fresh = lines.groupBy(*HASH).agg(F.max("doc").alias("holder"))
        for run in self.levels:
            if run is not None:
                fresh = fresh.join(self.spark.table(run).select(*HASH).hint("merge"), HASH, "left_anti")
        added = self._write(fresh)
        new = self.spark.table(added).alias("new")
        held = [F.col(f"line.{c}") == F.col(f"new.{c}") for c in HASH] + [F.col("line.doc").eqNullSafe(F.col("new.holder"))]
        repeats = lines.alias("line").join(new, held, "left_anti")
        self._place(added)
        return repeats

    def _place(self, run: str) -> None:
        level = 0
        while level < len(self.levels) and self.levels[level] is not None:
            run = self._merged(self.levels[level], run)
            self.levels[level] = None
            level += 1
        if level == len(self.levels):
            self.levels.append(None)
        self.levels[level] = run

    def _merged(self, old: str, new: str) -> str:
        """Both runs in one: a full merge join, bucket by bucket. The runs merged stay until ``drop``."""
        a, b = self.spark.table(old).alias("a"), self.spark.table(new).hint("merge").alias("b")
        both = a.join(b, [F.col(f"a.{c}") == F.col(f"b.{c}") for c in HASH], "full_outer")
        return self._write(both.select(*[F.coalesce(f"a.{c}", f"b.{c}").alias(c) for c in [*HASH, "holder"]]))


def _bounds(docs: DataFrame, batches: int, sample: int) -> list:
    """Ids that cut the table into about equal batches, from a bounded sample of the lowest id hashes."""
    ids = docs.filter(F.col("doc").isNotNull()).select("doc").orderBy(F.xxhash64("doc")).limit(sample)
    found = sorted({row["doc"] for row in ids.collect()})
    return sorted({found[len(found) * k // batches] for k in range(1, batches)}) if found else []


def dedup_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_chars: int = 40,
    min_docs: int = 5,
    batches: int = 6,
    sample: int = 1024,
) -> DataFrame:
    """Every row with ``n_lines``, ``n_dropped`` and ``kept_text``; the row itself is the struct ``row``.

    ``batches`` and ``sample`` (the ids looked at to cut batches) change the work, not the result.
    """
    spark, folder = docs.sparkSession, shared_root(docs.sparkSession)
    named = docs.select(
        F.col(id_col).alias("doc"), F.xxhash64(text_col).alias("mark"), F.col(text_col).alias("text"), F.struct("*").alias("row")
    )
    bounds = _bounds(named, batches, sample)
    # batch 0 holds the largest ids, null ids come in the last
    batch = F.lit(len(bounds))
    for k, bound in enumerate(bounds):
        batch = F.when(F.col("doc") >= F.lit(bound), len(bounds) - 1 - k).otherwise(batch)
    lines = line_table(named.select("doc", "mark", "text"), min_chars).withColumn("batch", batch)
    lines.write.partitionBy("batch").parquet(f"{folder}/lines")
    staged = spark.read.schema(lines.schema).parquet(f"{folder}/lines")
    runs, found = LineRuns(spark, folder), []
    for k in range(len(bounds) + 1):
        part = staged.filter(F.col("batch") == k).drop("batch")
        found.append(stage(runs.add(part), f"{folder}/repeats_{k}"))
    runs.drop()
    repeats = found[0]
    for more in found[1:]:
        repeats = repeats.unionByName(more)
    frequent = (
        repeats.groupBy(*HASH)
        .agg((F.count_distinct("doc") + F.max(F.col("doc").isNull().cast("int"))).alias("others"))
        .filter(F.col("others") >= min_docs - 1)
        .select(*HASH)
    )
    drops = repeats.join(frequent, HASH, "left_semi").groupBy("doc", "mark").agg(F.collect_set("place").alias("gone"))
    drops = stage(drops, f"{folder}/drops").select(F.col("doc").alias("d"), F.col("mark").alias("m"), "gone")
    met = named.join(drops, F.col("doc").eqNullSafe(F.col("d")) & (F.col("mark") == F.col("m")), "left")

    def kept(lines: Column) -> Column:
        left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), "gone")
        text = F.when(F.col("gone").isNull(), F.coalesce("text", F.lit(""))).otherwise(
            F.array_join(F.transform(left, lambda place: lines[place]), "\n")
        )
        return F.struct(F.size(lines).cast("long").alias("n_lines"), text.alias("kept_text"))

    dropped = F.when(F.col("gone").isNull(), 0).otherwise(F.size("gone")).cast("long")
    out = _let(lines_of(F.col("text")), kept)
    return met.select("row", dropped.alias("n_dropped"), out.alias("out")).select("row", "out.n_lines", "n_dropped", "out.kept_text")
