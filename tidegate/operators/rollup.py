"""Daily partials of the large logs, from which the summary's measures are merged exactly.

A log day is a set of facts that never change once the day is over: attempts that began, attempts
that succeeded with their rows, checks that failed. Counts and sums of days add up. Retries do
not: an attempt is a retry if its run has tried the table before, maybe on another day. So a day
also leaves the (run, table) pairs it saw first; a later day counts a pair as new only if no earlier
day has it. The retries of a day are its attempts less its new pairs, and add up again, also for
attempts that come late.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.state import vocabulary as v

PAIR = ["AdfPipelineRunId", "ConfigId"]
MEASURES = ["attempts", "new_pairs", "rows_processed", "failed_checks"]


def new_pairs(begun: DataFrame, seen: DataFrame, day: str) -> DataFrame:
    """Pairs of ``begun`` that ``seen`` lacks, with the first day that has them; NULL parts are values.

    Pairs are grouped on the map side, so a pair with a third of all attempts is one row a task.
    """
    first = begun.groupBy(*PAIR).agg(F.min(day).alias("day"))
    known = seen.select(F.struct(*PAIR).alias("_pair")).distinct()
    return first.withColumn("_pair", F.struct(*PAIR)).join(known, "_pair", "left_anti").select(*PAIR, "day")


def day_partials(begun: DataFrame, done: DataFrame, checks: DataFrame, fresh: DataFrame, day: str) -> DataFrame:
    """One row per day: attempts, new_pairs, rows_processed, failed_checks.

    ``begun`` has a row for every attempt, ``done`` one for every attempt that succeeded, each with the
    day its fact was logged; ``fresh`` are the ``new_pairs`` of these days.
    """

    def measured(rows: DataFrame, column: str, name: str, value) -> DataFrame:
        return rows.groupBy(F.col(column).alias("day")).agg(value.cast("bigint").alias(name))

    parts = [
        measured(begun, day, "attempts", F.count("*")),
        measured(fresh, "day", "new_pairs", F.count("*")),
        measured(done, day, "rows_processed", F.sum(F.coalesce("SourceRowCount", F.lit(0).cast("bigint")))),
        measured(checks.filter(F.col("Result") == v.FAIL), day, "failed_checks", F.count("*")),
    ]
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part, allowMissingColumns=True)
    return stacked.groupBy("day").agg(*[F.coalesce(F.sum(m), F.lit(0).cast("bigint")).alias(m) for m in MEASURES])


def merged(partials: DataFrame) -> DataFrame:
    """One row: the summary's measures of attempts and checks, from the partials of all days."""
    total = {m: F.coalesce(F.sum(m), F.lit(0).cast("bigint")) for m in MEASURES}
    return partials.agg(
        total["rows_processed"].alias("RowsProcessed"),
        (total["attempts"] - total["new_pairs"]).alias("TotalRetryAttempts"),
        total["failed_checks"].alias("ReconciliationFailures"),
    )
