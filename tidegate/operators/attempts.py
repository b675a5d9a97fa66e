"""Load attempts: latest outcome, numbering, retries and run totals."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidegate.functions.text import concat0
from tidegate.operators.lookup import latest_by
from tidegate.state import vocabulary as v

RUN, CONFIG, ID = "AdfPipelineRunId", "ConfigId", "TableLoadAuditId"


def latest_attempts(attempts: DataFrame) -> DataFrame:
    """The newest attempt of each (run, config) and its status."""
    return latest_by(attempts, [RUN, CONFIG], ID, [ID, "Status"])


def attempt_numbers(attempts: DataFrame, block_bits: int = 20) -> DataFrame:
    """``AttemptNumber``: position of the attempt within (run, config) by id.

    A single window per group would sort a group that holds a third of the log in one
    task. Attempt ids are unique, so a block of ``2 ** block_bits`` consecutive ids has at
    most that many rows: number within (group, block), then add the rows of the group's earlier blocks.
    The usual group lies in one block and needs nothing added, so the second input is
    near empty and adaptive execution broadcasts it.
    """
    # a struct key matches NULL parts as a window does, and lets the join reuse the
    # window's partitioning
    blocked = attempts.withColumns(
        {"_group": F.struct(RUN, CONFIG), "_block": F.shiftright(ID, block_bits)}
    )
    within = F.row_number().over(Window.partitionBy("_group", "_block").orderBy(ID))
    earlier = Window.partitionBy("_group").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        blocked.groupBy("_group", "_block")
        .agg(F.count("*").alias("_rows"))
        .withColumn("_before", F.sum("_rows").over(earlier))
        .filter(F.col("_before") > 0)
        .drop("_rows")
    )
    number = (F.col("_within") + F.coalesce(F.col("_before"), F.lit(0))).cast("bigint")
    return (
        blocked.withColumn("_within", within)
        .join(offsets, ["_group", "_block"], "left")
        .select(*attempts.columns, number.alias("AttemptNumber"))
    )


def retry_totals(attempts: DataFrame) -> DataFrame:
    """Retries per run, and over all runs in the row whose run id is NULL."""
    tries = attempts.groupBy(RUN, CONFIG).agg(F.count("*").alias("tries")).filter("tries > 1")
    per_run = tries.groupBy(RUN).agg(F.sum(F.col("tries") - 1).alias("n"))
    return per_run.rollup(RUN).agg(F.sum("n").alias("Retries"))


def outcomes(attempts: DataFrame) -> DataFrame:
    """Whether the latest attempt of each (run, config) succeeded, failed or neither.

    The latest attempt succeeded when the highest id of all equals the highest id among
    successes. Three maxima of a number aggregate in hashed fixed-width buffers, where the
    status text itself would force a sort of the log.
    """

    def newest(status: str):
        return F.max(F.when(F.col("Status") == status, F.col(ID)))

    last = attempts.groupBy(RUN, CONFIG).agg(
        F.max(ID).alias("last"), newest(v.SUCCESS).alias("ok"), newest(v.FAILURE).alias("bad")
    )
    outcome = F.when(F.col("ok") == F.col("last"), v.SUCCESS).when(
        F.col("bad") == F.col("last"), v.FAILURE
    )
    return last.select(RUN, CONFIG, outcome.alias("outcome"))


def finalize(attempts: DataFrame) -> DataFrame:
    """Counts, status and message of every run that has attempts."""

    def tables(outcome: str):
        return F.count(F.when(F.col("outcome") == outcome, 1)).cast("int")

    ok, bad = F.col("SuccessfulTableCount"), F.col("FailedTableCount")
    counts = outcomes(attempts).groupBy(RUN).agg(
        tables(v.SUCCESS).alias("SuccessfulTableCount"),
        tables(v.FAILURE).alias("FailedTableCount"),
    )
    status = (
        F.when(bad == 0, v.SUCCESS).when(ok > 0, v.PARTIAL_SUCCESS).otherwise(v.FAILURE)
    )
    message = concat0(ok, F.lit(" table(s) succeeded; "), bad, F.lit(" table(s) failed."))
    return counts.select(RUN, ok, bad, status.alias("Status"), message.alias("Message"))
