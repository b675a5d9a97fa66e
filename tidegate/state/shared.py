"""The folder that the driver and all executors share, and tables written there."""

from __future__ import annotations

import tempfile
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession


def shared_root(spark: SparkSession) -> str:
    """A fresh folder name under ``spark.checkpoint.dir``.

    Where the setting is missing, a single-machine session (``local[...]``) gets a temporary
    folder; any other master must name a shared one.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="tidegate-")
    return f"{root.rstrip('/')}/{uuid4().hex}"


def stage(frame: DataFrame, folder: str) -> DataFrame:
    """Write the rows as Parquet and read them back.

    Cuts the lineage: a lost executor costs no recomputation of what stands before, and later
    steps see the real size of the table.
    """
    frame.write.parquet(folder)
    return frame.sparkSession.read.schema(frame.schema).parquet(folder)
