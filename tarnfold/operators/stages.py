"""Intermediate results: cut lineage in the cluster's shared folder, and broadcasts of a checked size."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A table of so many rows at most (counted before) is broadcast.
BROADCAST_ROWS = 100_000


def checkpoint_folder(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``; one is made for a local master (tests), a cluster has to name one."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
        named = tempfile.mkdtemp(prefix="spark-checkpoint-", dir="/tmp")
        spark.sparkContext.setCheckpointDir(named)
    return named


def cut(df: DataFrame) -> DataFrame:
    """df, computed once: its rows are in checkpoint_folder(), its lineage is gone."""
    checkpoint_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def few(df: DataFrame, rows: DataFrame | None = None) -> DataFrame:
    """df with a hint to broadcast it if it has few rows; as it is if it has more. df is counted, so cut it before if it is dear.

    rows: those that df holds as lists; they are counted in its place.
    """
    return F.broadcast(df) if (df if rows is None else rows).limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df
