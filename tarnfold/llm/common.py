"""Helpers that several of the operators share."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpoint_folder(spark: SparkSession) -> str:
    """The cluster's shared folder: the session's ``spark.checkpoint.dir``.

    Where neither that setting nor a folder of the context exists, one is made for a local master
    (tests); a cluster has to name one that all its machines share.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
        named = tempfile.mkdtemp(prefix="spark-checkpoint-", dir="/tmp")
        spark.sparkContext.setCheckpointDir(named)
    return named


def cut(df: DataFrame) -> DataFrame:
    """Materialise df and cut its lineage in checkpoint_folder()."""
    checkpoint_folder(df.sparkSession)
    return df.checkpoint(eager=True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Gives a function that writes a table to checkpoint_folder() and reads it back; its tables go at the end.

    They lie in a database of their own, so Spark itself removes them. What is made from them has
    to be materialised before, by cut() for one.
    """
    name = f"scratch_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{checkpoint_folder(spark)}/{name}'")
    count = iter(range(1 << 30))

    def store(df: DataFrame) -> DataFrame:
        at = f"{name}.t{next(count)}"
        df.write.format("parquet").saveAsTable(at)
        return spark.table(at)

    try:
        yield store
    finally:
        spark.sql(f"DROP DATABASE {name} CASCADE")


#: Documents that go to a Python worker at a time. At Spark's default of 10,000 a batch of whole
#: documents takes some hundred MB in the JVM and the worker.
BATCH_ROWS = 1000


def in_small_batches(df: DataFrame) -> DataFrame:
    """df, after the session's Arrow batches have been limited to BATCH_ROWS rows (lower settings stay)."""
    conf, name = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(name)) <= BATCH_ROWS:
        conf.set(name, str(BATCH_ROWS))
    return df


def first_row_key() -> int:
    """Start of this task's own range of row keys: no two tasks of a stage share one."""
    context = TaskContext.get()
    return (context.partitionId() if context else 0) << 40


#: A table of so many rows at most (counted before) is broadcast.
BROADCAST_ROWS = 100_000
#: Groups of more than one part in so many of all rows are joined by broadcast: there are fewer of them.
HOT_GROUPS = 1000


def join_groups(df: DataFrame, groups: DataFrame, group: str, rows: str = "group_rows") -> DataFrame:
    """df with the columns that `groups` has for each row's group (null is a group), whatever share of the rows a group has.

    `rows` is the number of rows in a row's group. Both tables have a column `group`.
    """
    theirs = groups.withColumnRenamed(group, "_group")
    same = F.col(group).eqNullSafe(F.col("_group"))
    if groups.count() <= BROADCAST_ROWS:
        return df.join(F.broadcast(theirs), same).drop("_group")
    hot = F.col(rows) > df.count() / HOT_GROUPS
    large = df.filter(hot).select(F.col(group).alias("_group")).distinct()
    few = theirs.join(F.broadcast(large.withColumnRenamed("_group", "_hot")), F.col("_group").eqNullSafe(F.col("_hot"))).drop("_hot")
    return df.filter(hot).join(F.broadcast(few), same).unionByName(df.filter(~hot).join(theirs, same)).drop("_group")


def in_order(df: DataFrame, groups: Sequence[str], order: Sequence[Column], sums: Sequence[str] = ()) -> DataFrame:
    """df with `place`, each row's place in its group in `order` (from 0), `group_rows`, and `<c>_before`, the sum of c over the rows before it.

    Rows are dealt to ranges of (groups, order), so a group may be as large as all rows: each range
    is numbered by itself and what lies before it in its group is added. Null is a group like any
    other. Rows equal in `order` stand in any order among each other. Only DataFrame functions.
    """
    own = cut(df)  # the sample of the ranges and their shuffle read the same rows
    by = [*(F.col(c) for c in groups), *order, F.col("_tie")]
    ranged = own.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(*by).sortWithinPartitions(*by).drop("_tie")
    at = cut(ranged).withColumn("_at", F.monotonically_increasing_id()).withColumn("_part", F.shiftright("_at", 33))
    before = Window.partitionBy(*groups).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = at.groupBy("_part", *groups).agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_rows"), *[F.sum(c).alias(f"_sum_{c}") for c in sums])
    runs = cut(
        runs.select(
            F.col("_part").alias("_run_part"),
            *[F.col(c).alias(f"_run_{c}") for c in groups],
            (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
            F.sum("_rows").over(Window.partitionBy(*groups)).alias("group_rows"),
            *[F.coalesce(F.sum(f"_sum_{c}").over(before), F.lit(0)).alias(f"_before_{c}") for c in sums],
        )
    )  # a row for each range and for each group
    if runs.count() <= BROADCAST_ROWS:
        runs = F.broadcast(runs)
    here = F.col("_part") == F.col("_run_part")
    for c in groups:
        here = here & F.col(c).eqNullSafe(F.col(f"_run_{c}"))
    inside = Window.partitionBy("_part", *groups).orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    if sums:
        at = at.withColumns({f"_inside_{c}": F.coalesce(F.sum(c).over(inside), F.lit(0)) for c in sums})
    return at.join(runs, here).select(*df.columns, (F.col("_at") + F.col("_shift")).alias("place"), "group_rows", *[(F.col(f"_inside_{c}") + F.col(f"_before_{c}")).alias(f"{c}_before") for c in sums])
