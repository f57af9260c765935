"""Batch merges over streams: each micro-batch is merged into its tables, once.

A commit's key is made of the stream's checkpoint and the batch's number. A batch that comes again
after a failure, wherever that was, leaves the tables as one run of it would: see commit_all.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from tarnfold.operators.merge import Delete, Insert, Merged, Update, may_match, merge
from tarnfold.operators.rows import latest
from tarnfold.plans.jobs import bronze_merge
from tarnfold.sources.envelope import as_envelope, split_found
from tarnfold.sources.tables import Table, commit_all, read


def stream_into(stream: DataFrame, job: Callable[[DataFrame], Mapping[Table, Merged]], checkpoint: str, once: bool = True) -> StreamingQuery:
    """Runs job on every micro-batch and commits its merges, of one table or several, under the batch's key."""
    stream_id = hashlib.sha1(checkpoint.encode()).hexdigest()[:12]
    writer = stream.writeStream.foreachBatch(lambda batch, n: commit_all(batch.sparkSession, job(batch), f"{stream_id}-{n}") and None).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def merge_stream(stream: DataFrame, table: Table, keys: Sequence[str], by: str, job: Callable[[DataFrame, DataFrame], Merged], checkpoint: str, once: bool = True) -> StreamingQuery:
    """Merges the latest row of each key of every micro-batch, with its change feed."""
    return stream_into(stream, lambda batch: {table: job(read(batch.sparkSession, table), latest(batch, keys, by))}, checkpoint, once)


def ledger_merge(ledger: DataFrame, empty: DataFrame, found: DataFrame, keys: Sequence[str], run: Column, days: int = 15) -> Merged:
    """The retry ledger after a batch: games that came leave it, those tried in vain that are due, or new, count one attempt more.

    A key that came and was tried in vain in one batch has come.
    """
    came = found.select(*keys).distinct().withColumn("_came", F.lit(True))
    tried = empty.select(*keys).distinct().withColumn("_came", F.lit(False))
    source = came.unionByName(tried).groupBy(*keys).agg(F.max("_came").alias("_came"))
    new = {"attempt_count": lambda t, s: t("attempt_count") + 1, "last_attempt_dte": lambda t, s: run, "next_retry_dte": lambda t, s: F.date_add(run, days)}
    return merge(
        ledger,
        source,
        keys,
        matched=[Delete(lambda t, s: s("_came"), "arrived"), Update(new, lambda t, s: t("next_retry_dte") <= run, "retry")],
        not_matched=[Insert(new | {"attempt_count": lambda t, s: F.lit(1)}, lambda t, s: ~s("_came"), "missing")],
    )


def land(batch: DataFrame, landing: Table, ledger: Table, list_name: str, run: Column, now: Column, days: int = 15) -> dict[Table, Merged]:
    """Landed responses of a batch: those with content into the landing table, the keys of the others into the ledger.

    Both tables are keyed by request_key (the landing table by endpoint too); of several responses
    to a request the latest with content counts. A request that has landed before is not missing if
    it is answered without content now; the landing table is not shuffled to tell that.
    """
    found, empty = split_found(as_envelope(batch), list_name)
    spark = batch.sparkSession
    best = latest(found, landing.key, "ingest_ts_utc", "payload")
    there = may_match(read(spark, landing).select(*ledger.key), empty.select(*ledger.key), ledger.key)
    return {
        landing: bronze_merge(read(spark, landing), best.drop("ingest_ts_utc"), landing.key, now, list_name),
        ledger: ledger_merge(read(spark, ledger), empty, found.select(*ledger.key).unionByName(there), ledger.key, run, days),
    }


def land_stream(stream: DataFrame, landing: Table, ledger: Table, list_name: str, run: Column, now: Column, checkpoint: str, days: int = 15) -> StreamingQuery:
    """land() on every micro-batch: both tables get a batch or neither does."""
    return stream_into(stream, lambda batch: land(batch, landing, ledger, list_name, run, now, days), checkpoint)
