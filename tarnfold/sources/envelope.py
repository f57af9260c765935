"""Landed responses of an HTTP source as rows, and work-list addresses for it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

ENVELOPE = T.StructType(
    [
        T.StructField("endpoint", T.StringType(), False),
        T.StructField("request_key", T.StringType(), False),
        T.StructField("http_status", T.IntegerType()),
        T.StructField("payload", T.StringType()),
        T.StructField("api_url", T.StringType()),
        T.StructField("ingest_ts_utc", T.TimestampType()),
    ]
)


def read_landed(spark: SparkSession, path: str) -> DataFrame:
    """Landed JSON lines with the envelope's schema: nothing is inferred, and nothing scanned for it."""
    return as_envelope(spark.read.schema(ENVELOPE).json(path))


def stream_landed(spark: SparkSession, path: str) -> DataFrame:
    return as_envelope(spark.readStream.schema(ENVELOPE).json(path))


def as_envelope(df: DataFrame) -> DataFrame:
    """Top-level lists become {"data": [...]}; only a response of status 200 has a payload."""
    listed = F.ltrim(F.col("payload")).startswith("[")
    payload = F.when(listed, F.concat(F.lit('{"data":'), F.col("payload"), F.lit("}"))).otherwise(F.col("payload"))
    return df.withColumn("payload", F.when(F.col("http_status") == 200, payload))


def typed_rows(spark: SparkSession, rows: list[tuple], schema: T.StructType = ENVELOPE) -> DataFrame:
    """A few rows with a declared schema, null checks of which createDataFrame makes."""
    return spark.createDataFrame(rows, schema)


def api_url(base: str, key: Column, suffix: str) -> Column:
    return F.concat(F.lit(base), key.cast("string"), F.lit(suffix))


EMPTY_LIST = r'"{name}"\s*:\s*\[\s*(?:\{{\s*\}}\s*)?\]'


def has_content(payload: Column, list_name: str | None = None) -> Column:
    """False for null, [], {}, text that isn't JSON, and an empty list (or one empty object) of that name."""
    good = payload.isNotNull() & ~F.trim(payload).isin("", "[]", "{}") & F.get_json_object(payload, "$").isNotNull()
    if list_name:
        good = good & payload.rlike(rf'"{list_name}"\s*:') & ~payload.rlike(EMPTY_LIST.format(name=list_name))
    return F.coalesce(good, F.lit(False))


def split_found(df: DataFrame, list_name: str) -> tuple[DataFrame, DataFrame]:
    """(rows to merge, rows for the retry ledger): complements, so each row is in exactly one."""
    ok = F.coalesce(F.col("http_status") == 200, F.lit(False)) & has_content(F.col("payload"), list_name)
    return df.filter(ok), df.filter(~ok)


def request_health(responses: DataFrame, last: int = 50, endpoint: str = "endpoint", order: tuple[str, ...] = ("ingest_ts_utc", "request_key"), block: int = 100_000) -> DataFrame:
    """Rates over each endpoint's last responses, and whether to go slower or faster.

    order begins with a timestamp. A row's place in its endpoint is the number of rows of earlier
    hours and its place in its hour; blocks of places, with the rows before them that they look back
    on, are the windows' partitions. So no task holds an endpoint's whole history.
    """
    block = max(block, last)  # so a row is looked back on from two blocks at most
    hours = responses.withColumn("_hour", F.date_trunc("hour", order[0]))
    counts = hours.groupBy(endpoint, "_hour").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.partitionBy("_e").orderBy(F.col("_h").asc_nulls_first())) - F.col("_n")
    starts = counts.withColumnsRenamed({endpoint: "_e", "_hour": "_h"}).withColumn("_before", before).drop("_n")
    placed = hours.withColumn("_at", F.row_number().over(Window.partitionBy(endpoint, "_hour").orderBy(*order)))
    placed = placed.join(starts, placed[endpoint].eqNullSafe(starts["_e"]) & placed["_hour"].eqNullSafe(starts["_h"])).withColumn("_at", F.col("_before") + F.col("_at") - 1).drop("_e", "_h", "_hour", "_before")
    own = F.floor(F.col("_at") / block)
    blocks = placed.withColumn("_block", F.explode(F.array_distinct(F.array(own, F.floor((F.col("_at") + last - 1) / block)))))

    w = Window.partitionBy(endpoint, "_block").orderBy("_at").rowsBetween(-(last - 1), 0)
    rate = lambda c: F.avg(F.when(c, 1.0).otherwise(0.0)).over(w)
    status = F.col("http_status")
    out = blocks.withColumns(
        {
            "rate_429": rate(status == 429),
            "rate_retryable": rate(status.isin(429, 500, 502, 503, 504)),
            "rate_error": rate(status.isNull() | (status >= 400)),
            "seen": F.count(F.lit(1)).over(w),
        }
    ).filter(F.col("_block") == own).drop("_at", "_block")
    return out.withColumn("advice", F.when(F.col("rate_429") > 0.05, "down").when((F.col("rate_error") == 0) & (F.col("seen") >= last), "up").otherwise("hold"))
