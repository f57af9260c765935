"""Choosing rows: latest, best, in order, and past the quality rules."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarnfold.functions.compare import any_of


def best_row(df: DataFrame, keys: Sequence[str], *order: Column) -> DataFrame:
    """One row for each key: the first by `order`.

    max_by-style aggregation would shuffle less than all rows; a window keeps whole rows of any
    width, and Spark limits each task's groups to their first row before the shuffle.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def latest(df: DataFrame, keys: Sequence[str], by: str, *ties: str) -> DataFrame:
    return best_row(df, keys, F.col(by).desc_nulls_last(), *[F.col(c) for c in ties])


def one_each(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row for each key, whichever, with map-side combining."""
    return df.dropDuplicates(list(keys))


def with_ordinal(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "event_idx") -> DataFrame:
    """Position from 0 of each row among those of its key."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1)


def at_maximum(df: DataFrame, column: str) -> DataFrame:
    """Rows at the greatest value of a column: an aggregate of one row and a filter, no global window."""
    return df.join(F.broadcast(df.agg(F.max(column).alias("_m"))), F.col(column) == F.col("_m"), "left_semi")


def every_nth_date(dates: DataFrame, keys: Sequence[str], date: str, n: int = 15, cold: Column | None = None) -> DataFrame:
    """Distinct dates of each key with their number from 1 and whether it is a multiple of n, or all is new."""
    w = Window.partitionBy(*keys).orderBy(date)
    out = dates.select(*keys, date).distinct().withColumn("date_idx", F.row_number().over(w))
    return out.withColumn("retry", (F.col("date_idx") % n == 0) | (F.lit(False) if cold is None else cold))


def top(df: DataFrame, n: int, *order: Column) -> DataFrame:
    """The first n rows: each task keeps n, so nothing is sorted as a whole."""
    return df.orderBy(*order).limit(n)


def reasons(rules: Mapping[str, Column]) -> Column:
    """Names of the rules that a row breaks."""
    return F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in rules.items()]))


def flagged(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Adds quarantine_reason, null for good rows: one pass, from which both ways can be filtered."""
    return df.withColumn("quarantine_reason", F.when(any_of(rules), F.concat_ws("; ", reasons(rules))))


def quarantine(df: DataFrame, rules: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(good rows, bad rows with quarantine_reason)."""
    out = flagged(df, rules)
    return out.filter("quarantine_reason is null").drop("quarantine_reason"), out.filter("quarantine_reason is not null")


def event_rules(shot_types: Sequence[str]) -> dict[str, Column]:
    return {
        "event_type is null": F.col("event_type").isNull(),
        "time_in_period is null": F.col("time_in_period").isNull(),
        "time_remaining is null": F.col("time_remaining").isNull(),
        "situation_code is null": F.col("situation_code").isNull() & F.coalesce(F.col("event_type").isin(*shot_types), F.lit(False)),
    }


def shift_rules() -> dict[str, Column]:
    return {f"{c} is null": F.col(c).isNull() for c in ("player_id", "start_time", "end_time")}


def lookup(df: DataFrame, dimension: DataFrame, on: Mapping[str, str], values: Mapping[str, str], how: str = "left") -> DataFrame:
    """Adds a dimension's values. Spark broadcasts it if it is below the session's threshold, else it shuffles."""
    d = dimension.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(on.values())], *[F.col(v).alias(n) for n, v in values.items()])
    condition = F.lit(True)
    for i, c in enumerate(on):
        condition = condition & (df[c] == d[f"_k{i}"])
    return df.join(d, condition, how).drop(*[f"_k{i}" for i in range(len(on))])


def unpivot_roles(df: DataFrame, keep: Sequence[str], roles: Sequence[str], dropped: Sequence[str] = ()) -> DataFrame:
    """A row (role, player_id) for each role column that isn't null."""
    items = [F.struct(F.lit(r).alias("role"), F.col(r).cast("bigint").alias("player_id")) for r in roles if r not in dropped]
    return df.select(*keep, F.explode(F.array(*items)).alias("_r")).select(*keep, "_r.*").filter("player_id is not null")
