"""Declared tables in Spark's catalog: merges written as a change feed first, then into the partitions they touch.

A layer is a database. Next to a table lies its feed, `<name>_changes`, a partition for each commit.
A commit writes its feed and then applies it; what it applies is the feed's last image of each key,
so a commit that comes again after a failure finds its feed and applies the same rows again.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarnfold.operators.merge import Merged, apply_changes
from tarnfold.operators.shred import Rule, targets
from tarnfold.operators.stages import cut, few

AUDIT = [T.StructField("insert_dte", T.TimestampType()), T.StructField("update_dte", T.TimestampType()), T.StructField("py_source", T.StringType())]
FEED = "_change_type string, _logic_block string"


@dataclass(frozen=True)
class Table:
    """A layer's table: its schema, merge key, the columns it is laid out and partitioned by, or its number of buckets by key."""

    layer: str
    name: str
    schema: T.StructType
    key: tuple[str, ...]
    cluster_by: tuple[str, ...] = ()
    partition_by: tuple[str, ...] = ()
    buckets: int = 0

    def __post_init__(self) -> None:
        if self.buckets and self.partition_by:
            raise ValueError(f"{self.name}: buckets by key or partitions, not both")

    @property
    def full(self) -> str:
        return f"{self.layer}.{self.name}"

    @property
    def feed(self) -> str:
        return f"{self.full}_changes"


def table_of(layer: str, name: str, rules: Mapping[str, Rule], key: Sequence[str], more: str = "", cluster_by: Sequence[str] = (), partition_by: Sequence[str] = (), buckets: int = 0) -> Table:
    """A table declared by the rules that shred its payloads: their columns, `more` as DDL, and the audit columns. Its key is required."""
    fields = [T.StructField(n, T.DataType.fromDDL(kind)) for n, kind in targets(rules).items()]
    fields += [f for f in (T.StructType.fromDDL(more) if more else T.StructType()) if f.name not in {g.name for g in fields}]
    lacking = [k for k in (*key, *cluster_by, *partition_by) if k not in {f.name for f in fields}]
    if lacking:
        raise ValueError(f"{name}: no column {lacking}")
    required = {*key} | {f.name for f in fields if not f.nullable}
    return Table(layer, name, T.StructType([T.StructField(f.name, f.dataType, f.name not in required) for f in fields] + AUDIT), tuple(key), tuple(cluster_by), tuple(partition_by), buckets)


# ---------------------------------------------------------------- declaring and looking up


def declare(spark: SparkSession, table: Table) -> None:
    """Makes the table and its feed if they are not there, so that nothing is inferred at a first write."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {table.layer}")
    settle(spark, table)
    _create(spark, table, table.full)
    own = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in table.schema)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table.feed} ({FEED}, {own}, _order int, _commit string) USING parquet PARTITIONED BY (_order, _commit)")


def _create(spark: SparkSession, table: Table, name: str) -> None:
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in table.schema)
    by = f"PARTITIONED BY ({', '.join(table.partition_by)})" if table.partition_by else ""
    key = ", ".join(table.key)
    if table.buckets:
        by = f"CLUSTERED BY ({key}) SORTED BY ({key}) INTO {table.buckets} BUCKETS"
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet {by}")


def exists(spark: SparkSession, table: Table) -> bool:
    return spark.catalog.tableExists(table.full)


def having_column(spark: SparkSession, column: str, *layers: str) -> list[str]:
    """Full names of the tables of some layers that have a column; feeds are none of them."""
    found = []
    for layer in layers:
        if spark.catalog.databaseExists(layer):
            names = [t.name for t in spark.catalog.listTables(layer) if not t.name.endswith("_changes")]
            found += [f"{layer}.{n}" for n in names if any(c.name == column for c in spark.catalog.listColumns(f"{layer}.{n}"))]
    return sorted(found)


def read(spark: SparkSession, table: Table) -> DataFrame:
    settle(spark, table)
    return spark.table(table.full).select(table.schema.fieldNames())  # partition columns come last in the catalog


def changes(spark: SparkSession, table: Table) -> DataFrame:
    """The change feed of all commits: _order, _commit, _change_type, _logic_block and the table's columns."""
    return spark.table(table.feed).select("_order", "_commit", "_change_type", "_logic_block", *table.schema.fieldNames())


def commits(spark: SparkSession, table: Table) -> dict[str, int]:
    """Key to order of the commits that wrote a feed; from the catalog, no data are read.

    Keys may hold any characters; the catalog names partitions as paths, in which some are escaped.
    """
    named = [r[0] for r in spark.sql(f"SHOW PARTITIONS {table.feed}").collect()]  # a row for each commit
    parts = ({k: unquote(v) for k, v in (p.split("=", 1) for p in name.split("/"))} for name in named)
    return {p["_commit"]: int(p["_order"]) for p in parts}


# ---------------------------------------------------------------- writing


def replace(spark: SparkSession, table: Table, df: DataFrame) -> None:
    """The table's rows are df's, which may be made of them, with the declared types and order.

    They are written beside the table and take its name when they are all there; settle() ends an
    exchange of names that was cut off.
    """
    settle(spark, table)
    following = f"{table.full}__next"
    spark.sql(f"DROP TABLE IF EXISTS {following}")
    _create(spark, table, following)
    laid_out(table, _declared(table, df)).select(*_stored_order(table)).write.insertInto(following)
    spark.sql(f"ALTER TABLE {table.full} RENAME TO {table.full}__last")
    settle(spark, table)


def append(spark: SparkSession, table: Table, df: DataFrame) -> None:
    """Adds rows, of tables without a key: quarantined ones."""
    laid_out(table, _declared(table, df)).select(*_stored_order(table)).write.insertInto(table.full)


def settle(spark: SparkSession, table: Table) -> None:
    """If a replacement was cut off between its two renamings, the new rows are whole and take the name; else the old ones keep it."""
    there = spark.catalog.tableExists
    if there(f"{table.full}__last"):
        if not there(table.full):
            spark.sql(f"ALTER TABLE {table.full}__next RENAME TO {table.full}")
        spark.sql(f"DROP TABLE {table.full}__last")


def commit(spark: SparkSession, table: Table, merged: Merged, key: str | None = None) -> dict[tuple[str, str], int]:
    """A merge into the table, and its counts by change and clause: see commit_all."""
    return commit_all(spark, {table: merged}, key)[table]


def commit_all(spark: SparkSession, merges: Mapping[Table, Merged], key: str | None = None) -> dict[Table, dict[tuple[str, str], int]]:
    """Merges into several tables under one key. First all feeds are written, then all are applied.

    A feed that is there already under this key is not made again: the key was committed before, or
    cut off in between, and its feed is applied (again), which changes nothing that is in place. So
    after any failure the same call leaves each table with the merge applied once, be it one that
    sets values or one that counts. The counts come from the write of the feed itself; they are empty
    for a feed that was there.
    """
    counts = {table: _write_feed(spark, table, merged, key) for table, merged in merges.items()}
    for table, (order, _) in counts.items():
        if order is not None:
            _apply(spark, table, order)
    return {table: found for table, (_, found) in counts.items()}


def _write_feed(spark: SparkSession, table: Table, merged: Merged, key: str | None) -> tuple[int | None, dict[tuple[str, str], int]]:
    """(order of the commit or None if it changes nothing, counts)."""
    settle(spark, table)
    known = commits(spark, table)
    if key in known:
        return known[key], {}
    order = 1 + max(known.values(), default=0)
    observed, counted = merged.counted()
    typed = _declared(table, observed.changes, "_change_type", "_logic_block")
    _into_partitions(typed.withColumns({"_order": F.lit(order), "_commit": F.lit(key or f"commit-{order}")}), table.feed)
    counts = counted()
    return (order if counts else None), counts


def _apply(spark: SparkSession, table: Table, order: int) -> None:
    """Brings a commit's last images into the table; of a partitioned one only touched partitions are read and written."""
    feed = changes(spark, table).filter(F.col("_order") == order)
    if not table.partition_by:
        replace(spark, table, apply_changes(read(spark, table), feed, table.key))
        return
    by = list(table.partition_by)
    touched = cut(feed.select(*by).distinct())
    rows = cut(apply_changes(_within(read(spark, table), touched, by), feed, table.key))
    _into_partitions(laid_out(table, _declared(table, rows)).select(*_stored_order(table)), table.full)
    emptied = touched.join(rows.select(*[F.col(c).alias(f"_{c}") for c in by]).distinct(), _equal(by), "left_anti")
    for r in emptied.collect():  # partitions that have lost their last row
        spec = ", ".join(f"{c} = {'NULL' if r[c] is None else _literal(str(r[c]))}" for c in by)
        spark.sql(f"ALTER TABLE {table.full} DROP IF EXISTS PARTITION ({spec})")


def _into_partitions(df: DataFrame, name: str) -> None:
    """Overwrites the partitions that df has rows of. insertInto takes the mode from the session alone."""
    conf, mode = df.sparkSession.conf, "spark.sql.sources.partitionOverwriteMode"
    before = conf.get(mode)
    conf.set(mode, "dynamic")
    try:
        df.write.insertInto(name, overwrite=True)
    finally:
        conf.set(mode, before)


def _equal(by: Sequence[str]) -> Column:
    out = F.lit(True)
    for c in by:
        out = out & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return out


def _within(df: DataFrame, touched: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows of the touched partitions: the other files are not read, as Spark prunes by the join."""
    return df.join(few(touched.select(*[F.col(c).alias(f"_{c}") for c in by])), _equal(by), "left_semi")


def compact(spark: SparkSession, table: Table, part: Column | None = None) -> None:
    """Rewrites (part of) a table in its layout and in files of even size."""
    df = read(spark, table)
    if not table.partition_by:
        replace(spark, table, df)
        return
    _into_partitions(laid_out(table, cut(df if part is None else df.filter(part))).select(*_stored_order(table)), table.full)


def forget(spark: SparkSession, table: Table, keep: int) -> None:
    """Drops the feeds of all but the last commits. Keep more than may be written between a commit and its repeat."""
    for key, order in sorted(commits(spark, table).items(), key=lambda x: x[1])[: -max(keep, 1)]:
        spark.sql(f"ALTER TABLE {table.feed} DROP IF EXISTS PARTITION (_order = {order}, _commit = {_literal(key)})")


def analyze(spark: SparkSession, table: Table, *columns: str) -> None:
    """Row count and size, and statistics of some columns, for the optimizer."""
    of = f"FOR COLUMNS {', '.join(columns)}" if columns else ""
    spark.sql(f"ANALYZE TABLE {table.full} COMPUTE STATISTICS {of}")


def _literal(text: str) -> str:
    """A text in SQL."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _stored_order(table: Table) -> list[str]:
    names = table.schema.fieldNames()
    return [c for c in names if c not in table.partition_by] + list(table.partition_by)


def _declared(table: Table, df: DataFrame, *before: str) -> DataFrame:
    """The declared columns, types and order; a null in a required one fails the write, as parquet makes no such check."""
    df = df.select(*before, *[F.col(f.name).cast(f.dataType).alias(f.name) for f in table.schema])
    must = [f.name for f in table.schema if not f.nullable]
    if not must:
        return df
    whole = F.lit(True)
    for c in must:
        whole = whole & F.col(c).isNotNull()
    check = F.when(~whole, F.raise_error(F.lit(f"null in a required column of {table.name}: {must}"))).otherwise(F.col(must[0]))
    return df.withColumn(must[0], check.cast(table.schema[must[0]].dataType))


def laid_out(table: Table, df: DataFrame) -> DataFrame:
    """A file a bucket, or files that hold ranges of the layout's columns, so their statistics prune, or evenly sized ones."""
    if table.buckets:
        return df.repartition(table.buckets, *table.key)
    if table.cluster_by:
        by = list(dict.fromkeys([*table.partition_by, *table.cluster_by]))
        return df.repartitionByRange(*by).sortWithinPartitions(*by)
    return df.hint("rebalance")
