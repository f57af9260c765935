"""Schemas of JSON payloads: inferred over all rows or over samples, and audited for drift."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _as_ddl(c: Column) -> Column:
    """What schema_of_variant_agg writes, as a type that from_json reads."""
    c = F.regexp_replace(c, "OBJECT<", "STRUCT<")
    return F.regexp_replace(c, r"\bVOID\b", "STRING")


def schema_agg(payload: Column) -> Column:
    """Aggregate: the merged schema of all payloads as DDL. Text that isn't JSON has no part in it."""
    return _as_ddl(F.schema_of_variant_agg(F.try_parse_json(payload)))


def infer(df: DataFrame, payload: str = "payload") -> str:
    """One distributed aggregate over all rows; only the DDL string reaches the driver."""
    return df.filter(F.col(payload).isNotNull()).agg(schema_agg(F.col(payload)).alias("s")).first()["s"]


def infer_by(df: DataFrame, *keys: str, payload: str = "payload") -> DataFrame:
    return df.groupBy(*keys).agg(schema_agg(F.col(payload)).alias("schema_json"))


def sample_rows(df: DataFrame, groups: Sequence[str], n: int, seed: int = 17, by: str | None = None) -> DataFrame:
    """Exactly n rows of each group, all of a smaller one, whichever a seeded hash puts first, of the row or of a column: the same ones at every run.

    Every task keeps n rows a group before the shuffle, and the window above gets no more than n from
    each task, so no group is gathered as a whole. Beyond a thousand rows Spark keeps none back by
    itself, so groups are dealt to parts then, which keep n each first. Rows that are equal in all
    columns are alike.
    """
    first = F.xxhash64(F.lit(seed), *df.columns) if by is None else F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(by).cast("string")))
    order = [first, *[F.col(c) for c, kind in df.dtypes if not kind.startswith(("map", "variant"))]]
    kept = df
    if n > 1000:
        own = Window.partitionBy(*groups, "_part").orderBy(*order)
        kept = df.withColumn("_part", F.pmod(F.xxhash64(F.lit(seed + 1), *df.columns), F.lit(256))).withColumn("_rn", F.row_number().over(own)).filter(F.col("_rn") <= n).select(*df.columns)
    return kept.withColumn("_rn", F.row_number().over(Window.partitionBy(*groups).orderBy(*order))).filter(F.col("_rn") <= n).drop("_rn")


def infer_rows(df: DataFrame, n: int, *groups: str, seed: int = 17, payload: str = "payload") -> DataFrame:
    """The schema of each group (endpoint) by exactly n of its payloads: rows (groups, schema_json)."""
    return infer_by(sample_rows(df.filter(F.col(payload).isNotNull()).select(*groups, payload), groups, n, seed), *groups, payload=payload)


def infer_random(df: DataFrame, n: int = 10, seed: int = 17, payload: str = "payload") -> str:
    """From n random rows: a top-n, so nothing is sorted as a whole."""
    return infer(df.orderBy(F.rand(seed)).limit(n), payload)


def infer_recent(df: DataFrame, run: Column, at: str = "ingest_ts_utc", months: int = 6, n: int = 10, seed: int = 17, payload: str = "payload") -> str:
    """From n random rows with a payload of the last months, but not of the run's own day."""
    day = F.to_date(at)
    return infer_random(df.filter((day >= F.add_months(run, -months)) & (day != run) & F.col(payload).isNotNull()), n, seed, payload)


def infer_fraction(df: DataFrame, fraction: float = 0.07, seed: int = 17, payload: str = "payload") -> str:
    """From a Bernoulli sample, from all rows if that is empty."""
    some = df.sample(fraction, seed)
    return infer(df if some.isEmpty() else some, payload)


def infer_one(df: DataFrame, payload: str = "payload") -> str:
    """From one payload, whichever comes first: no more is read than that."""
    return infer(df.filter(F.col(payload).isNotNull()).limit(1), payload)


def drift(audit: DataFrame, current: DataFrame, as_of: Column) -> DataFrame:
    """The audit (table_name, endpoint, schema_json, schema_hash, schema_drift_ind, last_check_dte) after a check.

    current: table_name, endpoint, schema_json. A changed schema replaces the old one and sets the
    flag, an equal one clears it; either way the check's time is noted.
    """
    now = current.withColumn("schema_hash", F.sha2("schema_json", 256))
    a, c = audit.alias("a"), now.alias("c")
    both = a.join(c, ["table_name", "endpoint"], "full_outer")
    seen = F.col("c.schema_hash").isNotNull()
    return both.select(
        "table_name",
        "endpoint",
        F.coalesce("c.schema_json", "a.schema_json").alias("schema_json"),
        F.coalesce("c.schema_hash", "a.schema_hash").alias("schema_hash"),
        F.when(seen & F.col("a.schema_hash").isNotNull(), F.col("a.schema_hash") != F.col("c.schema_hash")).when(seen, F.lit(False)).otherwise(F.col("a.schema_drift_ind")).alias("schema_drift_ind"),
        F.when(seen, as_of).otherwise(F.col("a.last_check_dte")).alias("last_check_dte"),
    )


# ---------------------------------------------------------------- structural drift

# Numbers from narrow to wide; each holds what those before it hold (a double nearly).
_NUMBERS = ("tinyint", "smallint", "int", "bigint", "decimal", "float", "double")


def _holds(wide: T.DataType, narrow: T.DataType) -> bool:
    """Whether all values of one scalar type have their place in another, unlike one."""
    w, n = wide.simpleString(), narrow.simpleString()
    if isinstance(wide, T.StringType):
        return not isinstance(narrow, (T.StringType, T.StructType, T.ArrayType, T.MapType))
    if isinstance(wide, T.DecimalType) and isinstance(narrow, T.DecimalType):
        return wide != narrow and wide.scale >= narrow.scale and wide.precision - wide.scale >= narrow.precision - narrow.scale
    places = [_NUMBERS.index(x.partition("(")[0]) for x in (w, n) if x.partition("(")[0] in _NUMBERS]
    return places[0] > places[1] if len(places) == 2 else (w, n) in (("timestamp", "date"), ("timestamp_ntz", "date"))


def widened(stored: T.DataType, current: T.DataType) -> T.DataType:
    """A type that holds what either holds: fields of both, the stored ones first; of two scalars the wider; text for what has nothing in common."""
    if stored == current:
        return stored
    if isinstance(stored, T.StructType) and isinstance(current, T.StructType):
        theirs = {f.name: f.dataType for f in current}
        fields = [T.StructField(f.name, widened(f.dataType, theirs.pop(f.name)) if f.name in theirs else f.dataType) for f in stored]
        return T.StructType([*fields, *[T.StructField(n, kind) for n, kind in theirs.items()]])
    if isinstance(stored, T.ArrayType) and isinstance(current, T.ArrayType):
        return T.ArrayType(widened(stored.elementType, current.elementType))
    for one, other in ((stored, current), (current, stored)):
        if not isinstance(one, (T.StructType, T.ArrayType, T.MapType)) and _holds(one, other):
            return one
    both = [_NUMBERS.index(x.simpleString().partition("(")[0]) for x in (stored, current) if x.simpleString().partition("(")[0] in _NUMBERS]
    return T.DoubleType() if len(both) == 2 else T.StringType()


def _scalars(kind: T.DataType, at: str = "") -> list[tuple[str, str]]:
    """(path, type) of every value; a container without any is its own value. Elements of arrays are []."""
    if isinstance(kind, T.StructType) and len(kind):
        return [x for f in kind for x in _scalars(f.dataType, f"{at}.{f.name}" if at else f.name)]
    if isinstance(kind, T.ArrayType):
        return _scalars(kind.elementType, f"{at}[]")
    return [(at, kind.simpleString())]


def drift_paths(audit: DataFrame, current: DataFrame) -> DataFrame:
    """What of a payload's tree differs from the stored schema: rows (table_name, endpoint, path, change, stored_type, current_type).

    Both tables have table_name, endpoint and schema_json, one row for each endpoint; those reach
    the driver to be read, no payload does. A change is added, removed, widened (the stored type has
    no place for all current values), narrowed (it has), or retyped (neither holds the other).
    Endpoints that only one side has are new or gone as a whole and have no rows.
    """
    spark = audit.sparkSession
    paths = lambda df: spark.createDataFrame([(r.table_name, r.endpoint, p, kind) for r in df.collect() for p, kind in _scalars(T.DataType.fromDDL(r.schema_json))], "table_name string, endpoint string, path string, type string")
    known, found = paths(audit), paths(current)
    pairs = {(a, b) for a, b in known.join(found.withColumnRenamed("type", "to"), ["table_name", "endpoint", "path"]).filter("type <> to").select("type", "to").distinct().collect()}
    wider = lambda a, b: _holds(T.DataType.fromDDL(b), T.DataType.fromDDL(a))
    kinds = {p: "widened" if wider(*p) else "narrowed" if wider(p[1], p[0]) else "retyped" for p in pairs}
    known, found = known.withColumnRenamed("type", "stored_type"), found.withColumnRenamed("type", "current_type")
    ends = known.select("table_name", "endpoint").distinct().join(found.select("table_name", "endpoint").distinct(), ["table_name", "endpoint"])
    both = known.join(found, ["table_name", "endpoint", "path"], "full_outer").join(ends, ["table_name", "endpoint"], "left_semi")
    change = F.when(F.col("stored_type").isNull(), "added").when(F.col("current_type").isNull(), "removed")
    for (a, b), kind in kinds.items():
        change = change.when((F.col("stored_type") == a) & (F.col("current_type") == b), kind)
    return both.filter(~F.col("stored_type").eqNullSafe(F.col("current_type"))).select("table_name", "endpoint", "path", change.alias("change"), "stored_type", "current_type")


def widen_stored(audit: DataFrame, current: DataFrame, as_of: Column) -> DataFrame:
    """The audit after a check that keeps what payloads had before: the stored schema takes up new paths and wider types and loses none.

    The flag is set where it had to change, so a payload that lacks a field for once is no drift.
    """
    spark: SparkSession = audit.sparkSession
    known = {(r.table_name, r.endpoint): T.DataType.fromDDL(r.schema_json) for r in audit.select("table_name", "endpoint", "schema_json").collect()}
    wide = []
    for r in current.select("table_name", "endpoint", "schema_json").collect():  # a row for each endpoint
        kind = T.DataType.fromDDL(r.schema_json)
        stored = known.get((r.table_name, r.endpoint))
        wide.append((r.table_name, r.endpoint, (kind if stored is None else widened(stored, kind)).simpleString()))
    at = spark.createDataFrame(wide, "table_name string, endpoint string, schema_json string")
    tidy = spark.createDataFrame([(t, e, kind.simpleString()) for (t, e), kind in known.items()], "table_name string, endpoint string, _tidy string")
    same = audit.join(tidy, ["table_name", "endpoint"]).withColumns({"schema_json": F.col("_tidy"), "schema_hash": F.sha2("_tidy", 256)}).drop("_tidy")
    return drift(same, at, as_of)
