"""Registered queries over stored tables, their feeds, streams and schemas; further sides of jobs that tarnfold.queries has."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarnfold.operators import merge as M
from tarnfold.operators import shred as S
from tarnfold.operators.stages import checkpoint_folder
from tarnfold.plans import incremental as P
from tarnfold.queries import _DDL, _FIELDS, GAMES, games, now, query, read, run_day, written
from tarnfold.sources import envelope as E
from tarnfold.sources import schemas as I
from tarnfold.sources import tables as TB
from tarnfold.streaming import batches as B
from tarnfold.streaming import health as H

# ---------------------------------------------------------------- commits and feeds


def scratch(spark: SparkSession) -> tuple[str, str]:
    """A new database in the shared folder, and a folder beside it."""
    name = f"scratch_{uuid.uuid4().hex}"
    folder = f"{checkpoint_folder(spark)}/{name}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{folder}/tables'")
    return name, folder


_MADE: dict[tuple[str, str], tuple[TB.Table, list[dict]]] = {}


def _three_commits(spark: SparkSession, sf_dir: str) -> tuple[TB.Table, list[dict]]:
    """Games by season: three of four at first; then every third with a new price; then every fifth as cancelled, or gone if it is a seventh too.

    Made once for a session and folder; the queries below read the same table.
    """
    at = (spark.sparkContext.applicationId, sf_dir)
    if at not in _MADE or not TB.exists(spark, _MADE[at][0]):
        _MADE[at] = _commit_thrice(spark, sf_dir)
    return _MADE[at]


def _commit_thrice(spark: SparkSession, sf_dir: str) -> tuple[TB.Table, list[dict]]:
    layer, _ = scratch(spark)
    table = TB.table_of(layer, "games", {}, ("season", "game_id"), "season int, game_id bigint, order_id bigint, team_id bigint, status string, cents bigint", ("game_id",), ("season",))
    TB.declare(spark, table)
    g = games(spark, sf_dir).select("season", "game_id", "order_id", "team_id", "status", F.floor("price").alias("cents"))
    new = {c: (lambda t, s, c=c: s(c)) for c in ("status", "cents")}
    sources = [
        (g.filter("order_id % 4 <> 0"), []),
        (g.filter("order_id % 3 = 0").withColumn("cents", F.col("cents") + 1), [M.Update(new)]),
        (g.filter("order_id % 5 = 0").withColumn("status", F.lit("X")), [M.Delete(lambda t, s: s("order_id") % 7 == 0), M.Update({"status": lambda t, s: s("status")})]),
    ]
    counts = []
    for source, matched in sources:
        stored = TB.read(spark, table)
        counts.append(TB.commit(spark, table, M.merge(stored, source, table.key, matched, [M.Insert({"insert_dte": lambda t, s: now()})])))
    return table, counts


_COMMITS = f"""
WITH {GAMES}, g AS (SELECT season, game_id, order_id, team_id, status, CAST(floor(price) AS BIGINT) AS cents, order_id % 4 <> 0 AS one, order_id % 3 = 0 AS two, order_id % 5 = 0 AS three, order_id % 7 = 0 AS gone FROM games),
k AS (SELECT *, CASE WHEN three THEN 'X' ELSE status END AS status_now, cents + CASE WHEN two THEN 1 ELSE 0 END AS cents_now FROM g WHERE (one OR two OR three) AND NOT ((one OR two) AND three AND gone))"""


@query(_COMMITS + " SELECT season, game_id, team_id, status_now AS status, cents_now AS cents FROM k")
def table_commits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table of the catalog after three merges, each into the partitions it touches."""
    table, _ = _three_commits(spark, sf_dir)
    return TB.read(spark, table).select("season", "game_id", "team_id", "status", "cents")


@query(
    _COMMITS
    + """, n AS (SELECT 1 AS nth, 'inserted' AS change, 'insert' AS clause, count(*) FILTER (one) AS n_rows FROM g UNION ALL SELECT 2, 'inserted', 'insert', count(*) FILTER (two AND NOT one) FROM g
  UNION ALL SELECT 2, 'updated', 'update', count(*) FILTER (two AND one) FROM g UNION ALL SELECT 3, 'inserted', 'insert', count(*) FILTER (three AND NOT (one OR two)) FROM g
  UNION ALL SELECT 3, 'deleted', 'delete', count(*) FILTER (three AND (one OR two) AND gone) FROM g UNION ALL SELECT 3, 'updated', 'update', count(*) FILTER (three AND (one OR two) AND NOT gone) FROM g)
SELECT * FROM n WHERE n_rows > 0"""
)
def table_commit_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each merge did, observed in its own write."""
    _, counts = _three_commits(spark, sf_dir)
    return spark.createDataFrame([(i + 1, change, clause, n) for i, c in enumerate(counts) for (change, clause), n in c.items()], "nth int, change string, clause string, n_rows bigint")


@query(_COMMITS + " SELECT game_id, status_now AS status, cents_now AS cents FROM k")
def feed_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A gold table that was brought up to date from the change feed alone, with its inserts, both images and deletes in order."""
    table, _ = _three_commits(spark, sf_dir)
    feed = TB.changes(spark, table).select("_order", "_change_type", "game_id", "status", "cents")
    gold = M.apply_changes(spark.createDataFrame([], "game_id bigint, status string, cents bigint"), feed.filter("_order = 1"), ["game_id"])
    return M.apply_changes(gold, feed.filter("_order > 1"), ["game_id"])


@query(_COMMITS + " SELECT team_id, status_now AS status, count(*) AS n_rows, CAST(sum(cents_now) AS BIGINT) AS cents FROM k GROUP BY ALL")
def feed_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sums of a gold table kept by the differences that the feed tells, not made anew."""
    table, _ = _three_commits(spark, sf_dir)
    totals = spark.createDataFrame([], "team_id bigint, status string, n_rows bigint, cents bigint")
    for order in (1, 2, 3):
        totals = M.apply_to_sums(totals, TB.changes(spark, table).filter(F.col("_order") == order), ["team_id", "status"], {"cents": F.col("cents")})
    return totals


# ---------------------------------------------------------------- streams


@query(
    """
WITH k AS (SELECT o_orderkey AS k, o_orderkey % 3 = 0 AS first, o_orderkey % 2 = 0 AS again, o_orderkey % 2 = 0 AND o_orderkey % 5 = 0 AS second FROM orders)
SELECT k, 'landed' AS place, 0 AS attempts, CASE WHEN second THEN 2 ELSE 1 END AS body FROM k WHERE first OR second
UNION ALL SELECT k, 'ledger', CASE WHEN again THEN 2 ELSE 1 END, 0 FROM k WHERE NOT (first OR second)"""
)
def landed_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Responses as a stream of two batches into the landing table and the retry ledger, under one key a batch."""
    layer, folder = scratch(spark)
    columns = "endpoint string, request_key string, http_status int, payload string, api_url string, ingest_ts_utc timestamp, update_ts_utc timestamp"
    landing = TB.table_of(layer, "landing", {}, ("endpoint", "request_key"), columns)
    ledger = TB.table_of(layer, "ledger", {}, ("request_key",), "request_key string, attempt_count int, last_attempt_dte date, next_retry_dte date")
    for t in (landing, ledger):
        TB.declare(spark, t)
    k = F.col("o_orderkey")
    body = lambda n: F.lit(f'{{"plays": [{{"eventId": {n}}}]}}')
    first = F.when(k % 3 == 0, body(1)).when(k % 3 == 1, '{"plays": []}').otherwise(body(1))
    second = F.when(k % 5 == 0, body(2)).otherwise('{"plays": [{}]}')
    orders = read(spark, sf_dir, "orders")
    batches = [(orders, first, F.when(k % 3 == 2, 404).otherwise(200), "2001-07-10"), (orders.filter("o_orderkey % 2 = 0"), second, F.lit(200), "2001-07-27")]
    for df, payload, status, day in batches:
        at = F.lit(f"{day} 12:00:00").cast("timestamp")
        sent = df.select(F.lit("games").alias("endpoint"), k.cast("string").alias("request_key"), status.cast("int").alias("http_status"), payload.alias("payload"), F.lit("u").alias("api_url"), at.alias("ingest_ts_utc"))
        sent.write.mode("append").parquet(f"{folder}/in")
        stream = spark.readStream.schema(E.ENVELOPE).parquet(f"{folder}/in")
        B.land_stream(stream, landing, ledger, "plays", F.lit(day).cast("date"), at, f"{folder}/checkpoint").awaitTermination()
    key = F.col("request_key").cast("long").alias("k")
    there = TB.read(spark, landing).select(key, F.lit("landed").alias("place"), F.lit(0).alias("attempts"), F.get_json_object("payload", "$.plays[0].eventId").cast("int").alias("body"))
    return there.unionByName(TB.read(spark, ledger).select(key, F.lit("ledger").alias("place"), F.col("attempt_count").alias("attempts"), F.lit(0).alias("body")))


@query(
    """
WITH s AS (SELECT *, avg(CASE WHEN st = 429 THEN 1.0 ELSE 0.0 END) OVER w AS rate_429, avg(CASE WHEN st >= 400 OR st IS NULL THEN 1.0 ELSE 0.0 END) OVER w AS rate_error, count(*) OVER w AS seen
  FROM (SELECT *, CASE WHEN event_id % 31 = 0 THEN 429 WHEN event_id % 97 = 0 THEN NULL ELSE 200 END AS st FROM events) WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN 49 PRECEDING AND CURRENT ROW))
SELECT event_id, round(rate_429, 6) AS rate_429, round(rate_error, 6) AS rate_error, seen, CASE WHEN rate_429 > 0.05 THEN 'down' WHEN rate_error = 0 AND seen >= 50 THEN 'up' ELSE 'hold' END AS advice FROM s"""
)
def request_health_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P16 as state: the responses of four spans of time, each a run of its own of one stream, whose state is a ring of 50 for each endpoint."""
    _, folder = scratch(spark)
    i = F.col("event_id")
    e = read(spark, sf_dir, "events").select("event_id", "event_type", "ts", F.when(i % 31 == 0, 429).when(i % 97 == 0, None).otherwise(200).alias("http_status"))
    quarters = e.select(F.unix_micros(F.col("ts").cast("timestamp")).alias("u")).agg(F.percentile_approx("u", [0.25, 0.5, 0.75])).first()[0]
    span = sum((F.when(F.unix_micros(F.col("ts").cast("timestamp")) > q, 1).otherwise(0) for q in quarters), F.lit(0))
    provider = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(provider)
    spark.conf.set(provider, H.PROVIDER)
    try:
        for n in range(4):
            e.filter(span == n).write.mode("append").parquet(f"{folder}/in")
            rated = H.request_health_stream(spark.readStream.schema(e.schema).parquet(f"{folder}/in"), 50, "event_type", ("ts", "event_id"))
            rated.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    finally:
        spark.conf.set(provider, before)
    return spark.read.parquet(f"{folder}/out").select("event_id", F.round("rate_429", 6).alias("rate_429"), F.round("rate_error", 6).alias("rate_error"), "seen", "advice")


# ---------------------------------------------------------------- trees


@written
def _nested_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with their lines as plays, which have officials, and as roster spots; lines are shuffled once, by order, before they are either."""
    li = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").repartition("l_orderkey")
    li = li.groupBy("l_orderkey", "l_linenumber").agg(F.min("l_partkey").alias("part"), F.min("l_suppkey").alias("supp"))
    per = li.groupBy("l_orderkey").agg(F.sort_array(F.collect_list(F.struct("l_linenumber", "part", "supp"))).alias("lines"))
    ref = lambda c: F.concat(F.lit("ref"), c.cast("string"))

    def play(x):
        n = x["l_linenumber"]
        officials = F.when(n % 3 > 0, F.array(ref(x["supp"]), ref(x["part"]))).when(n % 2 == 0, F.array().cast("array<string>"))
        return F.struct(n.alias("eventId"), F.struct(x["part"].alias("part")).alias("details"), officials.alias("officials"))

    spot = lambda x: F.struct(x["supp"].alias("playerId"), F.struct(F.concat(F.lit("n"), x["l_linenumber"].cast("string")).alias("default")).alias("name"))
    o = read(spark, sf_dir, "orders").join(per.hint("merge"), F.col("o_orderkey") == F.col("l_orderkey"), "left")
    status = F.struct(F.col("o_orderstatus").alias("status"), F.col("o_custkey").alias("team"))
    return o.select(F.col("o_orderkey").alias("game_id"), F.to_json(F.struct(status.alias("game"), F.transform("lines", play).alias("plays"), F.transform("lines", spot).alias("rosterSpots"))).alias("payload"))


@query(
    """
WITH l AS (SELECT l_orderkey AS game_id, l_linenumber AS n, min(l_partkey) AS part, min(l_suppkey) AS supp FROM lineitem GROUP BY ALL),
p AS (SELECT *, row_number() OVER (PARTITION BY game_id ORDER BY n) - 1 AS pos FROM l)
SELECT 'rows' AS tab, o_orderkey AS game_id, CAST(NULL AS BIGINT) AS pos, CAST(NULL AS BIGINT) AS sub, o_orderstatus AS a, CAST(o_custkey AS VARCHAR) AS b FROM orders
UNION ALL SELECT 'plays', game_id, pos, NULL, CAST(n AS VARCHAR), CAST(part AS VARCHAR) FROM p
UNION ALL SELECT 'plays_officials', game_id, pos, sub, 'ref' || CASE WHEN sub = 0 THEN supp ELSE part END, NULL FROM p, (VALUES (0), (1)) x(sub) WHERE n % 3 > 0
UNION ALL SELECT 'rosterSpots', game_id, pos, NULL, CAST(supp AS VARCHAR), 'n' || n FROM p"""
)
def child_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payloads with arrays side by side and within each other, as tables with keys and positions, by the schema of all payloads."""
    payloads = _nested_payloads(spark, sf_dir)
    made = S.child_tables(S.parsed(payloads, I.infer(payloads)).select("game_id", "json.*"), ["game_id"])
    text = {"rows": ("game_status", "game_team"), "plays": ("eventId", "details_part"), "plays_officials": ("value", None), "rosterSpots": ("playerId", "name_default")}
    out = None
    for name, (a, b) in text.items():
        df = made[name]
        at = [c for c in df.columns if c.endswith("_pos")] + [None, None]
        column = lambda c, kind: (F.col(c) if c else F.lit(None)).cast(kind)
        one = df.select(F.lit(name).alias("tab"), "game_id", column(at[0], "long").alias("pos"), column(at[1], "long").alias("sub"), column(a, "string").alias("a"), column(b, "string").alias("b"))
        out = one if out is None else out.unionByName(one)
    return out


def _tree_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as payloads whose tree differs by status: open ones have a flag, pending ones no clerk."""
    o = read(spark, sf_dir, "orders")
    s = F.col("o_orderstatus")
    note = F.struct(F.when(s != "P", F.col("o_orderpriority")).alias("prio"), F.year(F.to_date("o_orderdate")).alias("year"))
    tags = F.array(F.struct(F.col("o_custkey").alias("n"), F.col("o_orderdate").cast("string").alias("day")))
    body = F.to_json(F.struct(F.col("o_orderkey").alias("id"), F.floor("o_totalprice").alias("price"), note.alias("note"), tags.alias("tags"), F.when(s == "O", F.lit(True)).alias("late")))
    return o.select(F.lit("games").alias("table_name"), s.alias("endpoint"), body.alias("payload"))


# The schema noted before, of every endpoint.
NOTED = "STRUCT<id: INT, price: STRING, note: STRUCT<prio: STRING, ship: BIGINT>, tags: ARRAY<STRUCT<n: DOUBLE, day: BOOLEAN>>>"

_TREE = """
WITH d AS (SELECT o_orderstatus AS endpoint, to_json({'id': o_orderkey, 'price': CAST(floor(o_totalprice) AS BIGINT), 'late': o_orderstatus = 'O', 'year': year(o_orderdate), 'n': o_custkey, 'day': CAST(o_orderdate AS VARCHAR), 'prio': o_orderpriority}) AS j FROM orders),
p(path, nm) AS (VALUES ('id', 'id'), ('price', 'price'), ('note.prio', 'prio'), ('note.year', 'year'), ('tags[].n', 'n'), ('tags[].day', 'day'), ('late', 'late')),
f AS (SELECT DISTINCT endpoint, path, CASE json_type(j, '$.' || nm) WHEN 'VARCHAR' THEN 'string' WHEN 'BOOLEAN' THEN 'boolean' ELSE 'bigint' END AS current_type FROM d, p WHERE (nm <> 'late' OR endpoint = 'O') AND (nm <> 'prio' OR endpoint <> 'P')),
k AS (SELECT endpoint, path, stored_type FROM (SELECT DISTINCT endpoint FROM d), (VALUES ('id', 'int'), ('price', 'string'), ('note.prio', 'string'), ('note.ship', 'bigint'), ('tags[].n', 'double'), ('tags[].day', 'boolean')) n(path, stored_type))"""


@query(
    _TREE
    + """, b AS (SELECT * FROM k FULL JOIN f USING (endpoint, path)), o(kind, place) AS (VALUES ('int', 1), ('bigint', 2), ('double', 3), ('string', 9), ('boolean', 0))
SELECT 'games' AS table_name, endpoint, path, CASE WHEN stored_type IS NULL THEN 'added' WHEN current_type IS NULL THEN 'removed' WHEN c.place > s.place AND (s.place > 0 OR c.place = 9) THEN 'widened' WHEN c.place < s.place THEN 'narrowed' ELSE 'retyped' END AS change, stored_type, current_type
FROM b LEFT JOIN o s ON s.kind = stored_type LEFT JOIN o c ON c.kind = current_type WHERE stored_type IS DISTINCT FROM current_type"""
)
def drift_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paths that were added, removed, widened or narrowed between the noted schema and that of all payloads."""
    payloads = _tree_payloads(spark, sf_dir)
    audit = payloads.select("table_name", "endpoint").distinct().withColumn("schema_json", F.lit(NOTED))
    return I.drift_paths(audit, I.infer_by(payloads, "table_name", "endpoint"))


@query(
    """
SELECT o_orderstatus AS endpoint, 'struct<id:bigint,price:string,note:struct<prio:string,ship:bigint,year:bigint>,tags:array<struct<n:double,day:string>>' || CASE WHEN bool_or(o_orderstatus = 'O') THEN ',late:boolean>' ELSE '>' END AS schema_json, true AS drift
FROM orders GROUP BY ALL"""
)
def widened_schemas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The noted schemas after they have taken up new paths and wider types; none is lost."""
    payloads = _tree_payloads(spark, sf_dir)
    noted = payloads.select("table_name", "endpoint").distinct().withColumns({"schema_json": F.lit(NOTED), "schema_hash": F.sha2(F.lit(NOTED), 256), "schema_drift_ind": F.lit(False), "last_check_dte": F.lit(None).cast("timestamp")})
    out = I.widen_stored(noted, I.infer_by(payloads, "table_name", "endpoint"), now())
    return out.select("endpoint", "schema_json", F.col("schema_drift_ind").alias("drift"))


@query("SELECT event_type, event_id FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY md5('17:' || event_id)) AS rn FROM events) WHERE rn <= 25")
def sampled_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exactly 25 rows of each endpoint, the same at every run."""
    return I.sample_rows(read(spark, sf_dir, "events").select("event_type", "event_id"), ["event_type"], 25, by="event_id")


@query(f"SELECT how, {_DDL} AS schema_json FROM {_FIELDS}, (VALUES ('a share'), ('one row'), ('declared')) h(how) GROUP BY how")
def sample_schemas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Schemas of all payloads by a share of the rows and by one, as rows of a declared type."""
    e = read(spark, sf_dir, "events")
    kind = T.StructType.fromDDL("how string not null, schema_json string")
    found = [("a share", I.infer_fraction(e, payload="props")), ("one row", I.infer_one(e, "props")), ("declared", I.infer(e, "props"))]
    return E.typed_rows(spark, found, kind)


@query("SELECT count(*) AS n_rows, count(DISTINCT o_custkey) > 0 AS has_bytes FROM orders")
def table_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table's rows and bytes as the optimizer knows them, after it was laid out by its key and analyzed."""
    layer, _ = scratch(spark)
    table = TB.table_of(layer, "orders", {}, ("o_orderkey",), "o_orderkey bigint, o_custkey bigint", ("o_orderkey",))
    TB.declare(spark, table)
    TB.replace(spark, table, M.stamped(read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), now(), "orders"))
    TB.analyze(spark, table, "o_orderkey")
    stats = spark.sql(f"DESCRIBE TABLE EXTENDED {table.full}").filter("col_name = 'Statistics'")
    number = lambda unit: F.regexp_extract("data_type", rf"([0-9]+) {unit}", 1).cast("bigint")
    return stats.select(number("rows").alias("n_rows"), (number("bytes") > 0).alias("has_bytes"))


# ---------------------------------------------------------------- gates at a first run


@query("SELECT 'recent' AS gate, CAST(NULL AS VARCHAR) AS game_type, true AS go UNION ALL SELECT 'recent of an old day', NULL, true UNION ALL SELECT 'ready', NULL, (SELECT count(*) = 0 FROM orders WHERE false)")
def gate_cold_starts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables that are empty let a first run begin, whatever the schedule says."""
    g, empty = games(spark, sf_dir), read(spark, sf_dir, "lineitem").limit(0)
    gate = lambda name, df: df.select(F.lit(name).alias("gate"), F.col("game_type").cast("string").alias("game_type"), F.lit(True).alias("go"))
    early = F.lit("1890-01-01").cast("date")
    ready = P.readiness([g, empty], g, early).select(F.lit("ready").alias("gate"), F.lit(None).cast("string").alias("game_type"), (F.col("cold_start") & F.col("ready") & ~F.col("recent_game")).alias("go"))
    return gate("recent", P.recent_or_cold(g.limit(0), empty, run_day())).unionByName(gate("recent of an old day", P.recent_or_cold(g, empty, early))).unionByName(ready)
