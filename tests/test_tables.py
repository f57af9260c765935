"""Tables of the catalog: commits by their feeds, replays, failures in between, partitions and buckets."""

from __future__ import annotations

import datetime as dt
import itertools

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarnfold.operators import merge as M
from tarnfold.plans import jobs as J
from tarnfold.plans.catalog import by_name, declare_all, tables
from tarnfold.sources import tables as S
from tarnfold.sources.envelope import ENVELOPE
from tarnfold.streaming import batches as B

NAMES = (f"t{i}" for i in itertools.count())



def rows(spark, schema, *values):
    return spark.createDataFrame(list(values), schema)


def as_set(df):
    return {tuple(r) for r in df.collect()}


def new(spark, ddl, key, **how):
    """A fresh declared table; key columns are required."""
    schema = T.StructType([T.StructField(f.name, f.dataType, f.name not in key) for f in T.StructType.fromDDL(ddl)])
    table = S.Table("testlayer", next(NAMES), schema, key, **how)
    S.declare(spark, table)
    return table


def upsert(spark, table, ddl, *values, gone=None):
    cols = [c for c in table.schema.fieldNames() if c not in table.key]
    update = M.Update({c: (lambda t, s, c=c: s(c)) for c in cols})
    return M.merge(S.read(spark, table), rows(spark, ddl, *values), list(table.key), [update], [M.Insert()], [gone] if gone else [])


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_declared_tables_are_empty_typed_and_found_by_column(spark):
    table = new(spark, "k int, endpoint string", ("k",), cluster_by=("k",))
    assert S.exists(spark, table) and S.read(spark, table).count() == 0 and S.read(spark, table).dtypes == [("k", "int"), ("endpoint", "string")]
    S.replace(spark, table, rows(spark, "endpoint string, k int", ("a", 1)))
    S.replace(spark, table, S.read(spark, table).union(rows(spark, "k int, endpoint string", (2, "b"))))  # of its own rows
    assert as_set(S.read(spark, table)) == {(1, "a"), (2, "b")}
    assert table.full in S.having_column(spark, "endpoint", "testlayer") and S.having_column(spark, "endpoint", "nolayer") == []
    with pytest.raises(Exception, match="required"):
        S.replace(spark, table, rows(spark, "k int, endpoint string", (None, "x")))
    assert S.read(spark, table).count() == 2
    S.declare(spark, table)
    assert S.read(spark, table).count() == 2
    S.analyze(spark, table, "k")
    assert "2 rows" in spark.sql(f"DESCRIBE TABLE EXTENDED {table.full}").filter("col_name = 'Statistics'").first()[1]


@pytest.mark.parametrize("how", [{}, {"partition_by": ("p",)}, {"buckets": 3}])
def test_commit_writes_feed_table_and_counts_in_one_pass(spark, how):
    table = new(spark, "k int, p int, v string", ("k",), **how)
    ddl = "k int, p int, v string"
    S.commit(spark, table, upsert(spark, table, ddl, (1, 1, "a"), (2, 2, "b"), (4, None, "d")))
    counts = S.commit(spark, table, upsert(spark, table, ddl, (1, 1, "x"), (3, 2, "c"), gone=M.Delete(lambda t, s: t("k") == 2)))
    assert counts == {("updated", "update"): 1, ("inserted", "insert"): 1, ("deleted", "delete"): 1}
    assert as_set(S.read(spark, table)) == {(1, 1, "x"), (3, 2, "c"), (4, None, "d")}
    feed = S.changes(spark, table).filter("_order = 2")
    assert as_set(feed.select("_change_type", "k", "v")) == {("update_preimage", 1, "a"), ("update_postimage", 1, "x"), ("insert", 3, "c"), ("delete", 2, "b")}
    assert S.commits(spark, table) == {"commit-1": 1, "commit-2": 2}
    S.compact(spark, table)
    assert as_set(S.read(spark, table)) == {(1, 1, "x"), (3, 2, "c"), (4, None, "d")}
    S.forget(spark, table, 1)
    assert S.commits(spark, table) == {"commit-2": 2}


def test_metrics_of_the_write_are_those_of_the_query(spark):
    table = new(spark, "k int, v string", ("k",))
    S.commit(spark, table, upsert(spark, table, "k int, v string", *[(i, "a") for i in range(40)]))
    merged = upsert(spark, table, "k int, v string", *[(i, "b") for i in range(20, 70)], gone=M.Delete(lambda t, s: t("k") < 5))
    asked = {(r.change, r.logic_block): r.n_rows for r in merged.metrics.collect()}
    assert S.commit(spark, table, merged) == asked == {("updated", "update"): 20, ("inserted", "insert"): 30, ("deleted", "delete"): 5}


def test_a_key_is_committed_once_even_if_it_counts(spark):
    table = new(spark, "k int, n int", ("k",))
    count = lambda: M.merge(S.read(spark, table), rows(spark, "k int", (1,)), ["k"], [M.Update({"n": lambda t, s: t("n") + 1})], [M.Insert({"n": lambda t, s: F.lit(1)})])
    for key in ("s-0", "s-1", "s-1", "s-11", "s-1"):
        S.commit(spark, table, count(), key)
    # a feed that comes again is applied again: the images of that commit, which nothing came after in a stream
    assert S.commits(spark, table) == {"s-0": 1, "s-1": 2, "s-11": 3}
    S.commit(spark, table, count(), "s-11")
    assert as_set(S.read(spark, table)) == {(1, 3)}


@pytest.mark.parametrize("key", ["shifts 2024-01-01T10:00:00+00:00", "a/b=c", "100%", "%3A", "it's", "Größe#?*[x]{y}^\\\"z"])
def test_keys_of_any_characters_are_known_again(spark, key):
    table = new(spark, "k int, n int", ("k",))
    add = M.Update({"n": lambda t, s: t("n") + s("n")})
    for _ in range(2):
        S.commit(spark, table, M.merge(S.read(spark, table), rows(spark, "k int, n int", (1, 1)), ["k"], [add], [M.Insert()]), key="first")
        S.commit(spark, table, M.merge(S.read(spark, table), rows(spark, "k int, n int", (1, 5)), ["k"], [add], [M.Insert()]), key=key)
    assert as_set(S.read(spark, table)) == {(1, 6)} and S.commits(spark, table) == {"first": 1, key: 2}
    S.commit(spark, table, M.merge(S.read(spark, table), rows(spark, "k int, n int", (2, 0)), ["k"], [add], [M.Insert()]))
    S.forget(spark, table, 1)
    assert S.commits(spark, table) == {"commit-3": 3} and as_set(S.changes(spark, table).select("k")) == {(2,)}


def test_touched_partitions_only_are_rewritten_and_emptied_ones_go(spark):
    table = new(spark, "d int, k int, v string", ("k",), cluster_by=("k",), partition_by=("d",))
    S.replace(spark, table, rows(spark, "d int, k int, v string", (1, 1, "a"), (2, 2, "b"), (2, 5, "e"), (3, 3, "c"), (None, 4, "d"), (None, 6, "f")))
    files = lambda: {f.rpartition(f"/{table.name}")[2] for f in S.read(spark, table).inputFiles()}
    before = files()
    source = rows(spark, "d int, k int, v string", (2, 2, "x"), (4, 9, "new"), (None, 4, "y"))
    merged = M.merge(S.read(spark, table), source, ["k"], [M.Update({"v": lambda t, s: s("v")})], [M.Insert()], [M.Delete(lambda t, s: t("k") == 3)], scope=lambda t: t("k") < 5)
    assert S.commit(spark, table, merged, "b1") == {("updated", "update"): 2, ("inserted", "insert"): 1, ("deleted", "delete"): 1}
    expected = {(1, 1, "a"), (2, 2, "x"), (2, 5, "e"), (None, 4, "y"), (None, 6, "f"), (4, 9, "new")}
    assert as_set(S.read(spark, table)) == expected
    after = files()
    assert {f for f in before if "/d=1/" in f} == {f for f in after if "/d=1/" in f} and not any("/d=3/" in f for f in after)
    assert not {f for f in before if "/d=2/" in f} & after
    assert S.commit(spark, table, merged, "b1") == {} and as_set(S.read(spark, table)) == expected


def test_a_cut_off_replacement_is_ended(spark):
    table = new(spark, "k int", ("k",))
    S.replace(spark, table, rows(spark, "k int", (1,)))
    spark.sql(f"CREATE TABLE {table.full}__next USING parquet AS SELECT 2 AS k")
    spark.sql(f"ALTER TABLE {table.full} RENAME TO {table.full}__last")  # the driver dies here
    assert as_set(S.read(spark, table)) == {(2,)} and not spark.catalog.tableExists(f"{table.full}__last")
    spark.sql(f"CREATE TABLE {table.full}__next USING parquet AS SELECT 3 AS k")  # or here: before the exchange began
    assert as_set(S.read(spark, table)) == {(2,)}
    S.replace(spark, table, rows(spark, "k int", (4,)))
    assert as_set(S.read(spark, table)) == {(4,)}


def test_a_bucketed_target_is_not_shuffled_by_its_merge(spark):
    table = new(spark, "k int, v string", ("k",), buckets=4)
    S.replace(spark, table, rows(spark, "k int, v string", *[(i, "a") for i in range(100)]))
    source = rows(spark, "k int, v string", *[(i, "b") for i in range(50, 150)]).hint("merge")
    merged = M.merge(S.read(spark, table), source, ["k"], [M.Update({"v": lambda t, s: s("v")})], [M.Insert()])
    plan = plan_of(merged.table)
    assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan  # the source's alone
    assert merged.table.count() == 150


# ---------------------------------------------------------------- streams


def test_stream_merges_the_latest_and_replays_change_nothing(spark, tmp_path):
    table = new(spark, "k int, v string, at int", ("k",))
    job = lambda t, s: M.merge(t, s, ["k"], [M.Update({"v": lambda t, s: s("v"), "at": lambda t, s: s("at")}, lambda t, s: s("at") > t("at"))], [M.Insert()])
    landing = str(tmp_path / "in")
    for part, checkpoint in (([(1, "a", 1), (1, "b", 2)], "c"), ([(2, "x", 1), (1, "old", 1)], "c"), ([(3, "z", 1)], "other")):
        spark.createDataFrame(part, table.schema).write.mode("append").parquet(landing)
        B.merge_stream(spark.readStream.schema(table.schema).parquet(landing), table, ["k"], "at", job, str(tmp_path / checkpoint)).awaitTermination()
    assert as_set(S.read(spark, table)) == {(1, "b", 2), (2, "x", 1), (3, "z", 1)}


def _responses(spark, *values):
    return spark.createDataFrame([("games", key, status, body, "u", dt.datetime(2024, 1, 10, hour)) for key, status, body, hour in values], ENVELOPE)


FULL, EMPTY = '{"plays":[{"a":1}]}', '{"plays":[]}'


def _landing(spark):
    landed = S.table_of("testlayer", next(NAMES), {}, ("endpoint", "request_key"), "endpoint string, request_key string, http_status int, payload string, api_url string, ingest_ts_utc timestamp, update_ts_utc timestamp")
    ledger = S.table_of("testlayer", next(NAMES), {}, ("request_key",), "request_key string, attempt_count int, last_attempt_dte date, next_retry_dte date")
    for t in (landed, ledger):
        S.declare(spark, t)
    return landed, ledger


def _state(spark, landed, ledger):
    return as_set(S.read(spark, landed).select("request_key", "payload")), as_set(S.read(spark, ledger).select("request_key", "attempt_count", F.dayofmonth("last_attempt_dte"), F.dayofmonth("next_retry_dte")))


FIRST = (("1", 200, FULL, 1), ("2", 200, EMPTY, 1), ("3", 404, FULL, 1), ("4", 200, EMPTY, 1), ("4", 200, FULL, 2))
SECOND = (("1", 200, EMPTY, 3), ("2", 200, FULL, 3), ("3", 200, EMPTY, 3), ("5", 200, None, 3))


@pytest.mark.parametrize("broken", [None, "feed of the second table", "second table", "first table"])
def test_both_sinks_of_a_batch_get_it_once_whatever_fails_in_between(spark, monkeypatch, broken):
    landed, ledger = _landing(spark)
    run, now = (F.lit(f"2024-01-{d}").cast("date") for d in (10, 27)), F.lit("2024-01-27 01:00:00").cast("timestamp")
    days = list(run)
    S.commit_all(spark, B.land(_responses(spark, *FIRST), landed, ledger, "plays", days[0], now), "s-0")
    assert _state(spark, landed, ledger) == ({("1", FULL), ("4", FULL)}, {("2", 1, 10, 25), ("3", 1, 10, 25)})
    batch = lambda: S.commit_all(spark, B.land(_responses(spark, *SECOND), landed, ledger, "plays", days[1], now), "s-1")
    if broken:
        real = S._write_feed if broken.startswith("feed") else S._apply
        fails = landed if broken == "first table" else ledger

        def failing(spark, table, *rest):
            if table is fails:
                raise RuntimeError("lost")
            return real(spark, table, *rest)

        with monkeypatch.context() as m:
            m.setattr(S, real.__name__, failing)
            with pytest.raises(RuntimeError, match="lost"):
                batch()
    for _ in range(2):  # comes again, and once more
        batch()
        assert _state(spark, landed, ledger) == ({("1", FULL), ("2", FULL), ("4", FULL)}, {("3", 2, 27, 11), ("5", 1, 27, 11)})
    assert len(S.commits(spark, landed)) == len(S.commits(spark, ledger)) == 2


def test_landing_stream_writes_both_sinks(spark, tmp_path):
    landed, ledger = _landing(spark)
    run, now = F.lit("2024-01-10").cast("date"), F.lit("2024-01-10 01:00:00").cast("timestamp")
    source = str(tmp_path / "in")
    for part in (FIRST, SECOND):
        _responses(spark, *part).write.mode("append").parquet(source)
        B.land_stream(spark.readStream.schema(ENVELOPE).parquet(source), landed, ledger, "plays", run, now, str(tmp_path / "c")).awaitTermination()
    # the second batch comes on the same day: what was tried in vain today is not due
    assert _state(spark, landed, ledger) == ({("1", FULL), ("2", FULL), ("4", FULL)}, {("3", 1, 10, 25), ("5", 1, 10, 25)})


# ---------------------------------------------------------------- feeds


def test_gold_from_feeds_is_gold_made_anew(spark):
    table = new(spark, "k int, g string, n int", ("k",))
    ddl = "k int, g string, n int"
    gold = rows(spark, ddl)
    sums = rows(spark, "g string, n_rows bigint, total bigint")
    for values, gone in (([(1, "a", 1), (2, "a", 2), (3, "b", 3), (7, "c", None)], None), ([(1, "b", 5), (4, None, 4)], None), ([(5, "a", 7)], M.Delete(lambda t, s: t("k").isin(2, 7)))):
        S.commit(spark, table, upsert(spark, table, ddl, *values, gone=gone))
    feed = S.changes(spark, table)
    expected = as_set(S.read(spark, table))
    assert as_set(M.apply_changes(gold, feed, ["k"])) == expected == {(1, "b", 5), (3, "b", 3), (4, None, 4), (5, "a", 7)}
    assert as_set(M.apply_changes(M.apply_changes(gold, feed.filter("_order = 1"), ["k"]), feed.filter("_order > 1"), ["k"])) == expected
    assert as_set(M.apply_changes(S.read(spark, table), feed, ["k"])) == expected
    total = M.apply_to_sums(sums, feed.filter("_order < 3"), ["g"], {"total": F.col("n")})
    total = M.apply_to_sums(total, feed.filter("_order = 3"), ["g"], {"total": F.col("n")})
    assert as_set(total) == {("b", 2, 8), ("a", 1, 7), (None, 1, 4)}


# ---------------------------------------------------------------- jobs


def test_shifts_land_in_their_declared_table(spark):
    shifts = S.table_of("testlayer", next(NAMES), J.SHIFT_RULES, ("game_id", "shift_id"), "season int, start_seconds int, end_seconds int", ("game_id",), ("season",))
    assert shifts.schema["shift_number"].dataType == T.IntegerType() and not shifts.schema["shift_id"].nullable and shifts.schema["py_source"].nullable
    payload = '{"data":[{"id":7,"gameId":2023020001,"teamId":1,"teamAbbrev":" abc","playerId":9,"period":1,"startTime":"00:10","endTime":"00:40","shiftNumber":2}]}'
    found = J.shift_rows(rows(spark, "payload string", (payload,)), "struct<data: array<struct<id: bigint, gameId: bigint, teamId: bigint, teamAbbrev: string, playerId: bigint, period: int, startTime: string, endTime: string, shiftNumber: int>>>")
    S.declare(spark, shifts)
    S.replace(spark, shifts, M.stamped(found, F.current_timestamp(), "test"))
    assert [(r.shift_id, r.team_abbrev, r.season, r.start_seconds, r.py_source) for r in S.read(spark, shifts).collect()] == [(7, "ABC", 20232024, 10, "test")]
    with pytest.raises(ValueError, match="no column"):
        S.table_of("silver", "events", J.EVENT_RULES, ("game_id", "event_idx"))


def test_two_day_merge_rewrites_two_days(spark):
    events = by_name("silver.events")
    S.declare(spark, events)
    payload = lambda *ids: '{"plays":[' + ",".join(f'{{"eventId":{i},"sortOrder":{i},"typeDescKey":"Goal","timeInPeriod":"00:0{i}","periodDescriptor":{{"number":1}}}}' for i in ids) + "]}"
    ddl = "struct<plays: array<struct<eventId: bigint, sortOrder: int, typeDescKey: string, timeInPeriod: string, periodDescriptor: struct<number: int>>>>"
    run = F.lit("2024-01-10").cast("date")

    def source(*days):
        values = [(20232024, 2023020000 + d, dt.date(2024, 1, d), payload(*ids)) for d, ids in days]
        return J.timed_events(J.event_rows(rows(spark, "season int, game_id bigint, game_date date, payload string", *values), ddl))

    first = source((1, (1, 2)), (9, (1, 2)), (10, (1,))).withColumns({"active_row": F.lit(True), "logic_block": F.lit("insert"), "failed_condition": F.lit(None).cast("string"), "event_team_abbrev": F.lit(None)})
    S.replace(spark, events, M.stamped(first, F.current_timestamp(), "test"))
    files = lambda d: {f for f in S.read(spark, events).inputFiles() if f"game_date=2024-01-{d}/" in f}
    before = {d: files(d) for d in ("01", "09", "10")}
    merged = J.event_merge(S.read(spark, events), source((9, (1,)), (10, (1, 3))), run, F.current_timestamp(), ["event_type", "event_id"])
    assert S.commit(spark, events, merged) == {("inserted", "insert"): 1, ("updated", "no match update two"): 1}
    assert before["01"] == files("01") and not before["09"] & files("09") and not before["10"] & files("10")
    assert {(r.game_date.day, r.event_id, r.active_row) for r in S.read(spark, events).collect()} == {(1, 1, True), (1, 2, True), (9, 1, True), (9, 2, False), (10, 1, True), (10, 3, True)}


def test_all_tables_are_declared(spark):
    declare_all(spark)
    found = tables()
    assert len({t.full for t in found}) == len(found) >= 45 and all(S.exists(spark, t) for t in found)
    assert {"gold.shifts", "gold.plays_on_shifts"} <= set(S.having_column(spark, "shift_id", "gold"))
    assert {t.layer for t in found} == {"bronze", "silver", "gold", "ops", "quarantine"}
    assert by_name("gold.pp_stats").schema["power_play_pct"].dataType.simpleString() == "decimal(6,5)"
    with pytest.raises(ValueError, match="not both"):
        S.Table("gold", "x", found[0].schema, ("k",), partition_by=("d",), buckets=2)


def test_quarantined_rows_are_added(spark):
    table = S.Table("testlayer", next(NAMES), T.StructType.fromDDL("k int, quarantine_reason string not null"), ())
    S.declare(spark, table)
    for _ in range(2):
        S.append(spark, table, rows(spark, "quarantine_reason string, k int", ("k is null", None)))
    assert as_set(S.read(spark, table)) == {(None, "k is null")} and S.read(spark, table).count() == 2


# ---------------------------------------------------------------- key filters


def test_key_filter_keeps_every_match_and_little_else(spark):
    target = spark.range(20_000).select((F.col("id") * 3).alias("a"), F.concat(F.lit("k"), F.col("id")).alias("b"))
    source = spark.range(0, 20_000, 500).select((F.col("id") * 3).cast("int").alias("a"), F.concat(F.lit("k"), F.col("id")).alias("b")).union(rows(spark, "a int, b string", (None, "x"), (1, None)))
    kept = {r.a for r in M.may_match(target, source, ["a", "b"]).collect()}
    assert {3 * i for i in range(0, 20_000, 500)} <= kept and len(kept) < 60
    crowded = {r.a for r in M.may_match(target, source, ["a", "b"], bits=15).collect()}
    assert kept <= crowded and len(crowded) < 200
    assert M.may_match(target, source.limit(0), ["a", "b"]).count() == 0


def test_merge_shuffles_no_row_outside_its_scope_but_those_a_key_filter_passes(spark, tmp_path):
    spark.range(50_000).select("id", (F.col("id") % 100).cast("int").alias("d"), F.lit("a").alias("v")).write.parquet(str(tmp_path / "t"))
    target, source = spark.read.parquet(str(tmp_path / "t")), rows(spark, "id bigint, d int, v string", (99, 99, "b"), (5, 99, "again"), (70_000, 99, "new")).hint("merge")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        merged = M.merge(target, source, ["id"], [M.Update({"v": lambda t, s: s("v")})], [M.Insert()], scope=lambda t: t("d") >= 98)
        assert merged.metrics.count() == 2 and as_set(merged.rows.filter("_new is not null").select("_new.*").filter("v <> 'a'")) == {(99, 99, "b"), (70_000, 99, "new")}
        plan = plan_of(merged.rows)
        # the exchange of the look-up's right side is fed by the key filter's broadcast join, not by the history itself
        lookup = plan[plan.index("LeftAnti") :]
        right = lookup[lookup.rindex("Exchange hashpartitioning(id", 0, lookup.index("LeftSemi")) : lookup.index("LeftSemi")]
        assert "BroadcastHashJoin" in right and "Scan" not in right
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_event_merge_shuffles_its_window_and_its_source_alone(spark, sf_dir):
    from tarnfold import queries as Q

    Q.job_event_merge(spark, sf_dir).count()  # its payloads and stored events are written
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = plan_of(Q.job_event_merge(spark, sf_dir))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    # target in scope; source by game (its distinct plays) and by key, once for the merge; the filter's bits, from the source outside the scope; what passes it
    assert plan.count("Exchange hashpartitioning") == 6 and plan.count("from_json") == 2
    looked_up = plan[plan.index("LeftAnti") :]
    history = looked_up[: looked_up.index("LeftSemi")].rindex("Exchange hashpartitioning")
    assert "FileScan" not in looked_up[history : looked_up.index("LeftSemi")]
