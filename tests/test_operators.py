from __future__ import annotations

import datetime as dt

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarnfold.functions import compare as C
from tarnfold.functions import values as V
from tarnfold.operators import merge as M
from tarnfold.operators import rows as R
from tarnfold.operators import shred as S
from tarnfold.plans import jobs as J
from tarnfold.sources import envelope as E
from tarnfold.sources import schemas as I


def table(spark, schema, *rows):
    return spark.createDataFrame(list(rows), schema)


def as_set(df):
    return {tuple(r) for r in df.collect()}


@pytest.mark.parametrize(("camel", "snake"), [("easternUTCOffset", "eastern_utc_offset"), ("gameId", "game_id"), ("id", "id"), ("URL", "url"), ("sweaterNumber2Old", "sweater_number2_old"), ("HTTPServerURL", "http_server_url"), ("aB", "a_b"), ("A", "a"), ("AB", "ab"), ("ABc", "a_bc"), ("x9Y", "x9_y"), ("gameID2", "game_id2"), ("", "")])
def test_snake_case(camel, snake):
    assert V.snake_case(camel) == snake


@given(st.from_regex(r"[a-z]{1,8}(_[a-z]{1,8}){0,3}", fullmatch=True))
def test_snake_case_leaves_snake_case(name):
    assert V.snake_case(name) == name


def test_merge_first_clause_wins_and_unchanged_rows_stay(spark):
    target = table(spark, "k int, v string, n int", (1, "a", 1), (2, "b", 2), (3, None, 3), (4, "d", 4))
    source = table(spark, "k int, v string", (1, "a"), (2, "x"), (3, "c"), (5, "e"))
    out = M.merge(
        target,
        source,
        ["k"],
        matched=[M.Update({"v": lambda t, s: s("v"), "n": lambda t, s: t("n") + 10}, lambda t, s: C.null_safe(t("v"), s("v")), "one"), M.Update({"n": lambda t, s: F.lit(0)}, lambda t, s: t("k") > 1, "two")],
        not_matched=[M.Insert({"n": lambda t, s: F.lit(7)})],
        not_matched_by_source=[M.Delete(tag="gone")],
    )
    assert as_set(out.table) == {(1, "a", 1), (2, "x", 12), (3, "c", 13), (5, "e", 7)}
    assert as_set(out.metrics) == {("updated", "one", 2), ("inserted", "insert", 1), ("deleted", "gone", 1)}
    assert out.changes.groupBy("_change_type").count().count() == 4


def test_merge_plain_inequality_is_no_change_for_null(spark):
    target, source = table(spark, "k int, v int", (1, None), (2, 2)), table(spark, "k int, v int", (1, 5), (2, None))
    out = M.merge(target, source, ["k"], [M.Update({"v": lambda t, s: s("v")}, lambda t, s: C.plain(t("v"), s("v")))])
    assert as_set(out.table) == {(1, None), (2, 2)}


def test_merge_key_outside_scope_is_not_inserted_again(spark):
    day = dt.date
    target = table(spark, "k int, d date", (1, day(2020, 1, 1)), (2, day(2024, 1, 1)))
    source = table(spark, "k int, d date", (1, day(2024, 1, 2)), (3, day(2024, 1, 2)))
    out = M.merge(target, source, ["k"], not_matched=[M.Insert()], not_matched_by_source=[M.Delete()], scope=lambda t: t("d") > F.lit("2023-01-01").cast("date"))
    assert as_set(out.table) == {(1, day(2020, 1, 1)), (3, day(2024, 1, 2))}


def test_merge_refuses_repeated_and_null_source_keys(spark):
    target = table(spark, "k int, v int", (1, 1))
    for bad in (((1, 1), (1, 2)), ((None, 1),)):
        with pytest.raises(Exception, match="null or repeated key"):
            M.merge(target, table(spark, "k int, v int", *bad), ["k"], not_matched=[M.Insert()]).table.collect()


def test_merge_with_empty_sides(spark):
    empty, some = table(spark, "k int, v int"), table(spark, "k int, v int", (1, 1))
    assert as_set(M.merge(empty, some, ["k"], not_matched=[M.Insert()]).table) == {(1, 1)}
    assert as_set(M.merge(some, empty, ["k"], not_matched=[M.Insert()]).table) == {(1, 1)}


def test_previous_team(spark):
    df = table(spark, "t int, s int, p int", (1, 2, None), (1, 1, 5), (1, None, 5), (None, 3, 4), (2, 5, 5), (1, 1, 1))
    got = [r[0] for r in df.select(V.previous_on_change(F.col("t"), F.col("s"), F.col("p"))).collect()]
    assert got == [1, 5, 5, 4, 2, None]


def test_quarantine_reasons_and_complement(spark):
    df = table(spark, "event_type string, time_in_period string, time_remaining string, situation_code string", ("goal", "01:00", "19:00", None), ("stop", "01:00", "19:00", None), (None, None, "1", "1551"))
    good, bad = R.quarantine(df, R.event_rules(["goal"]))
    assert good.count() == 1
    assert {r.quarantine_reason for r in bad.collect()} == {"situation_code is null", "event_type is null; time_in_period is null"}


def test_found_and_empty_are_complements(spark):
    bodies = [(200, '{"plays":[{"a":1}]}'), (200, '{"plays": [ ]}'), (200, '{"plays":[{}]}'), (200, None), (200, "oops"), (404, '{"plays":[{"a":1}]}'), (None, '{"plays":[{"a":1}]}'), (200, "{}"), (200, '{"x":1}')]
    df = table(spark, "http_status int, payload string", *bodies)
    found, empty = E.split_found(df, "plays")
    assert found.count() == 1 and empty.count() == len(bodies) - 1


def test_landed_responses_are_read_and_streamed(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text('{"endpoint":"e","request_key":"1","http_status":200,"payload":"[{\\"a\\":1}]"}\n{"endpoint":"e","request_key":"2","http_status":404,"payload":"{}"}\n')
    expected = {("1", '{"data":[{"a":1}]}'), ("2", None)}
    assert as_set(E.read_landed(spark, str(tmp_path / "in")).select("request_key", "payload")) == expected
    stream = E.stream_landed(spark, str(tmp_path / "in")).select("request_key", "payload")
    stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination()
    assert as_set(spark.read.parquet(str(tmp_path / "out"))) == expected


def test_typed_rows_refuse_nulls_in_required_columns(spark):
    row = ("e", "1", 200, "{}", "u", None)
    assert E.typed_rows(spark, [row]).schema == E.ENVELOPE and E.typed_rows(spark, []).count() == 0
    with pytest.raises(Exception, match="(?i)null"):
        E.typed_rows(spark, [(None, *row[1:])])


def test_schema_of_one_row(spark):
    df = table(spark, "payload string", (None,), ('{"x":1}',), ('{"x":2}',))
    assert I.infer_one(df) == "STRUCT<x: BIGINT>"


def test_list_payload_is_wrapped(spark):
    df = E.as_envelope(table(spark, "http_status int, payload string", (200, " [1]"), (500, "[1]"), (200, '{"a":1}')))
    assert [r.payload for r in df.collect()] == ['{"data": [1]}', None, '{"a":1}']


def test_game_clock(spark):
    cases = [(1, 0, False, 0), (3, 1200, False, 3600), (4, 10, False, 3610), (5, 0, False, 3900), (6, 0, False, None), (4, 10, True, 3610), (6, 5, True, 6005)]
    df = table(spark, "p int, t int, o boolean, e int", *cases)
    assert all(r[0] == r[1] for r in df.select(V.game_clock(F.col("p"), F.col("t"), F.col("o")), "e").collect())


def test_schedule_times(spark):
    df = table(spark, "start_ts_utc string, venue_offset string, game_date date", ("2024-01-02T03:00:00Z", "-05:00", None), ("2024-01-02 03:00:00", "+01:00", None), ("2024-01-02T03:00:00+00:00", "-05:00", None), ("TBD", "-05:00", dt.date(2024, 1, 2)))
    got = [(str(r.game_date), r.start_time) for r in J.schedule_gold(df).collect()]
    assert got == [("2024-01-01", "22:00:00"), ("2024-01-02", "04:00:00"), ("2024-01-01", "22:00:00"), ("2024-01-02", None)]


def test_run_date_shifts_once(spark):
    df = table(spark, "t timestamp", (dt.datetime(2024, 1, 2, 3),))
    assert str(df.select(V.run_date(F.col("t"), "America/Chicago")).first()[0]) == "2024-01-01"


def test_inference_over_all_rows_and_samples(spark):
    df = table(spark, "endpoint string, payload string", ("a", '{"x":1}'), ("a", '{"x":2,"y":{"z":null}}'), ("a", "broken"), ("a", None))
    assert I.infer(df) == "STRUCT<x: BIGINT, y: STRUCT<z: STRING>>"
    assert I.infer_fraction(df, 0.000001) == I.infer(df)
    assert I.infer_random(df, 10) == I.infer(df)
    assert as_set(I.infer_rows(df, 10, "endpoint")) == {("a", I.infer(df))}
    assert S.parsed(df, I.infer(df)).filter("json.y is not null").count() == 1


def test_missing_field_is_typed_null_and_bad_cast_is_null(spark):
    df = table(spark, "a struct<b: string>", (("x",),), (("5",),))
    out = df.select(*S.build_fields(df, {"a.b": {"type": "int", "target": "n"}, "a.c": "date"}))
    assert out.dtypes == [("n", "int"), ("c", "date")] and as_set(out) == {(None, None), (5, None)}


def test_flatten_refuses_arrays_side_by_side_and_name_clashes(spark):
    with pytest.raises(ValueError):
        S.flatten(table(spark, "a array<int>, b array<int>", ([1], [2])))
    with pytest.raises(ValueError):
        S.flatten(table(spark, "a struct<x: int>, x int", ((1,), 2)), prefix=False)
    assert S.flatten(table(spark, "a array<struct<x: int>>", ([],), ([(1,), (2,)],))).count() == 3


def test_unused_fields(spark):
    schema = table(spark, "a array<struct<x: int, y: struct<p: int, q: int>>>, b int").schema
    assert S.unused_fields(schema, ["a.x", "a.y.p"]) == ["a.y.q", "b"]


def test_drift_clears_when_the_schema_stays(spark):
    at = F.lit("2024-01-01").cast("timestamp")
    audit = table(spark, "table_name string, endpoint string, schema_json string, schema_hash string, schema_drift_ind boolean, last_check_dte timestamp")
    current = lambda ddl: table(spark, "table_name string, endpoint string, schema_json string", ("t", "e", ddl))
    one = I.drift(audit, current("A"), at)
    two = I.drift(one, current("B"), at)
    three = I.drift(two, current("B"), at)
    assert [x.first()["schema_drift_ind"] for x in (one, two, three)] == [False, True, False]


def test_merge_reads_its_source_once(spark):
    target, source = table(spark, "k int, v int", (1, 1)), table(spark, "k int, v int", (1, 2), (2, 2))
    with_join = M.merge(target, source.hint("merge"), ["k"], [M.Update({"v": lambda t, s: s("v")})], [M.Insert()]).table
    plan = with_join._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2  # one a side: the check of keys has none of its own
    assert as_set(with_join) == {(1, 2), (2, 2)}


@pytest.mark.parametrize("block", [5, 7, 1000])
def test_request_health_in_blocks(spark, block):
    import random

    rnd = random.Random(block)
    rows = [(rnd.choice("ab"), str(i), rnd.choice([200, 200, 429, 500, None]), dt.datetime(2024, 1, 1) + dt.timedelta(minutes=rnd.randrange(400)) if i else None) for i in range(120)]
    df = table(spark, "endpoint string, request_key string, http_status int, ingest_ts_utc timestamp", *rows)
    got = {r.request_key: (r.seen, round(r.rate_429, 6)) for r in E.request_health(df, last=5, block=block).collect()}
    expected = {}
    for endpoint in "ab":
        mine = sorted((r for r in rows if r[0] == endpoint), key=lambda r: (r[3] or dt.datetime.min, r[1]))
        for i, r in enumerate(mine):
            window = mine[max(0, i - 4) : i + 1]
            expected[r[1]] = (len(window), round(sum(x[2] == 429 for x in window) / len(window), 6))
    assert got == expected


def test_schema_of_recent_random_rows(spark):
    day = lambda d: dt.datetime.fromisoformat(d)
    df = table(spark, "payload string, ingest_ts_utc timestamp", ('{"a":1}', day("2024-05-01")), ('{"b":1}', day("2024-06-30")), ('{"c":1}', day("2023-01-01")), (None, day("2024-06-01")))
    assert I.infer_recent(df, F.lit("2024-06-30").cast("date")) == "STRUCT<a: BIGINT>"


# ---------------------------------------------------------------- trees and samples


def test_child_tables_of_arrays_side_by_side_and_within(spark):
    ddl = "id int, game struct<name: string, marks: array<int>>, plays array<struct<n: int, info: struct<who: array<struct<name: string>>>>>, spots array<struct<p: int>>"
    df = table(spark, ddl, (1, ("a", [5, None]), [(1, ([("x",), ("y",)],)), None, (2, (None,))], [(7,), (8,), (9,)]), (2, None, [], None))
    made = S.child_tables(df, ["id"])
    assert sorted(made) == ["game_marks", "plays", "plays_info_who", "rows", "spots"]
    assert as_set(made["rows"]) == {(1, "a"), (2, None)} and made["rows"].columns == ["id", "game_name"]
    assert as_set(made["game_marks"]) == {(1, 0, 5), (1, 1, None)} and made["game_marks"].columns == ["id", "game_marks_pos", "value"]
    assert as_set(made["plays"]) == {(1, 0, 1), (1, 1, None), (1, 2, 2)}
    assert as_set(made["plays_info_who"]) == {(1, 0, 0, "x"), (1, 0, 1, "y")} and made["plays_info_who"].columns == ["id", "plays_pos", "info_who_pos", "name"]
    assert as_set(made["spots"]) == {(1, 0, 7), (1, 1, 8), (1, 2, 9)}
    assert S.child_tables(table(spark, "id int, m array<array<int>>", (1, [[1, 2], []])), ["id"])["m_value"].count() == 2
    with pytest.raises(ValueError, match="fall together"):
        S.child_tables(table(spark, "id int, a struct<x: int>, b struct<x: int>"), ["id"], prefix=False)
    with pytest.raises(ValueError, match="fall together"):
        S.child_tables(table(spark, "id int, a array<struct<id: int>>"), ["id"])


def test_widened_types_hold_both_sides():
    of = T.DataType.fromDDL
    cases = [
        ("a int, b struct<x: date>", "b struct<x: timestamp, y: string>, c array<int>", "a int, b struct<x: timestamp, y: string>, c array<int>"),
        ("a bigint", "a int", "a bigint"), ("a int", "a double", "a double"), ("a boolean", "a int", "a string"), ("a struct<x: int>", "a array<int>", "a string"),
        ("a decimal(5,2)", "a decimal(9,4)", "a decimal(9,4)"), ("a decimal(9,0)", "a decimal(5,4)", "a double"), ("a array<struct<n: int>>", "a array<struct<n: string, m: int>>", "a array<struct<n: string, m: int>>"),
        ("a string", "a struct<x: int>", "a string"),
    ]
    for stored, current, wide in cases:
        assert I.widened(of(stored), of(current)).simpleString() == of(wide).simpleString(), (stored, current)
        assert I.widened(of(wide), of(current)).simpleString() == of(wide).simpleString()  # a second check finds nothing


def test_drift_paths_and_what_the_stored_schema_takes_up(spark):
    audit = lambda *rows: table(spark, "table_name string, endpoint string, schema_json string", *rows)
    stored, current = audit(("t", "e", "a INT, b STRING, c STRUCT<x: BIGINT, y: INT>, d BOOLEAN"), ("t", "gone", "a INT")), audit(("t", "e", "a BIGINT, b INT, c STRUCT<x: BIGINT, z: ARRAY<DOUBLE>>, d INT"), ("t", "new", "a INT"))
    assert as_set(I.drift_paths(stored, current)) == {
        ("t", "e", "a", "widened", "int", "bigint"), ("t", "e", "b", "narrowed", "string", "int"), ("t", "e", "c.y", "removed", "int", None),
        ("t", "e", "c.z[]", "added", None, "double"), ("t", "e", "d", "retyped", "boolean", "int"),
    }
    assert I.drift_paths(stored, stored).count() == 0 and I.drift_paths(stored.limit(0), current).count() == 0
    noted = stored.withColumns({"schema_hash": F.sha2("schema_json", 256), "schema_drift_ind": F.lit(False), "last_check_dte": F.lit(None).cast("timestamp")})
    at = F.lit("2024-01-01").cast("timestamp")
    one = I.widen_stored(noted, current, at)
    assert as_set(one.select("endpoint", "schema_json", "schema_drift_ind")) == {("e", "struct<a:bigint,b:string,c:struct<x:bigint,y:int,z:array<double>>,d:string>", True), ("gone", "struct<a:int>", False), ("new", "struct<a:int>", False)}
    again = I.widen_stored(one, current, at)
    assert as_set(again.select("endpoint", "schema_drift_ind")) == {("e", False), ("gone", False), ("new", False)}


@pytest.mark.parametrize("n", [3, 1500])
def test_samples_have_exactly_n_rows_of_each_group_and_are_repeatable(spark, n):
    df = spark.range(8000).select(F.when(F.col("id") % 4 > 0, "hot").when(F.col("id") % 8 == 0, "cold").alias("endpoint"), F.col("id").cast("string").alias("payload")).union(table(spark, "e string, p string", ("rare", "1")))
    one, two = (I.sample_rows(df.repartition(k), ["endpoint"], n) for k in (3, 7))
    assert as_set(one) == as_set(two) and {r.endpoint: r["count"] for r in one.groupBy("endpoint").count().collect()} == {"hot": n, "cold": min(n, 1000), None: min(n, 1000), "rare": 1}
    assert as_set(one) != as_set(I.sample_rows(df, ["endpoint"], n, seed=5))
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan if n < 1000 else plan.count("hashpartitioning(endpoint") >= 2
    assert as_set(I.infer_rows(table(spark, "endpoint string, payload string", ("a", '{"x":1}'), ("a", None), ("b", '{"y":"t"}')), 1, "endpoint")) == {("a", "STRUCT<x: BIGINT>"), ("b", "STRUCT<y: STRING>")}


def test_maps_with_more_keys_than_columns_may_be_are_refused(spark):
    df = table(spark, "m array<map<string,string>>", ([{"a": "1"}, {"b": "2"}],))
    assert S.map_to_wide(df, "m", most=2).columns == ["a", "b"]
    with pytest.raises(ValueError, match="more than 1 keys"):
        S.map_to_wide(df, "m", most=1)


# ---------------------------------------------------------------- jobs


def test_late_games_are_read_again_and_older_ones_are_not(spark):
    from tarnfold.plans import gold as G

    day = dt.date
    loaded = table(spark, "game_id bigint, game_date date", (2023020001, day(2024, 1, 1)), (2023020002, day(2024, 1, 8)), (2023020003, day(2024, 1, 9)), (2023020004, None))
    one = lambda n, status=200, total=1, endpoint="powerplay": (endpoint, f"{n} {status} {total}", status, f'{{"data":[{{"gameId":202302000{n},"ppGoals":{n}}}],"total":{total}}}')
    payloads = table(spark, "endpoint string, request_key string, http_status int, payload string", one(1), one(2), one(3), one(4), one(5), one(6, 500), one(7, 200, 0), one(8, endpoint="powerplaytime"))
    got = G.special_rows(payloads, loaded, "struct<data: array<struct<gameId: bigint, ppGoals: bigint>>>", G.TOPICS["pp_stats"], F.lit("2024-01-10").cast("date"))
    assert {r.game_id % 10 for r in got.collect()} == {2, 3, 4, 5}  # a loaded game without a date is no old one


def test_unlisted_players_are_roster_gaps(spark):
    rows = [(1, 1, "goal", 5, 6, 7), (1, 1, "goal", 7, None, 5), (1, 1, "game-end", 9, 9, 7), (1, 2, None, 5, 6, None)]
    events = table(spark, "season int, game_id int, event_type string, a bigint, b bigint, listed bigint", *rows)
    roles = R.unpivot_roles(events, ["season", "game_id", "event_type"], ["a", "b"])
    roster = events.select("season", "game_id", F.col("listed").alias("player_id")).filter("player_id is not null")
    assert as_set(J.unlisted_players(events, ["a", "b"], "listed", ["game-end"])) == as_set(J.roster_gaps(roles, roster, ["game-end"])) == {(1, 1, 6), (1, 2, 5), (1, 2, 6)}


def test_emptiness_counts_nulls_placeholders_and_absent_fields(spark):
    df = table(spark, "a string, b int", ("u", 1), (None, 999), ("x", None), ("x", 1))
    assert [str(r[0]) for r in df.select(V.emptiness({"a": "u", "b": 999}, 16, 1)).collect()] == ["0.13", "0.19", "0.13", "0.06"]


# ---------------------------------------------------------------- health


def test_health_as_state_is_that_of_the_batch_after_restarts(spark, tmp_path):
    import random

    from tarnfold.streaming import health as H

    rnd = random.Random(3)
    rows = [(rnd.choice("aab"), str(i), rnd.choice([200, 200, 429, 500, None]), dt.datetime(2024, 1, 1) + dt.timedelta(minutes=i)) for i in range(200)]
    ddl = "endpoint string, request_key string, http_status int, ingest_ts_utc timestamp"
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", H.PROVIDER)
    try:
        for part in (rows[:3], rows[3:90], rows[90:]):
            table(spark, ddl, *part).write.mode("append").parquet(f"{tmp_path}/in")
            rated = H.request_health_stream(spark.readStream.schema(ddl).parquet(f"{tmp_path}/in"), last=7)
            rated.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start().awaitTermination()
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
    tidy = lambda df: {(r.request_key, r.seen, round(r.rate_429, 6), round(r.rate_retryable, 6), round(r.rate_error, 6), r.advice) for r in df.collect()}
    got, expected = spark.read.parquet(f"{tmp_path}/out"), E.request_health(table(spark, ddl, *rows), last=7)
    assert tidy(got) == tidy(expected) and got.count() == len(rows)


@pytest.mark.parametrize(("run", "plan", "start", "end"), [("2024-03-01", "init_scrape_within_season", None, "2024-06-30"), ("2024-08-01", "init_scrape_outside_season", None, "2025-06-30")])
def test_first_scrape_before_and_after_june(spark, run, plan, start, end):
    from tarnfold.plans import incremental as P

    seasons = table(spark, "team int, ps_start_date date, rs_start_date date, rs_end_date date, rs_last_game_date date, playoff_end_date date, sched_fully_loaded boolean", (1, None, None, None, None, None, None))
    (r,) = P.scrape_plan(seasons, F.lit(run).cast("date"), "team").collect()
    assert (r.scrape_plan, str(r.end_date)) == (plan, end) and str(r.start_date) == P.FIRST_DAY


def test_ends_in_early_periods_are_no_end_of_the_game(spark):
    from tarnfold.plans import incremental as P

    games = table(spark, "game_id int, game_date date, season int", (1, dt.date(2024, 1, 1), 20232024), (2, dt.date(2024, 1, 1), 20232024), (3, dt.date(2010, 1, 1), 20092010))
    events = table(spark, "game_id int, period int, event_type string", (1, 3, "Game-End"), (2, 1, "game-end"), (2, 3, "goal"))
    got = P.game_status(events, games, F.lit("2024-01-01").cast("date"), F.lit(20232024))
    assert as_set(got) == {(1, True, False), (2, False, True), (3, True, False)}
