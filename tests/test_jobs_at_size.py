"""Jobs on odd rows and by their plans, as larger tables have found them wanting."""

from __future__ import annotations

from urllib.parse import urlparse

import duckdb
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from tarnfold import queries as Q
from tarnfold import stored_queries as SQ
from tarnfold.operators import stages
from tarnfold.operators.shred import build_fields, once_each
from tarnfold.plans import gold as G
from tarnfold.plans import jobs as J
from tests.compare import same


def test_schedule_gold_keeps_a_stored_side_of_team_zero_up_to_date(spark, sf_dir, tmp_path):
    # 26: stored and changed of late; 13: new, and so left out
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").withColumn("o_custkey", F.when(F.col("o_orderkey").isin(13, 26), F.lit(0).cast("long")).otherwise(F.col("o_custkey")))
    orders.coalesce(1).write.parquet(str(tmp_path / "orders.parquet"))
    found = Q.job_schedule_gold_merge(spark, str(tmp_path)).toPandas()
    c = duckdb.connect()
    c.execute(f"create view orders as select * from '{tmp_path}/orders.parquet/*.parquet'")
    same(found, c.execute(Q.ORACLE_SQL["job_schedule_gold_merge"]).df())
    assert len(found.query("start_time == 'later' and updated")) > 0


def _exchanges(df) -> list[str]:
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.split("\n") if "Exchange hashpartitioning" in line]


def test_rosters_lose_repeats_within_and_across_payloads_and_are_not_shuffled_without(spark):
    player = lambda i: f'{{"id": {i}, "firstName": {{"default": "a"}}}}'
    body = lambda *ids: '{"forwards": [' + ", ".join(map(player, ids)) + '], "goalies": [' + player(ids[0]) + "]}"
    columns = "game_id bigint, team_id bigint, request_key string, payload string"
    alone = spark.createDataFrame([(2001020001, 1, "t1", body(5, 6)), (2001020002, 1, "t1", body(5))], columns)
    made = J.current_rosters(alone)
    assert sorted((r.game_id, r.player_id) for r in made.collect()) == [(2001020001, 5), (2001020001, 6), (2001020002, 5)]
    assert _exchanges(made) == []
    again = alone.union(spark.createDataFrame([(2001020001, 2, "t2", body(6, 8))], columns))
    assert sorted((r.game_id, r.player_id) for r in J.current_rosters(again).collect()) == [(2001020001, 5), (2001020001, 6), (2001020001, 8), (2001020002, 5)]


def test_event_players_shuffle_events_and_not_their_roles(spark, sf_dir):
    plan = Q.job_event_players(spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate explode") < plan.index("RepartitionByExpression")


def test_shifts_lose_repeats_within_and_across_payloads_and_are_not_shuffled_without(spark):
    shift = lambda game, i: f'{{"id": {i}, "gameId": {game}, "teamId": 1}}'
    body = lambda *shifts: '{"total": 1, "data": [' + ", ".join(shift(2001020000 + g, i) for g, i in shifts) + "]}"
    found = lambda df: sorted((r.game_id - 2001020000, r.shift_id) for r in J.shift_rows(df, Q.SHIFT_DDL).collect())
    alone = spark.createDataFrame([(body((1, 5), (1, 5), (1, 6)),), (body((2, 5)),), (None,)], "payload string")
    assert found(alone) == [(1, 5), (1, 6), (2, 5)]
    assert _exchanges(J.shift_rows(alone, Q.SHIFT_DDL)) == []
    # the second payload has shifts of two games
    again = alone.union(spark.createDataFrame([(body((1, 6), (1, 7), (3, 1)),)], "payload string"))
    assert found(again) == [(1, 5), (1, 6), (1, 7), (2, 5), (3, 1)]


def test_plays_lose_repeats_within_and_across_payloads_and_are_not_shuffled_without(spark):
    play = lambda i, kind: f'{{"eventId": {i}, "typeDescKey": "{kind}", "periodDescriptor": {{"number": 1}}}}'
    body = lambda *plays: '{"plays": [' + ", ".join(play(i, kind) for i, kind in plays) + "]}"
    columns = "season int, game_id bigint, game_date date, payload string"
    found = lambda df: sorted((r.game_id, r.event_id, r.event_type) for r in J.event_rows(df, Q.PLAYS_DDL).collect())
    # alike only once their case and blanks are
    alone = spark.createDataFrame([(1, 1, None, body((5, "goal"), (5, " GOAL"), (5, "hit"))), (1, 2, None, body((5, "goal"))), (1, 3, None, None)], columns)
    assert found(alone) == [(1, 5, "goal"), (1, 5, "hit"), (2, 5, "goal")]
    assert _exchanges(J.event_rows(alone, Q.PLAYS_DDL)) == []
    again = alone.union(spark.createDataFrame([(1, 1, None, body((5, "hit"), (6, "hit")))], columns))
    assert found(again) == [(1, 5, "goal"), (1, 5, "hit"), (1, 6, "hit"), (2, 5, "goal")]


def test_texts_that_are_no_numbers_are_not_cast(spark):
    texts = ["12", " 12 ", "+5", "-7", "\t8\n", "\x007\x7f", "12.5", ".5", "1e3", "300", "99999999999", "x", "", " ", "-", "1 2", "٣", None]
    df = spark.createDataFrame([(t,) for t in texts], "n string")
    for kind in ("tinyint", "int", "bigint"):
        made = df.select("n", *build_fields(df, {"n": {"target": "made", "type": kind}}), F.col("n").try_cast(kind).alias("plain"))
        assert [r.n for r in made.collect() if r.made != r.plain] == []
        assert "RLIKE" in made._jdf.queryExecution().optimizedPlan().toString()


def test_repeats_are_told_by_the_key_among_elements_that_share_a_part_of_it(spark):
    df = spark.createDataFrame([([(1, "a"), (2, "a"), (1, "A"), (1, "b"), (None, None), (None, None)],), ([(1, "a"), (2, "a")],), ([],), (None,)], "l array<struct<i: int, t: string>>")
    made = once_each(df, "l", lambda x: F.struct(x["i"], F.lower(x["t"])), lambda x: x["i"])
    found = [None if r.l is None else [tuple(x) for x in r.l] for r in made.collect()]
    assert [x and sorted(x, key=str) for x in found] == [[(1, "a"), (1, "b"), (2, "a"), (None, None)], [(1, "a"), (2, "a")], [], None]


def test_plays_are_typed_as_rows_and_not_within_their_list(spark):
    payloads = spark.createDataFrame([], "season int, game_id bigint, game_date date, payload string")
    plan = J.event_rows(payloads, Q.PLAYS_DDL).select("game_id", "event_id")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("try_cast(_e") < plan.index("Generate posexplode")


def test_child_tables_read_stored_payloads_and_shuffle_nothing(spark, sf_dir):
    assert _exchanges(SQ.child_tables(spark, sf_dir)) == []


def test_special_rows_lose_repeats_within_and_across_payloads_and_are_not_shuffled_without(spark):
    row = lambda game, team, name: f'{{"gameId": {2001020000 + game}, "teamId": {team}, "teamFullName": "{name}"}}'
    body = lambda *rows: '{"data": [' + ", ".join(row(*r) for r in rows) + "]}"
    columns = "endpoint string, request_key string, http_status int, payload string"
    loaded = spark.createDataFrame([], "game_id bigint, game_date date")
    schema = "struct<data: array<struct<gameId: bigint, teamId: bigint, teamFullName: string>>>"
    made = lambda df: G.special_rows(df, loaded, schema, G.TOPICS["pp_stats"], Q.run_day())
    found = lambda df: sorted((r.game_id - 2001020000, r.team_id, r.team_name) for r in made(df).collect())
    # alike only once their blanks are
    alone = spark.createDataFrame([("powerplay", "a", 200, body((1, 1, "S"), (1, 1, " S "), (1, 2, "T"))), ("powerplay", "b", 200, body((2, 1, "S")))], columns)
    assert found(alone) == [(1, 1, "S"), (1, 2, "T"), (2, 1, "S")]
    assert "Aggregate" not in made(alone)._jdf.queryExecution().optimizedPlan().toString()
    again = alone.union(spark.createDataFrame([("powerplay", "c", 200, body((1, 1, "S"), (3, 1, "S")))], columns))
    assert found(again) == [(1, 1, "S"), (1, 2, "T"), (2, 1, "S"), (3, 1, "S")]


def test_shift_merges_read_stored_shifts_with_their_dates(spark, sf_dir):
    for made in (Q.job_shift_gold(spark, sf_dir), Q.job_shift_merge(spark, sf_dir)):
        plan = made._jdf.queryExecution().optimizedPlan().toString()
        assert "from_json" not in plan and "o_orderdate" not in plan


def test_shifts_keep_their_payloads_columns(spark):
    body = lambda *ids: '{"data": [' + ", ".join(f'{{"id": {i}, "gameId": 2001020001, "teamId": 1}}' for i in ids) + "]}"
    df = spark.createDataFrame([("a", body(5, 5, 6)), ("a", body(6, 7))], "day string, payload string")
    assert sorted((r.day, r.shift_id) for r in J.shift_rows(df, Q.SHIFT_DDL, ["day"]).collect()) == [("a", 5), ("a", 6), ("a", 7)]


def test_readers_take_few_special_payloads_at_once(spark, sf_dir):
    # a reader's batch has up to 4,096 rows of a row group, of some 100 KB each on large tables
    files = [pq.ParquetFile(urlparse(f).path).metadata for f in Q._special_payloads(spark, sf_dir).inputFiles()]
    assert sum(f.num_rows for f in files) > 300
    assert max(f.row_group(i).num_rows for f in files for i in range(f.num_row_groups)) <= 64


def test_shared_rosters_go_to_all_their_games_once(spark, monkeypatch):
    player = lambda i: f'{{"id": {i}, "firstName": {{"default": " a"}}, "sweaterNumber": "{i}"}}'
    body = lambda *ids: '{"forwards": [' + ", ".join(map(player, ids)) + '], "goalies": [' + player(ids[0]) + "]}"
    # two responses of team 1 have player 6; nothing refers to team 4, and null refers to nothing
    responses = spark.createDataFrame([(1, body(5, 6)), (1, body(6, 7)), (2, body(8, 5)), (4, body(9)), (None, body(9)), (3, "broken")], "team int, payload string")
    games = [(2001020001, 11, " t1", 1), (2001020002, 12, "t2", 2), (2001020003, 13, "t1", 1), (2001020003, 14, "t2", 2), (2001020004, 15, "t3", 3), (2001020005, 16, "t5", 5), (2001020006, 17, "t", None)]
    games = spark.createDataFrame(games, "game_id bigint, team_id bigint, request_key string, team int")
    expected = [(2001020001, i, 11, "T1") for i in (5, 6, 7)] + [(2001020002, i, 12, "T2") for i in (5, 8)] + [(2001020003, i) for i in (5, 6, 7, 8)]
    for most in (100_000, 0):  # the lists are broadcast, and are not
        monkeypatch.setattr(stages, "BROADCAST_ROWS", most)
        found = J.game_rosters(J.roster_players(responses, keep=["team"]), games)
        plain = responses.join(games, "team").select("game_id", "team_id", "request_key", "payload")
        assert found.columns == J.current_rosters(plain).columns
        found = found.orderBy("game_id", "player_id").collect()
        # of a game with two teams a player of both is of either
        assert [(r.game_id, r.player_id, r.team_id, r.team_abbrev) if r.game_id != 2001020003 else (r.game_id, r.player_id) for r in found] == expected
        assert all((r.season, r.player_name, r.jersey_num, r.is_active) == (20012002, "a", r.player_id, True) for r in found)


def test_roster_shred_reads_no_payload_for_each_game(spark, sf_dir):
    plan = Q.QUERIES["job_roster_shred"](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate explode" in plan and "from_json" not in plan
    # dates are texts before players' rows multiply
    assert "date_format" not in plan
