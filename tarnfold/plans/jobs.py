"""Domain jobs: payloads to silver rows, silver rows to gold ones."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarnfold.functions import values as V
from tarnfold.functions.compare import any_of, as_text, failed_conditions, null_safe, plain, skip_null, unless_source_null
from tarnfold.operators.merge import Delete, Insert, Merged, Update, merge
from tarnfold.operators.rows import best_row, lookup, one_each
from tarnfold.operators.shred import build_fields, each_element, element_fields, field_of, once_each, parsed, sides, targets, unpack_list, whole_list, with_unused
from tarnfold.operators.stages import cut, few
from tarnfold.sources.schemas import infer


def schedule_rows(payloads: DataFrame, schema: str) -> DataFrame:
    """Weeks of games as two rows a game: season, game_id, game_type, game_date, start_ts_utc, venue_offset, home_road, team_id, team_abbrev, team_name."""
    days = payloads.select(F.explode_outer(F.from_json("payload", schema).getField("gameWeek")).alias("w")).select("w.date", F.explode_outer("w.games").alias("g"))
    two = sides(days.select("date", "g.*").withColumnRenamed("id", "game_id"), "awayTeam", "homeTeam")
    rows = two.select(
        F.col("season").try_cast("int").alias("season"),
        F.col("game_id").try_cast("bigint").alias("game_id"),
        F.col("gameType").try_cast("int").alias("game_type"),
        F.col("date").try_cast("date").alias("game_date"),
        F.col("startTimeUTC").alias("start_ts_utc"),
        F.col("venueUTCOffset").alias("venue_offset"),
        "home_road",
        F.col("id").try_cast("bigint").alias("team_id"),
        F.col("abbrev").alias("team_abbrev"),
        V.without_doubled_word(F.concat_ws(" ", F.col("placeName.default"), F.col("commonName.default"))).alias("team_name"),
    )
    return one_each(rows.filter(F.col("game_id").isNotNull() & (F.coalesce("team_abbrev", F.lit("TBD")) != "TBD")), ["season", "game_id", "home_road"])


FORMATS = ("yyyy-MM-dd'T'HH:mm:ss'Z'", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ssXXX")


def schedule_gold(silver: DataFrame) -> DataFrame:
    """Local date and start time by each row's own offset: epoch arithmetic, no session zone."""
    utc = V.first_timestamp(F.col("start_ts_utc"), *FORMATS)
    local = F.timestamp_seconds(F.unix_seconds(utc) + F.coalesce(V.offset_seconds(F.col("venue_offset")), F.lit(0)))
    return silver.withColumn("_l", local).withColumns({"game_date": F.coalesce(F.to_date("_l"), F.col("game_date")), "start_time": F.date_format("_l", "HH:mm:ss")}).drop("_l")


def schedule_merge(target: DataFrame, source: DataFrame, run: Column, now: Column) -> Merged:
    """Upsert by season, game, team and side over the last seven days; a future playoff game that is gone is deleted."""
    attrs = ["game_date", "start_ts_utc", "team_name"]
    new = {c: (lambda t, s, c=c: F.coalesce(s(c), t(c))) for c in attrs} | {"update_dte": lambda t, s: now}
    changed = lambda t, s: any_of({c: unless_source_null(t(c).cast("string"), s(c).cast("string"), "") for c in attrs})
    gone = lambda t, s: (t("game_type") == 3) & (t("game_date") > run)
    recent = lambda t: (t("game_date") >= F.date_sub(run, 7)) | (F.to_date(t("insert_dte")) >= F.date_sub(run, 7))
    return merge(target, source, ["season", "game_id", "home_road"], [Update(new, changed, "update")], [Insert({"insert_dte": lambda t, s: now})], [Delete(gone, "cancelled")], scope=recent)


def _text(target: str, **how: bool) -> dict[str, object]:
    return {"target": target, "type": "string", "trim": True, **how}


EVENT_RULES: dict[str, object] = {
    # Source field of a play, name and type of its column.
    "periodDescriptor.number": {"target": "period", "type": "tinyint"},
    "periodDescriptor.periodType": _text("period_type", upper=True),
    "periodDescriptor.maxRegulationPeriods": "tinyint",
    "clock.inIntermission": {"target": "intermission_active", "type": "boolean"},
    "clock.running": {"target": "game_in_play", "type": "boolean"},
    "eventId": {"target": "event_id", "type": "bigint"},
    "sortOrder": "int",
    "typeCode": {"target": "event_type_code", "type": "int"},
    "typeDescKey": _text("event_type", lower=True),
    "situationCode": _text("situation_code"),
    "timeInPeriod": _text("time_in_period"),
    "timeRemaining": _text("time_remaining"),
    "homeTeamDefendingSide": _text("home_team_defending_side", lower=True),
    "details.zoneCode": _text("zone_code", lower=True),
    "details.eventOwnerTeamId": {"target": "event_team_id", "type": "bigint"},
    "details.awayScore": "tinyint",
    "details.awaySOG": {"target": "away_sog", "type": "int"},
    "details.homeScore": "tinyint",
    "details.homeSOG": {"target": "home_sog", "type": "int"},
    "details.scoringPlayerId": "bigint",
    "details.scoringPlayerTotal": "tinyint",
    "details.assist1PlayerId": "bigint",
    "details.assist1PlayerTotal": "tinyint",
    "details.assist2PlayerId": "bigint",
    "details.assist2PlayerTotal": "tinyint",
    "details.xCoord": "int",
    "details.yCoord": "int",
    "details.blockingPlayerId": "bigint",
    "details.committedByPlayerId": {"target": "penalty_committed_by_player_id", "type": "bigint"},
    "details.drawnByPlayerId": {"target": "penalty_drawn_by_player_id", "type": "bigint"},
    "details.descKey": _text("penalty_desc", lower=True),
    "details.typeCode": _text("penalty_type_desc", lower=True),
    "details.duration": {"target": "penalty_duration", "type": "int"},
    "details.hitteePlayerId": {"target": "hit_taken_by_player_id", "type": "bigint"},
    "details.hittingPlayerId": {"target": "hit_given_by_player_id", "type": "bigint"},
    "details.playerId": "bigint",
    "details.reason": _text("missed_shot_desc", lower=True),
    "details.secondaryReason": _text("play_stopped_reason", lower=True),
    "details.shootingPlayerId": "bigint",
    "details.shotType": _text("shot_type", lower=True),
    "details.goalieInNetId": "bigint",
    "details.winningPlayerId": {"target": "faceoff_winning_player_id", "type": "bigint"},
    "details.losingPlayerId": {"target": "faceoff_losing_player_id", "type": "bigint"},
}
# The first of these that is there is an event's first, or second, player.
PLAYER_ONE = ("player_id", "scoring_player_id", "shooting_player_id", "blocking_player_id", "faceoff_winning_player_id", "penalty_committed_by_player_id", "hit_given_by_player_id")
PLAYER_TWO = ("assist1_player_id", "faceoff_losing_player_id", "penalty_drawn_by_player_id", "hit_taken_by_player_id", "goalie_in_net_id")


def across_payloads(rows: DataFrame, games: DataFrame, once: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Rows of which no payload has one twice, without those that several payloads have.

    games: game_id, one row for each payload and game. Rows of games with one payload, as nearly all
    are, are not shuffled; those of the others go through `once`. The games are counted at once.
    """
    several = cut(games.groupBy("game_id").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select(F.col("game_id").alias("_several")))
    if several.isEmpty():
        return rows
    several = few(several)
    same = F.col("game_id").eqNullSafe(F.col("_several"))
    return rows.join(several, same, "left_anti").unionByName(once(rows.join(several, same, "left_semi")))


def event_rows(payloads: DataFrame, schema: str, keep: Sequence[str] = ("season", "game_id", "game_date")) -> DataFrame:
    """One row for each distinct play with a period, with typed columns; blank texts are null.

    A payload's repeats go within its row; only plays of games that several payloads have are shuffled.
    """
    read_in = payloads.select(*keep, F.from_json("payload", schema).alias("_j"))
    fields = read_in.schema["_j"].dataType
    clock = [f for f in fields if f.name == "clock"]
    either = T.StructType([*clock, *fields["plays"].dataType.elementType])
    typed = lambda x, rules=EVENT_RULES: element_fields(lambda path: field_of(F.struct(F.col("clock")) if clock and path.startswith("clock.") else x)(path), either, rules)
    some = {c: EVENT_RULES[c] for c in ("eventId", "sortOrder")}
    plays = read_in.select(*keep, *[F.col("_j.clock").alias("clock") for _ in clock], F.col("_j.plays").alias("_plays"))
    plays = once_each(plays, "_plays", lambda x: F.struct(*typed(x)), lambda x: F.struct(*typed(x, some)))
    rows = each_element(plays, F.col("_plays"), [*keep, *[f.name for f in clock]]).select(*keep, *typed(F.col("_e"))).filter("period is not null")
    rows = across_payloads(rows, payloads.select("game_id"), lambda df: df.distinct())
    return rows.withColumns({str(r["target"]): V.blank_to_null(F.col(str(r["target"]))) for r in EVENT_RULES.values() if isinstance(r, dict) and r["type"] == "string"})


def timed_events(events: DataFrame, run: Column | None = None, over_through: int = 20092010, days: int = 2) -> DataFrame:
    """Game clock, order within the game, the opening situation, and whether the game is still in play.

    A game is over by an end event, if its season is `over_through` or before, or by its date more
    than `days` before the run. One window partition by game serves the order and the end flag, so
    there is one shuffle.
    """
    late = F.col("season") <= over_through
    if run is not None:
        late = late | (F.col("game_date") < F.date_sub(run, days))
    playoff = V.game_type(F.col("game_id")) == 3
    period = F.col("period").cast("int")
    game = Window.partitionBy("game_id")
    return events.withColumns(
        {
            "game_seconds": V.game_clock(period, V.mmss_seconds(F.col("time_in_period")), playoff),
            "situation_code": F.when((period == 1) & (F.col("event_type") == "period-start"), "1551").otherwise(F.col("situation_code")),
        }
    ).withColumns(
        {
            "event_idx": F.row_number().over(game.orderBy("game_seconds", "sort_order", "event_id")) - 1,
            "game_in_play": ~(F.max(F.coalesce(F.col("event_type") == "game-end", F.lit(False))).over(game) | F.coalesce(late, F.lit(False))),
        }
    )


def participants(events: DataFrame, players: DataFrame) -> DataFrame:
    """Players one to three of an event with their names. players: player_id, full_name."""
    ids = {"player_1_id": F.coalesce(*PLAYER_ONE), "player_2_id": F.coalesce(*PLAYER_TWO), "player_3_id": F.col("assist2_player_id")}
    out = events.withColumns(ids)
    for n in (1, 2, 3):
        out = lookup(out, players, {f"player_{n}_id": "player_id"}, {f"player_{n}_name": "full_name"})
    return out


def _two_day_merge(target: DataFrame, source: DataFrame, keys: Sequence[str], run: Column, now: Column, conditions, new: Mapping, reasons: Mapping, off: Mapping, gone_today, gone_before) -> Merged:
    """Rows of the last two days: changed ones that are active, else the in-play flag; vanished ones become inactive."""
    block = lambda name: {"logic_block": lambda t, s: F.lit(name), "update_dte": lambda t, s: now}
    live = {"game_in_play": lambda t, s: s("game_in_play")}
    return merge(
        target,
        source,
        keys,
        matched=[
            Update(new | live | reasons | {"active_row": lambda t, s: F.lit(True)} | block("match one"), lambda t, s: t("active_row") & any_of(conditions(t, s)), "match one"),
            Update(live | block("match two"), lambda t, s: null_safe(t("game_in_play"), s("game_in_play")), "match two"),
        ],
        not_matched=[Insert({"active_row": lambda t, s: F.lit(True), "insert_dte": lambda t, s: now, "logic_block": lambda t, s: F.lit("insert")})],
        not_matched_by_source=[
            Update(off | block("no match update one"), lambda t, s: (t("game_date") == run) & t("active_row") & gone_today(t), "no match update one"),
            Update(off | block("no match update two"), lambda t, s: (t("game_date") < run) & t("active_row") & gone_before(t), "no match update two"),
        ],
        scope=lambda t: t("game_date").between(F.date_sub(run, 2), run),
    )


def event_merge(target: DataFrame, source: DataFrame, run: Column, now: Column, attrs: Sequence[str], kept: Sequence[str] = ()) -> Merged:
    """Events by their place in the game. A null source of `kept` attributes, such as coordinates, is no change of theirs."""
    conditions = lambda t, s: {c: null_safe(t(c), s(c)) for c in attrs} | {c: skip_null(t(c), s(c)) for c in kept}
    new = {c: (lambda t, s, c=c: s(c)) for c in (*attrs, *kept)}
    reasons = {"failed_condition": lambda t, s: failed_conditions(conditions(t, s))}
    off = {"active_row": lambda t, s: F.lit(False), "game_in_play": lambda t, s: F.lit(False)}
    always = lambda t: F.lit(True)
    return _two_day_merge(target, source, ["season", "game_id", "game_date", "event_idx"], run, now, conditions, new, reasons, off, always, always)


def shift_merge(target: DataFrame, source: DataFrame, run: Column, now: Column, attrs: Sequence[str]) -> Merged:
    """Shifts by game, team and number. Of vanished ones those in play go today, and those no longer in play on the days before."""
    conditions = lambda t, s: {c: null_safe(t(c), s(c)) for c in attrs}
    new = {c: (lambda t, s, c=c: s(c)) for c in attrs}
    off = {"active_row": lambda t, s: F.lit(False)}
    return _two_day_merge(target, source, ["game_id", "game_date", "team_id", "shift_id"], run, now, conditions, new, {}, off, lambda t: t("game_in_play"), lambda t: ~t("game_in_play"))


def roster_inserts(target: DataFrame, source: DataFrame, now: Column) -> Merged:
    """Players of games that the roster lacks; those it has stay as they are."""
    return merge(target, source, ["season", "game_id", "player_id"], [], [Insert({"insert_dte": lambda t, s: now})])


def current_roster_merge(target: DataFrame, source: DataFrame, now: Column, attrs: Sequence[str]) -> Merged:
    """Today's rosters: changed players, new ones, and those who are on none any more, who become inactive."""
    changed = lambda t, s: ~t("is_active") | any_of({c: unless_source_null(t(c).cast("string"), s(c).cast("string"), "") for c in attrs})
    new = {c: (lambda t, s, c=c: F.coalesce(s(c), t(c))) for c in attrs} | {"is_active": lambda t, s: F.lit(True), "update_dte": lambda t, s: now}
    gone = Update({"is_active": lambda t, s: F.lit(False), "update_dte": lambda t, s: now}, lambda t, s: t("is_active"), "inactive")
    return merge(target, source, ["team_id", "player_id"], [Update(new, changed)], [Insert({"is_active": lambda t, s: F.lit(True), "insert_dte": lambda t, s: now})], [gone])


SHIFT_RULES: dict[str, object] = {
    # Source field of a shift, type of its column.
    "id": {"target": "shift_id", "type": "bigint"},
    "gameId": "bigint",
    "teamId": "bigint",
    "teamAbbrev": {"type": "string", "trim": True, "upper": True},
    "playerId": "bigint",
    "firstName": {"type": "string", "trim": True},
    "lastName": {"type": "string", "trim": True},
    "period": "int",
    "startTime": {"type": "string", "trim": True},
    "endTime": {"type": "string", "trim": True},
    "duration": {"type": "string", "trim": True},
    "shiftNumber": "int",
    "typeCode": "int",
    "teamName": _text("team_name"),
    "detailCode": "int",
    "eventDescription": _text("event_description"),
    "eventDetails": _text("event_details"),
    "eventNumber": "int",
    "hexValue": _text("hex_value"),
}


def shift_rows(payloads: DataFrame, schema: str, keep: Sequence[str] = ()) -> DataFrame:
    """One row for each shift, its season, and its times as seconds of the game, after the payload's columns to keep.

    A payload's repeats go within its row; only shifts of games that several payloads have are shuffled.
    """
    lists = parsed(payloads, schema or infer(payloads)).select(*keep, F.col("json.data").alias("_shifts"))
    element = lists.schema["_shifts"].dataType.elementType
    keys = lambda x: element_fields(field_of(x), element, {c: SHIFT_RULES[c] for c in ("gameId", "teamId", "id")})
    raw = each_element(once_each(lists, "_shifts", lambda x: F.struct(*keys(x))), F.col("_shifts"), keep).select(*keep, "_e.*")
    # games are told from the payload's own list, of which no other field is read
    only = T.StructType([T.StructField("data", T.ArrayType(T.StructType([f for f in element if f.name == "gameId"])))])
    ids = F.transform(F.from_json("payload", only).getField("data"), lambda x: keys(x)[0]) if "gameId" in element.names else F.array(F.lit(None).cast("bigint"))
    games = each_element(payloads, F.array_distinct(ids)).select(F.col("_e").alias("game_id"))
    rows = across_payloads(raw.select(*keep, *build_fields(raw, SHIFT_RULES)), games, lambda df: one_each(df, ["game_id", "team_id", "shift_id"]))
    playoff = V.game_type(F.col("game_id")) == 3
    clock = lambda c: V.game_clock(F.col("period"), V.mmss_seconds(V.blank_to_null(F.col(c))), playoff)
    return rows.withColumns({"season": V.season_of_game(F.col("game_id")), "duration": F.coalesce(V.blank_to_null(F.col("duration")), F.lit("00:00")), "start_seconds": clock("start_time"), "end_seconds": clock("end_time")})


def named_shifts(shifts: DataFrame, players: DataFrame) -> DataFrame:
    """Shifts with their players' name, position and side. players: player_id, player_name, player_pos, shoots_catches."""
    values = {c: c for c in ("player_name", "player_pos", "shoots_catches")}
    return lookup(shifts.drop(*values), players, {"player_id": "player_id"}, values)


def shift_roster(shifts: DataFrame) -> DataFrame:
    return one_each(shifts.filter("player_id is not null").select("season", "player_id", "game_id"), ["season", "player_id", "game_id"])


EVENT_ROLES = (
    # Columns of an event that name a player who took part in it.
    "player_id",
    "shooting_player_id",
    "scoring_player_id",
    "assist1_player_id",
    "assist2_player_id",
    "goalie_in_net_id",
    "penalty_committed_by_player_id",
    "penalty_drawn_by_player_id",
    "hit_given_by_player_id",
    "hit_taken_by_player_id",
    "faceoff_winning_player_id",
    "faceoff_losing_player_id",
)
# Roles whose team is not the event's, and events that nobody has a part in.
OTHER_TEAM_ROLES = ("faceoff_losing_player_id", "hit_taken_by_player_id")
TEAMLESS_EVENTS = ("period-start", "period-end", "stoppage", "game-start", "game-end")


def event_players(events: DataFrame, run: Column, keep: Sequence[str] = ("season", "game_id", "game_date")) -> DataFrame:
    """Players of the event's team in any of its roles, up to the run's day, each once a game and team: player_id, team_id."""
    named = events.filter(F.col("event_team_id").isNotNull() & ~F.col("event_type").isin(*TEAMLESS_EVENTS) & (F.col("game_date") <= run))
    own = [F.col(c).cast("bigint") for c in EVENT_ROLES if c not in OTHER_TEAM_ROLES]
    # events are shuffled, not their roles: a game's names are told apart where they are gathered
    listed = named.select(*keep, F.col("event_team_id").alias("team_id"), F.array_compact(F.array_distinct(F.array(*own))).alias("_ids")).repartition("game_id")
    by = listed.groupBy(*keep, "team_id").agg(F.array_distinct(F.flatten(F.collect_list("_ids"))).alias("_ids"))
    return by.select(*keep, "team_id", F.explode("_ids").alias("player_id"))


def roster_gaps(roles: DataFrame, roster: DataFrame, skipped_types: Sequence[str]) -> DataFrame:
    """Players that events name but the game's roster lacks. roles: season, game_id, event_type, role, player_id."""
    named = roles.filter(~F.coalesce(F.col("event_type").isin(*skipped_types), F.lit(False))).select("season", "game_id", "player_id").distinct()
    return named.join(roster.select("season", "game_id", "player_id"), ["season", "game_id", "player_id"], "left_anti")


def unlisted_players(events: DataFrame, roles: Sequence[str], listed: str, skipped_types: Sequence[str]) -> DataFrame:
    """Players whom events name in a role but none has in `listed`, of the same game: roster_gaps of events that hold their roster.

    One pass: each name says whether it is a role or a listing, and a player is a gap if only the
    first ever holds, so events are neither read nor shuffled twice. They are dealt out by game before
    their names are rows.
    """
    skipped = F.coalesce(F.col("event_type").isin(*skipped_types), F.lit(False))
    item = lambda c, is_listed: F.struct(F.when(F.lit(is_listed) | ~skipped, F.col(c)).alias("player_id"), F.lit(is_listed).alias("listed"))
    events = events.select("season", "game_id", "event_type", *roles, *([] if listed in roles else [listed])).repartition("game_id")
    names = events.select("season", "game_id", F.explode(F.array(*[item(c, False) for c in roles], item(listed, True))).alias("_n")).select("season", "game_id", "_n.*")
    by = names.filter("player_id is not null").groupBy("season", "game_id", "player_id").agg(F.max("listed").alias("listed"))
    return by.filter("not listed").drop("listed")


def roster_union(payload_rows: DataFrame, gap_rows: DataFrame, bios: DataFrame) -> DataFrame:
    """Roster rows of payloads, and of the gaps with what is known of their players; payload rows come first."""
    filled = lookup(gap_rows, bios, {"player_id": "player_id"}, {"full_name": "full_name", "team_id": "team_id"})
    both = payload_rows.withColumn("_p", F.lit(0)).unionByName(filled.withColumn("_p", F.lit(1)), allowMissingColumns=True)
    return best_row(both, ["season", "game_id", "player_id"], F.col("_p"), F.col("team_id").asc_nulls_last()).drop("_p")


def season_gated_merge(target: DataFrame, source: DataFrame, keys: Sequence[str], attrs: Sequence[str], latest_season: int, now: Column) -> Merged:
    """Updates only rows whose season isn't the latest, where attributes differ and neither is null."""
    changed = lambda t, s: (t("season") != latest_season) & any_of({c: plain(t(c), s(c)) for c in attrs})
    new = {c: (lambda t, s, c=c: s(c)) for c in attrs} | {"season": lambda t, s: s("season"), "update_dte": lambda t, s: now}
    return merge(target, source, keys, [Update(new, changed)], [Insert({"insert_dte": lambda t, s: now})])


def roll_off(df: DataFrame, run: Column, now: Column) -> DataFrame:
    """Games that are marked in play but were yesterday no longer are."""
    from tarnfold.operators.merge import update_where

    return update_where(df, F.col("game_in_play") & (F.col("game_date") == F.date_sub(run, 1)), {"game_in_play": F.lit(False), "update_dte": now})


def plays_on_shifts(events: DataFrame, shifts: DataFrame, minutes: int = 1) -> DataFrame:
    """Events with the shifts they fall into, by game and minute: a hash join with a range left to check."""
    width = 60 * minutes
    e = events.withColumn("_m", F.floor(F.col("game_seconds") / width))
    s = shifts.withColumn("_m", F.explode(F.sequence(F.floor(F.col("start_seconds") / width), F.floor(F.col("end_seconds") / width))))
    return e.join(s, ["game_id", "_m"]).filter(F.col("game_seconds").between(F.col("start_seconds"), F.col("end_seconds"))).drop("_m")


def bronze_merge(target: DataFrame, source: DataFrame, keys: Sequence[str], now: Column, list_name: str | None = None) -> Merged:
    """Responses into the landing table. One without content never replaces one with content, and isn't a new row."""
    from tarnfold.sources.envelope import has_content

    full = lambda t, s: F.coalesce(s("http_status") == 200, F.lit(False)) & has_content(s("payload"), list_name)
    new = {c: (lambda t, s, c=c: s(c)) for c in ("http_status", "payload")} | {"update_ts_utc": lambda t, s: now}
    return merge(target, source, keys, [Update(new, lambda t, s: full(t, s) & null_safe(t("payload"), s("payload")))], [Insert({"ingest_ts_utc": lambda t, s: now}, full)])


def payload_roster(payloads: DataFrame, schema: str, current: DataFrame, players: DataFrame, status: DataFrame, keep: Sequence[str] = ("season", "game_id", "game_date")) -> DataFrame:
    """Rosters in game payloads and today's rosters, one row for each game's player.

    current: as the result's first columns. players: player_id, full_name, team_id. status: game_id,
    in_play. A team unlike the player master's makes that one the previous team.
    """
    spots = payloads.select(*keep, F.explode(F.from_json("payload", schema).getField("rosterSpots")).alias("_e")).select(*keep, "_e.*")
    rows = spots.select(*keep, *build_fields(spots, {"playerId": "bigint", "teamId": "bigint", "sweaterNumber": "int"}))
    both = rows.withColumn("_p", F.lit(0)).unionByName(current.withColumn("_p", F.lit(1)), allowMissingColumns=True)
    one = best_row(both.filter("player_id is not null"), [*keep[:2], "player_id"], F.col("_p"), F.col("team_id").asc_nulls_last()).drop("_p")
    named = lookup(one, players, {"player_id": "player_id"}, {"full_name": "full_name", "_team": "team_id"})
    named = lookup(named, status, {"game_id": "game_id"}, {"game_in_play": "in_play"})
    moved = F.when(~F.col("team_id").eqNullSafe(F.col("_team")), F.col("_team"))
    return named.withColumns({"team_id_prev_team": moved, "game_in_play": F.coalesce("game_in_play", F.lit(False))}).drop("_team")


ROSTER_LISTS = ("forwards", "defensemen", "goalies")
ROSTER_RULES: dict[str, object] = {
    # Source field of a roster's player, name and type of its column.
    "id": {"target": "player_id", "type": "bigint"},
    "firstName.default": _text("first_name"),
    "lastName.default": _text("last_name"),
    "positionCode": _text("player_pos", upper=True),
    "sweaterNumber": {"target": "jersey_num", "type": "int"},
    "shootsCatches": _text("shoots_catches", upper=True),
    "birthDate": {"target": "birth_dte", "type": "date", "trim": True},
    "birthCountry": _text("birth_country"),
    "heightInInches": {"target": "height_inches", "type": "int"},
    "weightInPounds": {"target": "weight_lbs", "type": "int"},
    "headshot": _text("headshot"),
}


def roster_players(payloads: DataFrame, schema: str | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """Players of rosters, one row for each payload and player, after the payload's columns to keep: three lists in one pass, texts trimmed, dates and numbers cast.

    A text that is no date or number is null. unused_fields names what the lists have beside the fields
    that are read. A payload's repeats go within its row: nothing is shuffled.
    """
    read_in = parsed(payloads, schema or infer(payloads))
    found = [c for c in ROSTER_LISTS if c in read_in.schema["json"].dataType.fieldNames()]
    lists = read_in.select(*keep, *[F.col(f"json.{c}").alias(c) for c in found])
    whole = lists.select(*keep, whole_list(lists, *found).alias("_players"))
    element = whole.schema["_players"].dataType.elementType
    whole = once_each(whole, "_players", lambda x: element_fields(field_of(x), element, {"id": "bigint"})[0])
    players = whole.select(*keep, F.explode_outer("_players").alias("_e")).select(*keep, "_e.*")
    rows = players.select(*keep, *build_fields(players, ROSTER_RULES)).filter("player_id is not null")
    rows = with_unused(rows, T.StructType([f for f in players.schema if f.name not in keep]), list(ROSTER_RULES))
    return rows.select(
        *keep, "player_id", F.nullif(F.concat_ws(" ", "first_name", "last_name"), F.lit("")).alias("player_name"),
        *[c for c in targets(ROSTER_RULES) if c not in ("player_id", "first_name", "last_name")], F.lit(True).alias("is_active"), "unused_fields", "unused_count",
    )


ROSTER_OF = ("game_id", "team_id", "request_key")


def _of_games() -> list[Column]:
    return [V.season_of_game(F.col("game_id")).cast("int").alias("season"), F.col("game_id"), F.col("team_id"), F.upper(F.trim("request_key")).alias("team_abbrev")]


def _one_a_game(rows: DataFrame, games: DataFrame) -> DataFrame:
    return across_payloads(rows, games.select("game_id"), lambda df: one_each(df, ["game_id", "player_id"]))


def current_rosters(payloads: DataFrame, schema: str | None = None) -> DataFrame:
    """Rosters of the day, one row for each game and player.

    payloads: game_id, team_id, request_key (the team's abbreviation), payload. Only players of games that
    several payloads have are shuffled. Payloads that many games share are for game_rosters.
    """
    rows = roster_players(payloads, schema, ROSTER_OF)
    return _one_a_game(rows.select(*_of_games(), *rows.columns[len(ROSTER_OF) :]), payloads)


def game_rosters(players: DataFrame, games: DataFrame) -> DataFrame:
    """current_rosters of responses that many games share: each is read once, and its players go to all of its games.

    games: game_id, team_id, request_key and columns by which they refer to responses. players: the same
    columns, and what roster_players gives. A response's players meet its games as a list, so that there is
    one match for each game; where their rows multiply, none but the game's and the player's own values are written.
    """
    on = [c for c in games.columns if c not in ROSTER_OF]
    once = cut(one_each(players, [*on, "player_id"]))
    values = [c for c in once.columns if c not in on]
    lists = few(once.groupBy(*on).agg(F.collect_list(F.struct(*values)).alias("_players")), once)
    met = games.select(*on, *_of_games()).join(lists, on).drop(*on)
    rows = met.select(*met.columns[:-1], F.explode("_players").alias("_e")).select(*met.columns[:-1], *[F.col(f"_e.{c}").alias(c) for c in values])
    return _one_a_game(rows, games)


def gold_merge(target: DataFrame, silver: DataFrame, keys: Sequence[str], texts: Sequence[str], now: Column) -> Merged:
    """A narrow projection of silver: texts that differ by more than case and blanks; a null source is no news."""
    changed = lambda t, s: any_of({c: as_text(t(c), F.coalesce(s(c), t(c))) for c in texts})
    new = {c: (lambda t, s, c=c: F.coalesce(s(c), t(c))) for c in texts} | {"update_dte": lambda t, s: now}
    return merge(target, silver.select(*keys, *texts), keys, [Update(new, changed)], [Insert({"insert_dte": lambda t, s: now})])
