"""Masters of players and teams: the best row of each, and the merges that keep them."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnfold.functions import values as V
from tarnfold.functions.compare import any_of, failed_conditions, null_as, null_safe, plain, unless_sentinel, unless_source_null
from tarnfold.operators.merge import Insert, Merged, Update, merge, upsert
from tarnfold.operators.rows import best_row, latest, lookup
from tarnfold.operators.shred import build_fields, unpack_list, valid_payloads

NO_DATE = dt.date(1900, 1, 1)

# ---------------------------------------------------------------- players


PLAYER_RULES: dict[str, object] = {
    # Source field of a player, name and type of its column.
    "playerId": "bigint",
    "name": {"target": "full_name", "type": "string", "trim": True},
    "positionCode": {"type": "string", "trim": True},
    "teamId": "bigint",
    "teamAbbrev": {"type": "string", "trim": True, "upper": True},
    "lastTeamId": {"target": "team_id_prev_team", "type": "bigint"},
    "lastTeamAbbrev": {"target": "team_abbrev_prev_team", "type": "string", "trim": True, "upper": True},
    "lastSeasonId": {"target": "last_active_season", "type": "int"},
    "sweaterNumber": {"target": "jersey_num", "type": "int"},
    "active": {"target": "is_active", "type": "boolean"},
}


def player_rows(payloads: DataFrame, schema: str | None = None) -> DataFrame:
    """Players of search responses by the field map; of several responses to a request the latest counts. A field that no response has is a typed null."""
    rows = unpack_list(_latest_valid(payloads), "data", schema)
    return rows.select(*build_fields(rows, PLAYER_RULES))


def summary_sides(payloads: DataFrame, schema: str | None = None) -> DataFrame:
    """player_id and shoots_catches of a kind of summary."""
    rows = unpack_list(_latest_valid(payloads), "data", schema)
    return rows.select(*build_fields(rows, {"playerId": "bigint", "shootsCatches": {"type": "string", "trim": True}}))


def _latest_valid(payloads: DataFrame) -> DataFrame:
    return latest(valid_payloads(payloads), ["endpoint", "request_key"], "ingest_ts_utc", "payload")


def master_of_payloads(search: DataFrame, skaters: DataFrame, goalies: DataFrame) -> DataFrame:
    """The player master from landed responses: search results, and the summaries that know a player's side."""
    return player_master(player_rows(search), catching_sides(summary_sides(skaters), summary_sides(goalies)))


def catching_sides(skaters: DataFrame, goalies: DataFrame) -> DataFrame:
    """player_id and shoots_catches of both kinds of summaries; of several sides the least."""
    both = skaters.select("player_id", "shoots_catches").unionByName(goalies.select("player_id", "shoots_catches"))
    return both.groupBy("player_id").agg(F.min("shoots_catches").alias("shoots_catches"))


def player_master(players: DataFrame, sides: DataFrame) -> DataFrame:
    """The best row for each player: active ones first, then the most complete. sides: player_id (once each), shoots_catches."""
    required = ("player_id", "full_name", "team_id", "team_abbrev", "last_active_season", "is_active")
    rows = lookup(players, sides, {"player_id": "player_id"}, {"shoots_catches": "shoots_catches"})
    rows = rows.withColumns({"position_category": V.position_category(F.col("position_code")), "empty_rate": V.completeness(*required)})
    return best_row(rows.filter("player_id is not null"), ["player_id"], F.col("is_active").desc_nulls_last(), F.col("empty_rate"), F.col("team_id").asc_nulls_last(), F.col("position_category"), F.col("full_name"), F.col("team_abbrev"))


def player_merge(target: DataFrame, source: DataFrame, now: Column) -> Merged:
    """Players into their master: player_id, full_name, position_code, team_id and team_abbrev with their _prev_team, last_active_season, jersey_num, shoots_catches, is_active, empty_rate.

    A null of the source is no news, but for the jersey and the side, where it counts as a change
    and the stored value stays. The team that a player leaves moves to the previous one, and an
    inactive player's last team is a previous one. failed_condition names what differed.
    """
    team = lambda t, s: F.coalesce(s("team_id"), t("team_id"))
    active = lambda t, s: null_as(t("is_active"), s("is_active"), False)

    def given(part: str):
        """The source's previous team, of which part is id or abbrev."""
        now_at = lambda t, s: F.coalesce(s(f"team_{part}"), t(f"team_{part}"))
        gone = lambda t, s: F.when(~s("is_active"), F.coalesce(now_at(t, s), s(f"team_{part}_prev_team"))).otherwise(s(f"team_{part}_prev_team"))
        return lambda t, s: F.when(F.coalesce(team(t, s) != s("team_id_prev_team"), F.lit(True)), gone(t, s))

    def previous(part: str):
        back = lambda t, s: (F.coalesce(t("team_id"), team(t, s)) == team(t, s)) & (t("team_id_prev_team") == team(t, s))
        return lambda t, s: (
            F.when(back(t, s), F.lit(None))
            .when(t("team_id").isNull(), F.coalesce(t(f"team_{part}_prev_team"), given(part)(t, s)))
            .when(t("team_id") != team(t, s), t(f"team_{part}"))
            .otherwise(t(f"team_{part}_prev_team"))
        )

    def differs(t, s):
        kept = {c: null_safe(t(c), F.coalesce(s(c), t(c))) for c in ("full_name", "team_id")}
        return kept | {c: null_safe(t(c), s(c)) for c in ("jersey_num", "shoots_catches")} | {"position_code": null_safe(t("position_code"), F.coalesce(s("position_code"), t("position_code"))), "is_active": active(t, s)}

    def reasons(t, s):
        noted = {c: differs(t, s)[c] for c in ("full_name", "team_id", "jersey_num")}
        return failed_conditions(noted | {"position_code": null_safe(t("position_code"), s("position_code")), "is_active": active(t, s), "empty_rate": plain(t("empty_rate"), s("empty_rate"))})

    kept = ("full_name", "team_id", "team_abbrev", "jersey_num", "position_code", "shoots_catches", "is_active")
    changed = {c: (lambda t, s, c=c: F.coalesce(s(c), t(c))) for c in kept} | {f"team_{p}_prev_team": previous(p) for p in ("id", "abbrev")}
    changed |= {"last_active_season": lambda t, s: F.greatest(t("last_active_season"), s("last_active_season")), "failed_condition": reasons}
    return upsert(target, source, ["player_id"], differs, now, made={f"team_{p}_prev_team": given(p) for p in ("id", "abbrev")}, changed=changed)


# What a refresh looks for in a roster row, with the placeholder that stands for nothing.
REFRESHED: dict[str, object] = {"position_code": "u", "team_id_prev_team": None, "team_abbrev_prev_team": None, "jersey_num": 999, "shoots_catches": "u"}


def player_refresh(target: DataFrame, rosters: DataFrame, now: Column) -> Merged:
    """Players from their latest roster rows: placeholders are no news, null is no news, and a team moves to the previous one.

    Placeholders are 999 for teams and jerseys and u for positions and sides. Columns that the
    rosters or the target lack have no part in it. A target's empty_rate becomes the roster row's
    share of nulls and placeholders: REFRESHED of sixteen fields.
    """
    rated = "empty_rate" in target.columns
    if rated:
        given = {c: h for c, h in REFRESHED.items() if c in rosters.columns}
        rosters = rosters.withColumn("empty_rate", V.emptiness(given, 16, len(REFRESHED) - len(given)))
    placeholders = {"team_id": 999, "jersey_num": 999, "shoots_catches": "u", "position_code": "u"}
    holders = {c: p for c, p in placeholders.items() if c in target.columns and c in rosters.columns}
    said = lambda c, t, s: F.coalesce(F.nullif(s(c), F.lit(holders[c])), t(c))
    news = lambda t, s: {c: unless_sentinel(t(c), F.coalesce(s(c), t(c)), p) for c, p in holders.items()}
    new = {c: (lambda t, s, c=c: said(c, t, s)) for c in holders} | {
        "team_id_prev_team": lambda t, s: V.previous_on_change(t("team_id"), said("team_id", t, s), t("team_id_prev_team")),
        "last_season": lambda t, s: F.greatest(t("last_season"), s("last_season")),
        "update_dte": lambda t, s: now,
    }
    if "failed_condition" in target.columns:
        new["failed_condition"] = lambda t, s: failed_conditions(news(t, s))
    if rated:
        new["empty_rate"] = lambda t, s: s("empty_rate")
    made = {c: (lambda t, s, c=c: F.nullif(s(c), F.lit(holders[c]))) for c in holders} | {"insert_dte": lambda t, s: now}
    return merge(target, rosters, ["player_id"], [Update(new, lambda t, s: any_of(news(t, s)))], [Insert(made)])


# ---------------------------------------------------------------- teams

TEAM_RULES: dict[str, object] = {
    # Source field of a team, name and type of its column.
    "franchiseId": "int",
    "fullName": {"target": "team_name", "type": "string", "trim": True},
    "id": {"target": "team_id", "type": "int"},
    "leagueId": "int",
    "rawTricode": {"target": "team_abbrev", "type": "string", "upper": True, "trim": True},
}


def team_rows(payloads: DataFrame, schema: str, keep: tuple[str, ...] = ("season",)) -> DataFrame:
    """Teams of payloads that are lists (wrapped as data) of objects with a list named data themselves."""
    lists = unpack_list(payloads, "data", schema, keep)
    teams = lists.select(*keep, F.explode("data").alias("_e")).select(*keep, "_e.*")
    return teams.select(*keep, *build_fields(teams, TEAM_RULES))


def team_merge(target: DataFrame, source: DataFrame, now: Column) -> Merged:
    differs = lambda t, s: {c: plain(t(c), s(c)) for c in ("season", "team_name", "league_id", "team_abbrev")} | {"franchise_id": null_as(t("franchise_id"), s("franchise_id"), 999)}
    return upsert(target, source, ["team_id"], differs, now)


def team_details(schedule: DataFrame, masters: DataFrame, franchises: DataFrame, run: Column) -> DataFrame:
    """Names, city, first and last date, last season and state of each team; teams without games are of old.

    schedule: season, team_id, team_abbrev, team_name, team_city, pre_season_start_date,
    playoff_end_date, insert_dte. masters: team_id, team_abbrev, team_name, franchise_id.
    franchises: franchise_id, last_active_season (null: it still plays). A team is inactive if its
    franchise has ended or its last date lies in a year before the schedule's season. Names are
    those of its latest season.
    """
    current = schedule.filter(F.to_date("insert_dte") <= run).agg(F.max("season")).first()[0]
    latest = {c: F.max_by(c, "season").alias(c) for c in ("team_abbrev", "team_name", "team_city")}
    bounds = schedule.groupBy("team_id").agg(*latest.values(), F.min("pre_season_start_date").alias("active_from"), F.max("playoff_end_date").alias("active_to"))
    season = F.lit(current).cast("int")
    year = F.year("active_to")
    over = F.coalesce(year < (season / 10000).cast("int"), F.lit(False))
    playing = lookup(bounds, masters, {"team_id": "team_id"}, {"franchise_id": "franchise_id"}, how="inner").withColumns({"_over": over, "_season": F.when(over, (year - 1) * 10000 + year).otherwise(season)})
    of_old = masters.join(bounds.select("team_id"), "team_id", "left_anti").select("team_id", "team_abbrev", "team_name", "franchise_id").withColumn("_over", F.lit(True))
    teams = lookup(playing.unionByName(of_old, allowMissingColumns=True), franchises, {"franchise_id": "franchise_id"}, {"_ended": "last_active_season"})
    return teams.select(
        "team_id",
        "team_abbrev",
        "team_name",
        "team_city",
        (F.col("_ended").isNull() & ~F.col("_over")).alias("is_active"),
        "active_from",
        "active_to",
        F.coalesce("_season", "_ended").alias("last_active_season"),
    )


def details_merge(target: DataFrame, source: DataFrame, now: Column) -> Merged:
    """Team details, silver or gold: what the target lacks of city and season isn't compared."""
    defaults = {"team_city": "__NULL__", "active_from": NO_DATE, "active_to": NO_DATE, "last_active_season": 0}

    def differs(t, s):
        return {c: plain(t(c), s(c)) for c in ("team_abbrev", "team_name", "is_active")} | {c: unless_source_null(t(c), s(c), d) for c, d in defaults.items() if c in target.columns}

    return upsert(target, source, ["team_id"], differs, now)
