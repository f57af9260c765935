"""Tables of the layers: columns by the rules of their payloads, keys, order within files, partitions and buckets.

Tables that grow by the day are partitioned by it, so a merge over two days rewrites two partitions.
Masters are bucketed by their key, so a merge into them does not shuffle them. Gold tables are some
of their silver table's columns, quarantine tables all of them and the reason.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from tarnfold.plans.jobs import EVENT_RULES, SHIFT_RULES
from tarnfold.plans.masters import TEAM_RULES
from tarnfold.sources.tables import Table, declare, table_of

_GAME = "season int, game_id bigint, game_date date"
_MERGED = "active_row boolean, game_in_play boolean, logic_block string, failed_condition string"
_SIDE = "team_id bigint, team_abbrev string, team_name string"
_PLAYER = "player_id bigint, player_name string, player_pos string"
_DETAILS = "team_id int, team_abbrev string, team_name string, team_city string, is_active boolean, active_from date, active_to date, last_active_season int"
_ENVELOPE = "endpoint string, request_key string, http_status int, payload string, api_url string, ingest_ts_utc timestamp, update_ts_utc timestamp"
_LEDGER = "attempt_count int not null, last_attempt_dte date not null, next_retry_dte date not null"

_DAY, _BY_GAME = ("game_date",), ("game_id",)
_SIDE_KEY = ("season", "game_id", "game_date", "team_id")
_EVENT_KEY = ("season", "game_id", "game_date", "event_idx")
_SHIFT_KEY = ("game_id", "game_date", "team_id", "shift_id")

# The landing tables, and what some of them have beside the envelope.
_LANDED = {
    "schedules": "scrape_plan string", "special_teams": "", "vegas_totals": "", "pbp_data": "", "shift_data": "", "team_master_ids": "season int", "team_details": "season int",
    "team_lines": "game_date date", "player_search": "", "player_search_season": "", "player_game_rosters": "team_id int, game_id bigint",
}

# Numbers of special teams by topic; those that end in pct are decimal(6,5), points' decimal(4,2), others int. Gold has those after the bar.
_TOPICS = {
    "pp_stats": "games_played wins losses ot_losses points point_pct pp_goals_per_game pp_net_goals_per_game pp_opportunities_per_game sh_goals_against_per_game | power_play_goals_for power_play_pct power_play_net_pct pp_net_goals pp_opportunities pp_time_on_ice_per_game sh_goals_against",
    "pk_stats": "games_played wins losses ot_losses points points_pct pk_net_goals_per_game pp_goals_against_per_game sh_goals_for_per_game times_shorthanded_per_game | penalty_kill_net_pct penalty_kill_pct pk_net_goals pk_time_on_ice_per_game pp_goals_against sh_goals_for times_shorthanded",
    "pp_toi": "games_played goals4v3 goals5v3 goals5v4 overall_power_play_pct point_pct | pp_opportunities opportunities4v3 opportunities5v3 opportunities5v4 power_play_pct4v3 power_play_pct5v3 power_play_pct5v4 power_play_goals_for time_on_ice4v3 time_on_ice5v3 time_on_ice5v4 time_on_ice_pp",
    "pk_toi": "point_pct | goals_against3v4 goals_against3v5 goals_against4v5 overall_penalty_kill_pct penalty_kill_pct3v4 penalty_kill_pct3v5 penalty_kill_pct4v5 shorthanded_goals_against time_on_ice3v4 time_on_ice3v5 time_on_ice4v5 time_on_ice_shorthanded times_shorthanded times_shorthanded3v4 times_shorthanded3v5 times_shorthanded4v5",
}


def _number(name: str) -> str:
    kind = "decimal(4,2)" if name in ("point_pct", "points_pct") else "decimal(6,5)" if "_pct" in name else "int"
    return f"{name} {kind}"


def _gold(silver: Table, names: str, key: Sequence[str] = (), more: str = "") -> Table:
    """A table of some of silver's columns (not its py_source), by silver's key or another, and further ones."""
    fields = [T.StructField(f.name, f.dataType) for n in names.split() for f in silver.schema if f.name == n]
    fields += list(T.StructType.fromDDL(more)) if more else []
    key = tuple(key or silver.key)
    audit = [f for f in silver.schema if f.name in ("insert_dte", "update_dte")]
    schema = T.StructType([T.StructField(f.name, f.dataType, f.name not in key) for f in fields] + audit)
    return Table("gold", silver.name, schema, key, silver.cluster_by, silver.partition_by, silver.buckets)


def _quarantined(silver: Table) -> Table:
    """Rows that broke a rule: nothing is required of them but the reason, and they have no key."""
    fields = [T.StructField(f.name, f.dataType) for f in silver.schema]
    return Table("quarantine", silver.name, T.StructType([*fields, T.StructField("quarantine_reason", T.StringType(), False)]), (), silver.cluster_by, silver.partition_by)


def _topic(name: str) -> tuple[Table, Table]:
    own, shared = (part.split() for part in _TOPICS[name].split("|"))
    sides = f"{_GAME}, {_SIDE}, home_road string, opp_team_abbrev string"
    silver = table_of("silver", name, {}, _SIDE_KEY, f"{sides}, {', '.join(_number(n) for n in own + shared)}", _BY_GAME, _DAY)
    return silver, _gold(silver, f"season team_id team_abbrev game_id game_date home_road opp_team_abbrev {' '.join(shared)}")


def tables() -> tuple[Table, ...]:
    """All tables. Their types are parsed by the running session."""
    landed = [table_of("bronze", name, {}, ("endpoint", "request_key"), f"{_ENVELOPE}, {more}".strip(", "), ("request_key",), ("endpoint",)) for name, more in _LANDED.items()]
    schedules = table_of(
        "silver", "schedules", {}, ("season", "game_id", "home_road"),
        f"""{_GAME}, {_SIDE}, team_city string, game_type int, home_road string, start_time string, start_ts_utc string, eastern_utc_offset string, venue_offset string, venue_timezone string, neutral_site boolean,
        pre_season_start_date date, regular_season_start_date date, regular_season_end_date date, playoff_end_date date, unused_fields string, unused_count int""",
        ("game_date",), ("season",),
    )
    events = table_of("silver", "events", EVENT_RULES, _EVENT_KEY, f"{_GAME}, event_idx int, game_seconds int, event_team_abbrev string, {_MERGED}", _BY_GAME, _DAY)
    shifts = table_of("silver", "shifts", SHIFT_RULES, _SHIFT_KEY, f"{_GAME}, player_name string, start_seconds int, end_seconds int, {_MERGED}", _BY_GAME, _DAY)
    rosters = table_of(
        "silver", "game_rosters", {}, ("season", "game_id", "player_id"),
        f"""{_GAME}, {_PLAYER}, {_SIDE}, full_name string, position_code string, jersey_num int, shoots_catches string, birth_dte date, birth_country string, height_inches int, weight_lbs int, headshot string,
        team_id_prev_team bigint, team_abbrev_prev_team string, is_active boolean, game_in_play boolean, unused_fields string, unused_count int""",
        _BY_GAME, _DAY,
    )
    players = table_of(
        "silver", "players", {}, ("player_id",),
        f"""{_PLAYER}, {_SIDE}, full_name string, position_code string, team_id_prev_team bigint, team_abbrev_prev_team string, last_active_season int, jersey_num int, shoots_catches string, is_active boolean,
        empty_rate decimal(4,2), failed_condition string""",
        buckets=16,
    )
    teams = table_of("silver", "teams", TEAM_RULES, ("team_id",), "season int", buckets=1)
    details = table_of("silver", "team_details", {}, ("team_id",), _DETAILS, buckets=1)
    names = table_of("silver", "team_names", {}, ("team_id", "team_name", "category"), "latest_season int, team_id int, team_name string, category string, website string, is_active boolean, active_from date, active_to date", buckets=1)
    totals = table_of(
        "silver", "vegas_totals", {}, ("game_date", "team_id"),
        f"""season_id bigint, season_type string, game_date date, game_date_time timestamp, event_id bigint, game_type int, {_SIDE}, home_road string, fav_dog string, conference_game boolean, division_game boolean,
        moneyline_open int, moneyline_current int, moneyline_pct int, moneyline_change int, over_under_open decimal(3,1), over_under_current decimal(3,1), over_under_pct int, over_under_change decimal(3,1),
        implied_total_open decimal(3,1), implied_total_current decimal(3,1), neutral_site boolean, stadium_name string, playoff_ind boolean, number_of_bets double, number_of_bets_z_score double""",
        ("team_id",), _DAY,
    )
    lines = table_of(
        "silver", "team_lines", {}, ("season", "game_date", "team_id", "team_line", "team_line_idx"),
        f"""{_GAME}, {_SIDE}, {_PLAYER}, player_pos_cat string, team_line string, team_line_idx int, is_active boolean, first_name string, last_name string, player_key string, join_key string, lines_source_url string,
        source_update_dte timestamp, strength_identifier string, strength_name string, game_time_dec_ind boolean, injury_status string, position_name string, line_identifier string, line_name string, source_player_id int""",
        ("team_id",), _DAY,
    )
    people = "player_1_id player_1_name player_2_id player_2_name player_3_id player_3_name"
    gold_events = _gold(
        events,
        """season game_id game_date period time_in_period time_remaining game_seconds situation_code zone_code event_type event_idx event_id event_team_id event_team_abbrev x_coord y_coord shot_type missed_shot_desc
        penalty_desc penalty_type_desc penalty_duration play_stopped_reason intermission_active game_in_play""",
        more=", ".join(f"{c} {'bigint' if c.endswith('_id') else 'string'}" for c in people.split()),
    )
    gold_shifts = _gold(
        shifts,
        """season game_id game_date team_id team_abbrev player_id player_name shift_id period start_time end_time duration shift_number detail_code event_description event_details event_number type_code game_in_play""",
        ("season", *_SHIFT_KEY, "player_id"),
    )
    *on_events, made, changed = gold_events.schema.fields
    on_shifts = [*on_events, *T.StructType.fromDDL("shift_id bigint, shift_start_game_seconds int, shift_end_game_seconds int"), made, changed]
    shift_play_key = (*_EVENT_KEY, "shift_id")
    plays_on_shifts = Table("gold", "plays_on_shifts", T.StructType([T.StructField(f.name, f.dataType, f.name not in shift_play_key) for f in on_shifts]), shift_play_key, _BY_GAME, _DAY)
    golds = [
        _gold(schedules, "season game_id game_date game_type start_time team_abbrev team_id home_road", ("season", "game_id", "team_id")),
        gold_events,
        gold_shifts,
        plays_on_shifts,
        _gold(rosters, "season player_id player_name game_id game_date team_id player_pos is_active", ("season", "game_date", "game_id", "player_id")),
        _gold(players, "player_id player_name player_pos shoots_catches"),
        _gold(teams, "team_id team_abbrev team_name"),
        _gold(details, "team_id team_abbrev team_name is_active active_from active_to"),
        _gold(names, "latest_season team_id team_name category website is_active active_from active_to"),
        _gold(totals, "game_date team_id team_name team_abbrev home_road fav_dog", more="moneyline int, implied_total decimal(3,1)"),
        _gold(lines, "season team_id team_abbrev game_date game_id player_name player_id player_pos player_pos_cat team_line team_line_idx"),
    ]
    ops = [
        table_of("ops", "schema_audit", {}, ("table_name", "endpoint"), "table_name string, endpoint string, schema_json string, schema_hash string, schema_drift_ind boolean, last_check_dte timestamp"),
        table_of("ops", "retry_ledger", {}, ("request_key",), f"request_key string, {_LEDGER}"),
        *[table_of("ops", f"games_missing_{what}", {}, ("season", "game_id"), f"season int, game_id bigint, {_LEDGER}") for what in ("events", "shifts")],
    ]
    topics = [t for name in _TOPICS for t in _topic(name)]
    return (*landed, schedules, events, shifts, rosters, players, teams, details, names, totals, lines, *topics, *golds, _quarantined(events), _quarantined(shifts), *ops)


def by_name(full: str) -> Table:
    """A table by layer and name: silver.events."""
    return next(t for t in tables() if t.full == full)


def declare_all(spark: SparkSession) -> None:
    """Declares every table, so that nothing is inferred at a first write."""
    for table in tables():
        declare(spark, table)
