"""Work lists and gates: what a run has to fetch or redo, as rows. The run's clock is a parameter."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnfold.functions.values import touched, within_days
from tarnfold.operators.rows import top


def recent_or_cold(schedule: DataFrame, table: DataFrame, run: Column, days: int = 2) -> DataFrame:
    """One row (game_type) if there are games of types 2 and 3 in the last days, or a null row if the table is empty."""
    recent = schedule.filter(F.col("game_type").isin(2, 3) & within_days(F.col("game_date"), run, days)).select("game_type").distinct()
    empty = table.limit(1).agg(F.count(F.lit(1)).alias("n")).filter("n = 0").select(F.lit(None).cast("int").alias("game_type"))
    return recent.unionByName(empty).orderBy(F.col("game_type").asc_nulls_last()).limit(1)


def work_list(games: DataFrame, loaded: DataFrame, ledger: DataFrame, run: Column, now: Column, delay_minutes: int = 15, min_season: int = 0) -> DataFrame:
    """(game_id, game_date, bucket): each game's reasons to be fetched, in one pass over the games.

    games: game_id, season, game_date, start_ts, ended. loaded: game_id. ledger: game_id,
    next_retry_dte. Buckets: 'in play' (today, begun by the delay, not ended), 'ended today',
    'last two' (days), 'missing' (never loaded, past, and its retry due or none noted) and 'cold
    start' (never loaded, past or begun, and not in the ledger at all).
    """
    g = (
        games.filter(F.col("season") >= min_season)
        .join(loaded.select("game_id").distinct().withColumn("_loaded", F.lit(True)), "game_id", "left")
        .join(ledger.select("game_id", "next_retry_dte"), "game_id", "left")
    )
    today = F.col("game_date") == run
    begun = now >= F.col("start_ts") + F.make_dt_interval(mins=F.lit(delay_minutes))
    absent, due = F.col("_loaded").isNull(), F.coalesce(F.col("next_retry_dte") <= run, F.lit(True))
    past = F.col("game_date") < run
    buckets = {
        "in play": today & begun & ~F.col("ended"),
        "ended today": today & F.col("ended"),
        "last two": past & within_days(F.col("game_date"), run, 2),
        "missing": absent & past & due & F.col("next_retry_dte").isNotNull(),
        "cold start": absent & (past | (today & begun)) & F.col("next_retry_dte").isNull(),
    }
    tags = F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in buckets.items()]))
    return g.select("game_id", "game_date", F.explode(tags).alias("bucket"))


def next_batch(work: DataFrame, n: int) -> DataFrame:
    """The first n games of the work list, by date and id."""
    return top(work.groupBy("game_id", "game_date").agg(F.min("bucket").alias("bucket")), n, F.col("game_date"), F.col("game_id"))


def payloads_of(work: DataFrame, responses: DataFrame, key: str = "game_id") -> DataFrame:
    """The responses of a work list's keys, each once however many reasons the list has for it."""
    return responses.join(work.select(key).distinct(), key)


def is_final(batch: DataFrame, n: int) -> DataFrame:
    """One row: whether the batch is short and nothing of it is a cold start."""
    return batch.agg(((F.count(F.lit(1)) < n) & ~F.coalesce(F.bool_or(F.col("bucket") == "cold start"), F.lit(False))).alias("final"))


def missing_weeks(dates: DataFrame, bronze: DataFrame, silver: DataFrame) -> DataFrame:
    """Every seventh day from the first date to the last that neither table has (each: date d)."""
    grid = dates.agg(F.explode(F.sequence(F.min("d"), F.max("d"), F.expr("interval 7 days"))).alias("d"))
    return grid.join(bronze.select("d"), "d", "left_anti").join(silver.select("d"), "d", "left_anti")


def backfill_ranges(rows: DataFrame, loaded: DataFrame, keys: Sequence[str], run: Column, by: str = "game_type", date: str = "game_date", older_than: int = 2) -> DataFrame:
    """First and last date of each kind's rows that aren't loaded and are older than some days."""
    todo = rows.filter(F.col(date) < F.date_sub(run, older_than)).join(loaded.select(*keys), list(keys), "left_anti")
    return todo.groupBy(by).agg(F.min(date).alias("start_date"), F.max(date).alias("end_date"), F.count(F.lit(1)).alias("n_rows"))


def date_grid(plan: DataFrame, start: str = "start_date", end: str = "end_date", days: int = 7) -> DataFrame:
    return plan.withColumn("d", F.explode(F.sequence(F.col(start), F.greatest(start, end), F.expr(f"interval {days} days"))))


#: The first day of the first load, and days after the playoffs until the next schedule is looked for.
FIRST_DAY, GAP_DAYS = "2008-10-01", 30


def scrape_plan(seasons: DataFrame, run: Column, *keep: str) -> DataFrame:
    """The plan of each row of season dates: start_date, end_date, scrape_plan.

    seasons: ps_start_date, rs_start_date, rs_end_date, rs_last_game_date, playoff_end_date (dates),
    sched_fully_loaded. The first branch that holds: nothing loaded yet, before or after the end of
    June; up to the regular season's last game; later in the regular season (nothing to fetch);
    looking for playoff dates on certain days; in the playoffs; an early part of a schedule
    released; GAP_DAYS after the playoffs; sooner after them (nothing to fetch); none of these.
    """
    c, day = F.col, lambda year, month, d: F.make_date(year, F.lit(month), F.lit(d))
    started, no_date = c("rs_start_date") <= run, F.lit(None).cast("date")
    ended = c("playoff_end_date")
    first, early = F.lit(FIRST_DAY).cast("date"), F.month(run) <= 6
    branches = [
        # The plans' names.
        ("init_scrape_within_season", c("rs_end_date").isNull() & early, first, day(F.year(run), 6, 30)),
        ("init_scrape_outside_season", c("rs_end_date").isNull(), first, day(F.year(run) + 1, 6, 30)),
        ("sec_scrape_rs_last_game", started & (run <= c("rs_last_game_date")), c("rs_end_date"), ended),
        (None, started & (run < c("rs_end_date")), no_date, no_date),
        ("sec_scrape_playoff_check_within_rs", c("rs_start_date").isNotNull() & ended.isNull() & F.month(run).between(1, 3) & F.dayofmonth(run).isin(1, 15, 28), c("rs_start_date"), c("rs_end_date")),
        ("sec_scrape_playoffs_after_rs_end", run.between(c("rs_end_date"), ended), c("rs_end_date"), ended),
        ("sec_scrape_after_initial_schedule_release", (run < c("rs_start_date")) & (F.year("ps_start_date") < F.year("rs_start_date")) & ~c("sched_fully_loaded"), c("rs_start_date"), ended),
        (f"sec_scrape_at_least_{GAP_DAYS}_days_after_playoffs_ended", F.datediff(run, ended) >= GAP_DAYS, day(F.year(ended), 9, 1), day(F.year(ended), 10, 15)),
        (f"sec_scrape_within_{GAP_DAYS}_days_after_playoffs", ended.isNotNull(), no_date, no_date),
        ("issue_found", F.lit(True), no_date, no_date),
    ]
    plan = lambda name, start, end: F.struct(start.alias("start_date"), end.alias("end_date"), F.lit(name).cast("string").alias("scrape_plan"))
    pick = plan(*[branches[-1][k] for k in (0, 2, 3)])
    for name, when, start, end in reversed(branches[:-1]):
        pick = F.when(F.coalesce(when, F.lit(False)), plan(name, start, end)).otherwise(pick)
    return seasons.select(*keep, pick.alias("p")).select(*keep, "p.*")


def game_status(events: DataFrame, games: DataFrame, run: Column, current_season: Column) -> DataFrame:
    """game_id, ended, in_play. A game has ended by an end event in its third period or later, or by its season."""
    ends = events.filter("period >= 3").groupBy("game_id").agg(F.max(F.when(F.lower("event_type") == "game-end", 1)).alias("e"))
    g = games.join(ends, "game_id", "left").select("game_id", "game_date", F.coalesce(F.col("e"), F.when(F.col("season") < current_season, 1), F.lit(0)).cast("boolean").alias("ended"))
    return g.withColumn("in_play", ~F.col("ended") & (F.col("game_date") == run)).drop("game_date")


def day_gates(games: DataFrame, run: Column) -> DataFrame:
    """One row: games today, games yesterday, and what to run."""
    count = lambda d: F.count(F.when(F.col("game_date") == d, 1))
    n = games.agg(count(run).alias("today"), count(F.date_sub(run, 1)).alias("yesterday"))
    return n.withColumn("decision", F.when(F.col("yesterday") > 0, "run all").when(F.col("today") > 0, "events only").otherwise("skip"))


def season_ended(seasons: DataFrame, run: Column, days: int = 30) -> DataFrame:
    """One row: whether the latest season's playoffs ended so many days ago. seasons: season, playoff_end."""
    last = seasons.agg(F.max_by("playoff_end", "season").alias("playoff_end"))
    return last.select("playoff_end", (F.datediff(run, F.col("playoff_end")) >= days).alias("season_ended"))


def new_season(schedule: DataFrame, target: DataFrame) -> DataFrame:
    """One row: whether the schedule's latest season isn't the target's. No target: season 19001901."""
    a = schedule.agg(F.max("season").alias("schedule_season"))
    b = target.agg(F.coalesce(F.max("season"), F.lit(19001901)).alias("target_season"))
    return a.crossJoin(F.broadcast(b)).withColumn("new_season", F.col("schedule_season") != F.col("target_season"))  # one row each


def readiness(tables: Sequence[DataFrame], schedule: DataFrame, run: Column, days: int = 2) -> DataFrame:
    """One row: whether any table is empty, or a game lies in the last days."""
    counts = None
    for t in tables:
        one = t.limit(1).agg(F.count(F.lit(1)).alias("n"))
        counts = one if counts is None else counts.unionByName(one)
    games = schedule.agg(F.coalesce(F.bool_or(within_days(F.col("game_date"), run, days)), F.lit(False)).alias("recent_game"))
    return counts.agg((F.min("n") == 0).alias("cold_start")).crossJoin(F.broadcast(games)).withColumn("ready", F.col("cold_start") | F.col("recent_game"))  # one row each


def high_water_scope(source: DataFrame, target: DataFrame, run: Column, date: str = "game_date", days: int = 2, or_touched: Sequence[str] = ()) -> DataFrame:
    """Source rows from the earlier of the target's last date and some days before the run.

    The one date is looked up first, so the scan of the source can leave out files before it. Rows
    of which an `or_touched` date (as when it was inserted) lies in the last days count as well.
    """
    low = target.agg(F.least(F.coalesce(F.max(date), F.lit("1900-01-01").cast("date")), F.date_sub(run, days))).first()[0]
    recent = F.col(date).between(F.lit(low), run)
    return source.filter(recent | touched(run, days, *map(F.col, or_touched)) if or_touched else recent)


def recent_inserts(rows: DataFrame, run: Column, days: int = 2, by: Sequence[str] = ()) -> DataFrame:
    """ready: whether any row, of each `by` if given, was inserted in the last days."""
    recent = within_days(F.to_date("insert_dte"), run, days)
    return rows.groupBy(*by).agg(F.coalesce(F.bool_or(recent), F.lit(False)).alias("ready"))


def schedule_summary(schedule: DataFrame, run: Column, days: int = 365) -> DataFrame:
    """One row: the bounds of the season that the last `days` of the schedule reach, and whether all its regular games are there."""
    recent = schedule.filter(F.col("game_type").between(1, 3) & (F.col("game_date") >= F.date_sub(run, days)))
    last = F.max(F.when(F.col("game_type") == 2, F.col("game_date")))
    return recent.agg(
        F.max("season").cast("int").alias("season"),
        F.max("pre_season_start_date").alias("ps_start_date"),
        F.max("regular_season_start_date").alias("rs_start_date"),
        F.max("regular_season_end_date").alias("rs_end_date"),
        last.alias("rs_last_game_date"),
        F.max("playoff_end_date").alias("playoff_end_date"),
    ).withColumn("sched_fully_loaded", F.col("rs_end_date") >= F.date_sub("rs_last_game_date", 1))


def dates_to_ask(planned: DataFrame, missing: DataFrame, date: str = "d") -> DataFrame:
    """Each date that is planned or missing, once."""
    return planned.select(date).unionByName(missing.select(date)).distinct()
