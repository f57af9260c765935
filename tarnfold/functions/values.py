"""Scalar expressions for texts, names, dates and seasons. Sessions are expected to run in UTC."""

from __future__ import annotations

from collections.abc import Mapping

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def snake_case(name: str) -> str:
    """camelCase and UPPERWord names in lower case with underscores.

    A capital opens a word after a small letter or digit, and as the last of a row of capitals if
    a small letter follows it.
    """
    out = []
    for before, here, after in zip(" " + name, name, name[1:] + " "):
        opens = here.isupper() and (before.islower() or before.isdigit() or (before.isupper() and after.islower()))
        out.append(f"_{here}" if opens else here)
    return "".join(out).lower()


def snake_columns(df: DataFrame) -> DataFrame:
    names = [snake_case(c) for c in df.columns]
    twice = sorted({n for n in names if names.count(n) > 1})
    if twice:
        raise ValueError(f"columns fall together: {twice}")
    return df.toDF(*names)


def blank_to_null(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


def without_doubled_word(c: Column) -> Column:
    """'Utah Utah Stars' as 'Utah Stars'."""
    return F.regexp_replace(c, r"^(.+?) \1\b", "$1")


def run_date(as_of: Column, zone: str) -> Column:
    """Local calendar date of a UTC instant. The clock is always a parameter."""
    return F.to_date(F.from_utc_timestamp(as_of, zone))


def within_days(c: Column, run: Column, days: int) -> Column:
    """c lies in the `days` before run or on it."""
    return c.between(F.date_sub(run, days), run)


def touched(run: Column, days: int, *dates: Column) -> Column:
    """Any of the dates lies in the window: business, insert or update date."""
    out = F.lit(False)
    for d in dates:
        out = out | F.coalesce(within_days(F.to_date(d), run, days), F.lit(False))
    return out


def first_timestamp(c: Column, *formats: str) -> Column:
    """The first format that fits; null if none does."""
    return F.coalesce(*[F.try_to_timestamp(c, F.lit(f)) for f in formats])


def offset_seconds(c: Column) -> Column:
    """'-05:00' or '+01:30:00' as seconds with their sign."""
    whole = F.regexp_replace(c, r"^([+-]\d{2}:\d{2})$", "$1:00")
    part = lambda i: F.split_part(F.substring(whole, 2, 8), F.lit(":"), F.lit(i)).try_cast("int")
    size = part(1) * 3600 + part(2) * 60 + part(3)
    return F.when(whole.startswith("-"), -size).otherwise(size)


def mmss_seconds(c: Column) -> Column:
    """'mm:ss' as seconds; null if it isn't that."""
    return F.when(c.rlike(r"^\d{1,3}:\d{2}$"), F.split_part(c, F.lit(":"), F.lit(1)).cast("int") * 60 + F.split_part(c, F.lit(":"), F.lit(2)).cast("int"))


def season_of_game(game_id: Column) -> Column:
    """20232024 from a game id that begins with 2023."""
    first = F.substring(game_id.cast("string"), 1, 4).cast("int")
    return first * 10000 + first + 1


def season_of_date(d: Column, first_month: int = 7) -> Column:
    first = F.when(F.month(d) >= first_month, F.year(d)).otherwise(F.year(d) - 1)
    return first * 10000 + first + 1


def game_type(game_id: Column) -> Column:
    return F.substring(game_id.cast("string"), 6, 1).cast("int")


def game_clock(period: Column, elapsed: Column, playoff: Column) -> Column:
    """Seconds since the game began. Regular games have no clock beyond period 5."""
    return (
        F.when(period <= 3, (period - 1) * 1200 + elapsed)
        .when(playoff & (period >= 4), 3600 + (period - 4) * 1200 + elapsed)
        .when(period == 4, 3600 + elapsed)
        .when(period == 5, F.lit(3900))
    )


def position_category(code: Column) -> Column:
    """F, D or G for a position code in either case."""
    c = F.lower(F.trim(code))
    return F.when(c.isin("c", "l", "r"), "F").when(c == "d", "D").when(c == "g", "G")


def completeness(*required: str) -> Column:
    """Share of nulls among the required columns, to two places."""
    nulls = sum((F.col(c).isNull().cast("int") for c in required), F.lit(0))
    return F.round(nulls / len(required), 2)


def emptiness(fields: Mapping[str, object], of: int, absent: int = 0) -> Column:
    """Nulls and placeholders among some fields, and fields that are absent altogether, as a share of `of` fields, decimal(4,2). fields: column to placeholder, or None if it has none."""
    lacks = lambda c, holder: (F.col(c) if holder is None else F.nullif(F.col(c), F.lit(holder))).isNull().cast("int")
    return (sum((lacks(c, h) for c, h in fields.items()), F.lit(absent)) / of).cast("decimal(4,2)")


def previous_on_change(t_value: Column, s_value: Column, t_previous: Column) -> Column:
    """SCD-3: the old value when it changes, else what was there; null where it equals the new one."""
    moved = F.when(t_value.isNotNull() & s_value.isNotNull() & (t_value != s_value), t_value).otherwise(t_previous)
    return F.when(~moved.eqNullSafe(F.coalesce(s_value, t_value)), moved)
