"""Change predicates between a stored value t and an incoming value s."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def null_safe(t: Column, s: Column) -> Column:
    """Differs, null being a value like others."""
    return ~t.eqNullSafe(s)


def unless_source_null(t: Column, s: Column, default: object) -> Column:
    """Differs, but a null source means no change."""
    d = F.lit(default)
    return F.coalesce(t, d) != F.coalesce(s, t, d)


def null_as(t: Column, s: Column, default: object) -> Column:
    """Differs, null being the default."""
    return F.coalesce(t, F.lit(default)) != F.coalesce(s, F.lit(default))


def plain(t: Column, s: Column) -> Column:
    """Differs; unknown, and so no change, if either is null."""
    return F.coalesce(t != s, F.lit(False))


def skip_null(t: Column, s: Column) -> Column:
    """Differs; a null source is no change, and a null target unknown."""
    return F.coalesce(t != F.coalesce(s, t), F.lit(False))


def as_text(t: Column, s: Column) -> Column:
    """Differs by more than case and outer blanks."""
    return ~F.lower(F.trim(t)).eqNullSafe(F.lower(F.trim(s)))


def unless_sentinel(t: Column, s: Column, sentinel: object) -> Column:
    """Differs, and the source isn't the placeholder value."""
    return ~t.eqNullSafe(s) & F.coalesce(s != F.lit(sentinel), F.lit(True))


def failed_conditions(conditions: Mapping[str, Column]) -> Column:
    """Names of the conditions that hold, joined by a comma, in their order; null if none does."""
    names = F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in conditions.items()]))
    return F.when(F.size(names) > 0, F.concat_ws(", ", names))


def any_of(conditions: Mapping[str, Column]) -> Column:
    out = F.lit(False)
    for c in conditions.values():
        out = out | F.coalesce(c, F.lit(False))
    return out
