"""MERGE with ordered clauses over plain snapshots, as one full outer join on the keys."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from tarnfold.functions.compare import any_of
from tarnfold.operators.rows import best_row

#: When a row was made and last changed: the table's own, never a source's.
AUDIT = ("insert_dte", "update_dte")

#: An expression over accessors of the stored row t and the incoming row s.
Expr = Callable[[Callable[[str], Column], Callable[[str], Column]], Column]


@dataclass(frozen=True)
class Update:
    """Sets columns where `when` holds. A column not named keeps its stored value."""

    set: Mapping[str, Expr]
    when: Expr | None = None
    tag: str = "update"


@dataclass(frozen=True)
class Delete:
    when: Expr | None = None
    tag: str = "delete"


@dataclass(frozen=True)
class Insert:
    """A new row. A column not named takes the source's column of that name, or null."""

    values: Mapping[str, Expr] = field(default_factory=dict)
    when: Expr | None = None
    tag: str = "insert"


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that are null in part or occur more than once."""
    missing = F.lit(False)
    for k in keys:
        missing = missing | F.col(k).isNull()
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter((F.col("n_rows") > 1) | missing)


def assert_keys(df: DataFrame, keys: Sequence[str], what: str = "source") -> DataFrame:
    bad = duplicate_keys(df, keys).limit(1).collect()
    if bad:
        raise ValueError(f"{what}: null or repeated key {bad[0].asDict()}")
    return df


@dataclass
class Merged:
    """What a merge gives. `rows` has each row once, with its old and new state and its clause."""

    rows: DataFrame
    untouched: DataFrame | None
    columns: list[str]
    tags: tuple[str, ...] = ()

    def counted(self) -> tuple[Merged, Callable[[], dict[tuple[str, str], int]]]:
        """The same, observed, and what gives the counts by change and clause once one write of it has run: no job of its own."""
        seen = Observation()
        kinds = {"inserted": F.col("_old").isNull(), "deleted": F.col("_new").isNull(), "updated": F.col("_old").isNotNull() & F.col("_new").isNotNull()}
        names = {f"{kind}/{tag}": (kind, tag) for kind in kinds for tag in self.tags}
        columns = [F.count_if(kinds[kind] & (F.col("_tag") == tag)).alias(name) for name, (kind, tag) in names.items()]
        rows = self.rows.observe(seen, *(columns or [F.count(F.lit(1)).alias("all/rows")]))
        return replace(self, rows=rows), lambda: {names[k]: n for k, n in seen.get.items() if n and k in names}

    @property
    def table(self) -> DataFrame:
        new = self.rows.filter("_new is not null").select("_new.*")
        return new if self.untouched is None else new.unionByName(self.untouched)

    @property
    def changes(self) -> DataFrame:
        """Change feed: _change_type insert, update_preimage, update_postimage or delete, and the clause's tag."""
        row = lambda kind, state: F.struct(F.lit(kind).alias("_change_type"), F.col(state).alias("_row"))
        images = (
            F.when(F.col("_old").isNull(), F.array(row("insert", "_new")))
            .when(F.col("_new").isNull(), F.array(row("delete", "_old")))
            .otherwise(F.array(row("update_preimage", "_old"), row("update_postimage", "_new")))
        )
        return self.rows.filter("_tag is not null").select("_tag", F.explode(images).alias("_c")).select("_c._change_type", F.col("_tag").alias("_logic_block"), "_c._row.*")

    @property
    def metrics(self) -> DataFrame:
        kind = F.when(F.col("_old").isNull(), "inserted").when(F.col("_new").isNull(), "deleted").otherwise("updated")
        return self.rows.filter("_tag is not null").groupBy(kind.alias("change"), F.col("_tag").alias("logic_block")).agg(F.count(F.lit(1)).alias("n_rows"))


def apply_changes(state: DataFrame, feed: DataFrame, keys: Sequence[str], order: str = "_order") -> DataFrame:
    """A table after the commits of its change feed, in their order: of each key the last image counts, a delete removes it.

    Keys are unique in the table and not null. Applying a feed to what it is applied to already
    changes nothing. The result has the table's columns; a feed's further ones are left out.
    """
    after = feed.filter(F.col("_change_type") != "update_preimage")
    last = best_row(after, keys, F.col(order).desc())
    kept = last.filter(F.col("_change_type") != "delete").select(*state.columns)
    return state.join(last.select(*keys), list(keys), "left_anti").select(*state.columns).unionByName(kept)


def apply_to_sums(state: DataFrame, feed: DataFrame, groups: Sequence[str], sums: Mapping[str, Column], rows: str = "n_rows") -> DataFrame:
    """A table of counts and sums by group after the commits of a feed: what images after bring is added, what images before had is taken off.

    `sums` names the state's columns and what a row of the feed adds to them; `rows` is the state's
    number of rows, and a group without rows goes. Only groups that the feed touches change, and
    the order of commits does not matter.
    """
    sign = F.when(F.col("_change_type").isin("insert", "update_postimage"), 1).otherwise(-1)
    part = lambda v: F.coalesce(F.sum(sign * v), F.lit(0))
    by = feed.groupBy(*groups).agg(F.sum(sign).alias(rows), *[part(v).alias(c) for c, v in sums.items()])
    names = [rows, *sums]
    both = state.select(*groups, *names).unionByName(by.select(*groups, *[F.col(c).cast(state.schema[c].dataType).alias(c) for c in names]))
    return both.groupBy(*groups).agg(*[F.sum(c).cast(state.schema[c].dataType).alias(c) for c in names]).filter(F.col(rows) > 0)


#: A key filter has two to this power of bits: 4 MB.
FILTER_BITS = 25


def _bit_of(df: DataFrame, keys: Mapping[str, object], bits: int) -> Column:
    """The bit of a row's key, from 1. Values are hashed in the target's types, in which equal keys are equal."""
    return F.pmod(F.xxhash64(*[F.col(k).try_cast(kind) for k, kind in keys.items()]), F.lit(1 << bits)) + 1


def may_match(df: DataFrame, source: DataFrame, keys: Sequence[str], bits: int = FILTER_BITS) -> DataFrame:
    """Rows of df but those whose key is surely none of source's: df is not shuffled.

    The source's keys set bits of a map of 2^bits bits, which is broadcast: its size has that bound
    however many keys there are. Rows whose bit is unset go. With many more keys than a tenth of the
    bits most rows stay, and the join that follows is as large as it would be without.
    """
    types = {k: df.schema[k].dataType for k in keys}
    at = lambda d: _bit_of(d, types, bits)
    maps = source.select(at(source).alias("_at")).groupBy(F.bitmap_bucket_number("_at").alias("_bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("_at")).alias("_map"))
    own = df.withColumn("_at", at(df)).withColumns({"_own": F.bitmap_bucket_number("_at"), "_bit": F.bitmap_bit_position("_at").cast("int")})
    byte = F.ascii(F.decode(F.substring(F.col("_map"), F.floor(F.col("_bit") / 8).cast("int") + 1, F.lit(1)), "ISO-8859-1"))
    is_set = F.getbit(byte.cast("int"), F.col("_bit") % 8) == 1
    return own.join(F.broadcast(maps), (F.col("_own") == F.col("_bucket")) & is_set, "left_semi").select(*df.columns)


def merge(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    matched: Sequence[Update | Delete] = (),
    not_matched: Sequence[Insert] = (),
    not_matched_by_source: Sequence[Update | Delete] = (),
    scope: Callable[[Callable[[str], Column]], Column] | None = None,
    check_source: bool = True,
) -> Merged:
    """The target after the first clause that holds for each row; other rows stay as they are.

    scope limits updates and deletes to part of the target: only that part is joined, the rest goes
    through without a shuffle, and a source row whose key lies in the rest is not inserted again. To
    find those rows the rest is read for its keys and tested by a key filter of the source (see
    may_match); only the few that pass are shuffled. If the scope tells by the key alone, as a day
    that is part of it, source rows in the scope have no such key and the filter holds the others
    only. The filter reads the source once more, or those rows of it. A source row whose key is null in part, or another row's as
    well, fails the query; rows of the target with such keys stay as they are. The check is a count
    in the partitions and order that the join needs anyway, so the source is read once. The result
    has the target's columns and types.
    """
    whole = F.lit(True)
    for k in keys:
        whole = whole & F.col(k).isNotNull()
    given, given_columns = source, source.columns
    given_row = F.struct(*given_columns)
    if check_source:
        at = F.to_json(F.struct(*keys), {"ignoreNullFields": "false"})
        checked = F.when((F.col("_n") == 1) & whole, given_row).otherwise(F.raise_error(F.concat(F.lit("merge source: null or repeated key "), at)))
        source = source.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(*keys))).select(*keys, checked.alias("_src"))
    else:
        source = source.select(*keys, given_row.alias("_src"))
    columns, untouched = target.columns, None
    inside = target
    if scope is not None:
        hit = F.coalesce(scope(F.col), F.lit(False))
        inside, untouched = target.filter(hit), target.filter(~hit)
        asked: set[str] = set()
        scope(lambda c: asked.add(c) or F.col(c))
        outside = given.filter(~hit) if asked <= set(keys) else given
        source = source.join(may_match(untouched.select(*keys), outside.select(*keys), keys), list(keys), "left_anti")
    joined = inside.select(*keys, F.struct(*columns).alias("_old")).join(source, list(keys), "full_outer")

    t, s = (lambda c: F.col(f"_old.{c}")), (lambda c: F.col(f"_src.{c}"))
    types = {f.name: f.dataType for f in target.schema}
    there, come = F.col("_old").isNotNull(), F.col("_src").isNotNull()

    tag, new = F.lit(None).cast("string"), F.col("_old")
    clauses = [(there & come, c) for c in matched] + [(~there, c) for c in not_matched] + [(there & ~come, c) for c in not_matched_by_source]
    for condition, clause in reversed(clauses):  # the last one tried wraps last, so the first wins
        holds = condition if clause.when is None else condition & F.coalesce(clause.when(t, s), F.lit(False))
        if isinstance(clause, Delete):
            state = F.lit(None).cast(joined.schema["_old"].dataType)
        elif isinstance(clause, Insert):
            own = {c: clause.values[c](t, s) if c in clause.values else s(c) if c in given_columns else F.lit(None) for c in columns}
            state = F.struct(*[own[c].cast(types[c]).alias(c) for c in columns])
        else:
            state = F.struct(*[(clause.set[c](t, s) if c in clause.set else t(c)).cast(types[c]).alias(c) for c in columns])
        tag, new = F.when(holds, F.lit(clause.tag)).otherwise(tag), F.when(holds, state).otherwise(new)
    return Merged(joined.select("_old", new.alias("_new"), tag.alias("_tag")), untouched, columns, tuple(dict.fromkeys(c.tag for _, c in clauses)))


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    differs: Callable[[Callable[[str], Column], Callable[[str], Column]], Mapping[str, Column]],
    now: Column,
    scope: Callable[[Callable[[str], Column]], Column] | None = None,
    made: Mapping[str, Expr] | None = None,
    changed: Mapping[str, Expr] | None = None,
    new_when: Expr | None = None,
) -> Merged:
    """Stored rows of which one of the `differs` conditions holds take the source's columns; other source rows are new.

    `made` and `changed` set further columns, or the same in another way, of new and of changed rows.
    Only source rows of which `new_when` holds are inserted.
    """
    attrs = [c for c in target.columns if c in source.columns and c not in (*keys, *AUDIT)]
    new: dict[str, Expr] = {c: (lambda t, s, c=c: s(c)) for c in attrs}
    new |= {"update_dte": lambda t, s: now, **(changed or {})}
    update = Update(new, lambda t, s: any_of(differs(t, s)))
    return merge(target, source.select(*keys, *attrs), keys, [update], [Insert({"insert_dte": lambda t, s: now, **(made or {})}, new_when)], scope=scope)


def insert_only(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Appends source rows whose key the target lacks: one anti join, the target isn't shuffled into a join."""
    return target.unionByName(source.join(target.select(*keys), list(keys), "left_anti").select(*target.columns))


def delete_arrived(target: DataFrame, arrived: DataFrame, keys: Sequence[str]) -> DataFrame:
    return target.join(arrived.select(*keys), list(keys), "left_anti")


def update_where(df: DataFrame, when: Column, values: Mapping[str, Column]) -> DataFrame:
    """Sets columns where a predicate holds (null: no)."""
    holds = F.coalesce(when, F.lit(False))
    return df.withColumns({c: F.when(holds, v).otherwise(F.col(c)) for c, v in values.items()})


def stamped(df: DataFrame, now: Column, source: str) -> DataFrame:
    """Audit columns of new rows."""
    return df.withColumns({"insert_dte": now, "update_dte": F.lit(None).cast("timestamp"), "py_source": F.lit(source)})


def ledger_upsert(ledger: DataFrame, attempts: DataFrame, keys: Sequence[str], run: Column, days: int = 15, only_if_due: bool = True) -> Merged:
    """Retry ledger after attempts: count one more, today's date, the next one `days` on.

    With only_if_due an attempt counts if its row is due, and so once a day at most.
    """
    due = lambda t, s: t("next_retry_dte") <= run
    return merge(
        ledger,
        attempts,
        keys,
        matched=[
            Update(
                {"attempt_count": lambda t, s: t("attempt_count") + 1, "last_attempt_dte": lambda t, s: run, "next_retry_dte": lambda t, s: F.date_add(run, days)},
                when=due if only_if_due else None,
                tag="retry",
            )
        ],
        not_matched=[Insert({"attempt_count": lambda t, s: F.lit(1), "last_attempt_dte": lambda t, s: run, "next_retry_dte": lambda t, s: F.date_add(run, days)})],
    )
