"""JSON payloads into typed columns."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarnfold.functions.values import snake_case
from tarnfold.sources.schemas import infer

#: A target column: its type alone, or source field, type and text treatment.
Rule = str | Mapping[str, object]


def parsed(df: DataFrame, schema: str | T.DataType, payload: str = "payload", name: str = "json") -> DataFrame:
    return df.withColumn(name, F.from_json(F.col(payload), schema))


def unpack_list(df: DataFrame, field: str = "data", schema: str | None = None, keep: Sequence[str] = (), outer: bool = False, payload: str = "payload") -> DataFrame:
    """One row for each element of a payload's list, with the element's fields as columns.

    The payloads' schema is inferred over all rows unless given. outer keeps rows without elements.
    """
    schema = schema or infer(df, payload)
    explode = F.explode_outer if outer else F.explode
    return parsed(df, schema, payload).select(*keep, explode(F.col(f"json.{field}")).alias("_e")).select(*keep, "_e.*")


def flatten(df: DataFrame, prefix: bool = True) -> DataFrame:
    """All structs as columns and all arrays as rows, by the schema alone: no data are looked at.

    Arrays of one level that stand side by side would multiply, so more than one is an error;
    shred each by itself. Without prefix a name that comes twice is an error.
    """
    while True:
        arrays = [f.name for f in df.schema if isinstance(f.dataType, T.ArrayType)]
        structs = [f for f in df.schema if isinstance(f.dataType, T.StructType)]
        if structs:
            columns: list[Column] = []
            for f in df.schema:
                if isinstance(f.dataType, T.StructType):
                    columns += [F.col(f"`{f.name}`.`{c}`").alias(f"{f.name}_{c}" if prefix else c) for c in f.dataType.fieldNames()]
                else:
                    columns.append(F.col(f"`{f.name}`"))
            df = df.select(*columns)
            twice = sorted({c for c in df.columns if df.columns.count(c) > 1})
            if twice:
                raise ValueError(f"columns fall together: {twice}")
        elif len(arrays) > 1:
            raise ValueError(f"arrays side by side: {arrays}")
        elif arrays:
            df = df.withColumn(arrays[0], F.explode_outer(arrays[0]))
        else:
            return df


def child_tables(df: DataFrame, keys: Sequence[str], name: str = "rows", prefix: bool = True) -> dict[str, DataFrame]:
    """A table for the rows and one for each array in them, however deep, by the schema alone.

    Each table has the keys, the positions of the arrays on the way to it (`plays_pos`, from 0), and
    its element's values with structs as columns (`details_zone`; without prefix `zone`). A child is
    made by exploding its own way only, so arrays side by side never multiply, and keys and positions
    join it to its parent. Elements that are no structs have the column `value`. Null and empty
    arrays give no rows. Tables are named by the way to them: rows, plays, plays_officials. Columns
    that fall together are an error.
    """
    out: dict[str, DataFrame] = {}

    def visit(table: str, rows: DataFrame, ids: list[str]) -> None:
        values: list[Column] = []
        arrays: list[tuple[str, Column, T.ArrayType]] = []

        def walk(at: Column, kind: T.StructType, way: str) -> None:
            for f in kind:
                c, full = at.getField(f.name), f"{way}_{f.name}" if way else f.name
                if isinstance(f.dataType, T.StructType):
                    walk(c, f.dataType, full)
                elif isinstance(f.dataType, T.ArrayType):
                    arrays.append((full, c, f.dataType))
                else:
                    values.append(c.alias(full if prefix else f.name))

        walk(F.col("_e"), rows.schema["_e"].dataType, "")
        made = rows.select(*ids, *values)
        twice = sorted({c for c in made.columns if made.columns.count(c) > 1})
        if twice:
            raise ValueError(f"columns fall together in {table}: {twice}")
        out[table] = made
        for way, c, kind in arrays:
            child = way if table == name else f"{table}_{way}"
            if child in out:
                raise ValueError(f"two tables are named {child}")
            inner = rows.select(*ids, F.posexplode(c).alias(f"{way}_pos", "_e"))
            if not isinstance(kind.elementType, T.StructType):
                inner = inner.withColumn("_e", F.struct(F.col("_e").alias("value")))
            visit(child, inner, [*ids, f"{way}_pos"])

    visit(name, df.select(*keys, F.struct(*[c for c in df.columns if c not in keys]).alias("_e")), list(keys))
    return out


def map_to_wide(df: DataFrame, maps: str, keep: Sequence[str] = (), most: int = 2000) -> DataFrame:
    """A column for each key that occurs in a column of array<map<string,string>>, in the keys' order; more than `most` are an error."""
    rows = df.select(*keep, F.explode(maps).alias("_m"))
    keys = [r[0] for r in rows.select(F.explode(F.map_keys("_m")).alias("k")).distinct().orderBy("k").limit(most + 1).collect()]
    if len(keys) > most:
        raise ValueError(f"more than {most} keys of {maps}: they are data, no columns")
    return rows.select(*keep, *[F.try_element_at("_m", F.lit(k)).alias(k) for k in keys])


def first_of(m: Column, *keys: str) -> Column:
    """The first value that isn't null among keys of a map."""
    return F.coalesce(*[F.try_element_at(m, F.lit(k)) for k in keys])


def expand(df: DataFrame, struct: str, renamed: Mapping[str, str] | None = None) -> DataFrame:
    """A struct's fields in its place, some by another name."""
    fields = [F.col(f"{struct}.{f.name}").alias((renamed or {}).get(f.name, f.name)) for f in df.schema[struct].dataType]
    return df.select(*[c for c in df.columns if c != struct], *fields)


def sides(df: DataFrame, away: str, home: str) -> DataFrame:
    """Two rows for each row: its away and its home struct, tagged home_road, in a single pass."""
    tagged = [F.struct(F.lit(tag).alias("home_road"), F.col(c).alias("side")) for tag, c in (("AWAY", away), ("HOME", home))]
    rest = [c for c in df.columns if c not in (away, home)]
    return df.select(*rest, F.explode(F.array(*tagged)).alias("_s")).select(*rest, "_s.home_road", "_s.side.*")


def joined_lists(df: DataFrame, keep: Sequence[str], *lists: str) -> DataFrame:
    """Rows of several lists of one element type, such as players by position."""
    return df.select(*keep, F.explode(whole_list(df, *lists)).alias("_e")).select(*keep, "_e.*")


def whole_list(df: DataFrame, *lists: str) -> Column:
    """Several lists as one; null ones are empty."""
    return F.concat(*[F.coalesce(F.col(c), F.array().cast(df.schema[c].dataType)) for c in lists])


def once_each(df: DataFrame, array: str, key: Callable[[Column], Column], part: Callable[[Column], Column] | None = None) -> DataFrame:
    """Each row's array with one element of each key, the first, within the row: nothing is shuffled.

    Keys are compared as they are, null being a value like others. `part` gives a value, cheap to make,
    that equal keys have in common (else the key itself): arrays in which no such value comes twice
    stay as they are, and of the others only the keys of elements that share theirs are made and sorted.
    """
    part = part or key
    df = df.withColumn("_at", F.transform(array, lambda x: F.xxhash64(part(x))))
    by_hash = F.sort_array(F.transform("_at", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    df = df.withColumn("_at", F.when(F.size(F.array_distinct("_at")) < F.size(array), by_hash))
    alike = lambda a, b: F.coalesce(F.get(a, b - 1)["h"] == F.get(a, b)["h"], F.lit(False))
    shared = lambda i: alike("_at", i) | alike("_at", i + 1)
    placed = F.sort_array(F.transform(F.filter("_at", lambda x, i: shared(i)), lambda x: F.struct(key(F.get(array, x["i"])).alias("k"), x["i"].alias("i"))))
    df = df.withColumn("_keys", placed)
    first = F.filter("_keys", lambda x, i: (i == 0) | ~x["k"].eqNullSafe(F.get("_keys", i - 1)["k"]))
    index = lambda found: F.transform(found, lambda x: x["i"])
    chosen = F.transform(F.concat(index(F.filter("_at", lambda x, i: ~shared(i))), index(first)), lambda i: F.get(array, i))
    return df.withColumn(array, F.when(F.col("_at").isNull(), F.col(array)).otherwise(chosen)).drop("_at", "_keys")


def each_element(df: DataFrame, array: Column, keep: Sequence[str] = ()) -> DataFrame:
    """A row `_e` for each element of an array that is dear to make.

    For a plain explode Spark adds a filter of the array's size, in which the array is made again,
    and once more for each use within it; for an outer one it adds none, and the rows of arrays
    without elements go by their place.
    """
    return df.select(*keep, F.posexplode_outer(array).alias("_pos", "_e")).filter("_pos is not null").drop("_pos")


def targets(rules: Mapping[str, Rule]) -> dict[str, str]:
    """Name and type of each column that the rules make."""
    out = {}
    for source, rule in rules.items():
        rule = {"type": rule} if isinstance(rule, str) else rule
        out[str(rule.get("target", snake_case(source.rpartition(".")[2])))] = str(rule["type"])
    return out


def build_fields(df: DataFrame, rules: Mapping[str, Rule]) -> list[Column]:
    """Typed target columns. A source field that is missing is a typed null.

    A rule is {source: type}, or {source: {target, type, lower, upper, trim}}; text treatment goes
    lower, upper, trim, then the cast, which gives null for what doesn't fit.
    """
    return element_fields(F.col, df.schema, rules)


def element_fields(at: Callable[[str], Column], schema: T.StructType, rules: Mapping[str, Rule]) -> list[Column]:
    """build_fields of what `at` gives for a path of the schema, such as an array's element."""
    out = []
    for (source, rule), (target, kind) in zip(rules.items(), targets(rules).items(), strict=True):
        rule = {} if isinstance(rule, str) else rule
        if _kind(schema, source) is None:
            out.append(F.lit(None).cast(kind).alias(target))
            continue
        c = at(source)
        for name, f in (("lower", F.lower), ("upper", F.upper), ("trim", F.trim)):
            if rule.get(name):
                c = f(c)
        # a text that surely is no number is not cast: a cast that fails is an exception, and dear
        number = INTEGER.get(kind) if _kind(schema, source) == "string" else None
        cast = c.try_cast(kind)
        out.append((F.when(c.rlike(number), cast) if number else cast).alias(target))
    return out


#: What every text is like that Spark casts to a whole number; not all such texts are one.
INTEGER = dict.fromkeys(("tinyint", "smallint", "int", "bigint"), r"^[\x00-\x20\x7F]*[+-]?[0-9.]+[\x00-\x20\x7F]*$")


def field_of(element: Column) -> Callable[[str], Column]:
    """An element's value for a path."""

    def at(path: str) -> Column:
        c = element
        for part in path.split("."):
            c = c.getField(part)
        return c

    return at


def _kind(schema: T.StructType, path: str) -> str | None:
    """The type of a path's field, None if it is not there."""
    kind: T.DataType = schema
    for part in path.split("."):
        if not isinstance(kind, T.StructType) or part not in kind.fieldNames():
            return None
        kind = kind[part].dataType
    return kind.simpleString()


def apply_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The schema's columns in its order, cast. Nulls in required columns are the table writer's to refuse."""
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


def unused_fields(schema: T.StructType, used: Sequence[str]) -> list[str]:
    """Paths of the fields that no used path names, or lies in, in the schema's order."""
    out: list[str] = []

    def walk(kind: T.StructType, at: str) -> None:
        for f in kind:
            path = f"{at}{f.name}"
            inner = f.dataType.elementType if isinstance(f.dataType, T.ArrayType) else f.dataType
            if path in used:
                continue
            if isinstance(inner, T.StructType) and any(u.startswith(f"{path}.") for u in used):
                walk(inner, f"{path}.")
            else:
                out.append(path)

    walk(schema, "")
    return out


def with_unused(df: DataFrame, schema: T.StructType, used: Sequence[str]) -> DataFrame:
    names = unused_fields(schema, used)
    return df.withColumns({"unused_fields": F.lit(" | ".join(names)), "unused_count": F.lit(len(names))})


def harvest_ids(payload: Column, field: str) -> Column:
    """All values of a numeric field anywhere in a JSON text, without parsing it."""
    found = F.regexp_extract_all(payload, F.lit(rf'"{field}"\s*:\s*([0-9]+)'), F.lit(1))
    return F.transform(found, lambda x: x.cast("bigint"))


def total_of(payload: Column, path: str = "$.total") -> Column:
    return F.coalesce(F.get_json_object(payload, path).try_cast("int"), F.lit(0))


def valid_payloads(df: DataFrame, list_name: str = "data") -> DataFrame:
    """Status 200, an object with elements in its list. What can't be parsed counts as empty."""
    n = F.size(F.from_json(F.col("payload"), f"struct<{list_name}: array<string>, total: int>").getField(list_name))
    return df.filter((F.col("http_status") == 200) & F.coalesce(n > 0, F.lit(False)))
