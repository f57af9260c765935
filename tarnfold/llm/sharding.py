"""Size-balanced sharding by sampled splitters (native: DataFrame expressions only)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarnfold.llm.common import cut

LEAST = -(2**63)
#: The order of rows: equal texts are neighbours, then by id; the last number only makes the order whole.
ORDER = ("key", "ord", "tie")


def _place() -> Column:
    return F.struct(*ORDER)


def _range_of(splits: list[tuple[int, int, int]], place: Column) -> Column:
    """Number of splitters at or below place, by a coarse and then a fine look-up."""
    if not splits:
        return F.lit(0)
    step = max(1, int(len(splits) ** 0.5))
    literal = lambda rows: F.array(*[F.struct(*[F.lit(x).cast("long").alias(c) for c, x in zip(ORDER, r, strict=True)]) for r in rows])
    coarse = splits[step - 1 :: step]
    blocks = F.size(F.filter(literal(coarse), lambda s: s <= place)) if coarse else F.lit(0)
    fine = F.slice(literal(splits), blocks * step + 1, F.lit(step))
    return blocks * step + F.size(F.filter(fine, lambda s: s <= place))


def _parts(ranged: DataFrame, rows_of: dict[int, int], most_rows: int, draws: int) -> DataFrame:
    """ranged with `part`: ranges of more than `most_rows` rows are subdivided at quantiles of a second sample."""
    pieces = {r: -(-n // most_rows) for r, n in rows_of.items() if n > most_rows}
    if not pieces:
        return ranged.withColumn("part", F.lit(0))
    wanted = F.broadcast(ranged.sparkSession.createDataFrame([(r, n, n * draws / rows_of[r]) for r, n in pieces.items()], "range int, pieces int, chance double"))
    unit = F.pmod(F.xxhash64("ord", "key", "tie", F.lit(11)), F.lit(1 << 30)) / float(1 << 30)
    by_place = Window.partitionBy("range").orderBy(*ORDER)
    cuts = (
        ranged.join(wanted, "range")
        .filter(unit < F.col("chance"))
        .select("range", *ORDER, F.row_number().over(by_place).alias("nth"))
        .filter(F.col("nth") % draws == 0)
        .groupBy("range")
        .agg(F.sort_array(F.collect_list(_place())).alias("cuts"))  # a place for each `most_rows` rows
    )
    below = F.size(F.filter("cuts", lambda c: c <= _place()))
    return ranged.join(F.broadcast(cuts), "range", "left").withColumn("part", F.when(F.col("cuts").isNull(), 0).otherwise(below)).drop("cuts")


def shard_by_bytes(
    docs: DataFrame,
    shards: int = 40,
    id_col: str = "doc_id",
    text_col: str = "text",
    overhead: int = 16,
    ranges_per_shard: int = 8,
    draws_per_range: int = 32,
    keep_share: float = 0.1,
    part_rows: int = 1_000_000,
) -> DataFrame:
    """Put every row into one of `shards` contiguous key ranges of nearly equal bytes.

    Rows are ordered by (hash of the text, id), so equal texts are neighbours. A size-weighted
    sample of keys (about shards * ranges_per_shard * draws_per_range draws, whatever the
    input's size) gives quantile splitters; rows are partitioned by them, ranges of more than
    `part_rows` rows are subdivided by a second sample, and each part is summed and ordered by
    itself. A shard ends at the exact byte position, so splitters decide what a task does and never
    the result. A group of equal texts stays in one shard if it is no larger than `keep_share` of a
    shard, on however many parts it lies; larger groups are split by id. No group fills a task.

    Defined cases: a null text has `overhead` bytes and checksum 0, as an empty one; null ids come
    first; repeated rows are separate rows; fewer rows than shards leave shards empty; an empty
    table gives an empty result; further columns are dropped.
    Returns doc_id, size, text_crc32, law ('bytes'), shard, slot, grown_shard (null).
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    keyed = cut(
        docs.select(
            F.col(id_col).alias("doc_id"),
            (F.octet_length(text) + overhead).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("crc"),
            F.xxhash64(text).alias("key"),
            F.coalesce(F.col(id_col).cast("long"), F.lit(LEAST)).alias("ord"),
            F.monotonically_increasing_id().alias("tie"),
        )
    )
    total = keyed.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    share = max(1.0, total / shards)
    ranges = shards * ranges_per_shard
    step = max(1.0, total / (ranges * draws_per_range))

    # one draw per `step` bytes on average, by a hash of the row: repeatable, and proportional to size
    unit = F.pmod(F.xxhash64("ord", "key", F.lit(7)), F.lit(1 << 20)) / float(1 << 20)
    drawn = keyed.withColumn("draws", F.floor(F.col("size") / step + unit)).filter("draws > 0")
    by_place = Window.orderBy(*ORDER).rowsBetween(Window.unboundedPreceding, 0)
    splits = (
        drawn.select(*ORDER, F.sum("draws").over(by_place).alias("upto"))
        .groupBy(F.floor((F.col("upto") - 1) / draws_per_range).alias("cell"))
        .agg(F.min(_place()).alias("s"))
        .filter("cell > 0")
        .select("s.*")
        .orderBy(*ORDER)
    )
    bounds = [tuple(r) for r in splits.collect()]  # fewer than `ranges` and a few, at any size
    ranged = keyed.withColumn("range", _range_of(bounds, _place()))
    rows_of = {r["range"]: r["count"] for r in ranged.groupBy("range").count().collect()}
    ranged = _parts(ranged, rows_of, part_rows, draws_per_range)

    # what lies before each part: a row for each `part_rows` rows
    at = ["range", "part"]
    before = Window.orderBy(*at).rowsBetween(Window.unboundedPreceding, -1)
    starts = cut(
        ranged.groupBy(*at)
        .agg(F.sum("size").alias("part_bytes"), F.count(F.lit(1)).alias("r"), F.max("key").alias("last_key"), F.min("key").alias("first_key"))
        .select("*", F.coalesce(F.sum("part_bytes").over(before), F.lit(0)).alias("bytes_before"), F.coalesce(F.sum("r").over(before), F.lit(0)).alias("rows_before"), F.lag("last_key").over(Window.orderBy(*at)).alias("key_before"))
    )
    # groups that lie on several parts: at most one for each part
    spread = starts.filter("key_before = first_key").select(F.col("first_key").alias("key")).distinct()
    on_parts = ranged.join(F.broadcast(spread), "key").groupBy("key", *at).agg(F.sum("size").alias("b")).join(F.broadcast(starts), at)
    wide = on_parts.groupBy("key").agg(F.sum("b").alias("wide_bytes"), F.min(F.struct(*at, (F.col("bytes_before") + F.col("part_bytes") - F.col("b")).alias("from")))["from"].alias("wide_start"))

    inside = Window.partitionBy(*at).orderBy(*ORDER).rowsBetween(Window.unboundedPreceding, 0)
    same = Window.partitionBy(*at, "key")
    whole, start = F.coalesce("wide_bytes", "group_bytes"), F.coalesce("wide_start", "group_start")
    placed = (
        ranged.withColumns({"run": F.sum("size").over(inside), "nth": F.row_number().over(inside)})
        .withColumns({"group_bytes": F.sum("size").over(same), "group_start": F.min(F.col("run") - F.col("size")).over(same)})
        .join(F.broadcast(starts.select(*at, "bytes_before", "rows_before")), at)
        .withColumn("group_start", F.col("bytes_before") + F.col("group_start"))
        .join(F.broadcast(wide), "key", "left")
        .withColumn("middle", F.when(whole <= share * keep_share, start + whole / 2).otherwise(F.col("bytes_before") + F.col("run") - F.col("size") / 2))
        .select(
            "doc_id", "size", "crc",
            F.least(F.floor(F.col("middle") * shards / F.lit(max(1, total))), F.lit(shards - 1)).cast("int").alias("shard"),
            (F.col("rows_before") + F.col("nth") - 1).cast("long").alias("at"),
        )
    )
    placed = cut(placed)
    first = placed.groupBy("shard").agg(F.min("at").alias("first_at"))
    return placed.join(F.broadcast(first), "shard").select(
        "doc_id",
        "size",
        F.col("crc").alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("at") - F.col("first_at")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
