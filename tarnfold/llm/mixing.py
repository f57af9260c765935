"""Mixing sources to target weights by Sainte-Laguë apportionment (native: DataFrame expressions only).

Targets come from the sources' weights, capped; blocks of equal tokens are given to sources by the
highest quotients votes / (2 j + 1), shard by shard; a source's blocks are then taken in the seeded
order of its documents, round and round. What a document gives is told from its place in that order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnfold.llm.common import cut, in_order, join_groups

WORD = r"[^\x20\x09-\x0D]+"


def targets(sources: DataFrame, weights: Sequence[int], share: float, most: float) -> DataFrame:
    """Sources (source, source_size, ...) with `nth` (place by code point, null last), `weight` and `target`.

    The targets sum to `share` of all sizes, split by weight; none exceeds `most` times its source's
    size, and what lies above goes to the others by weight. The level that all uncapped targets
    share, level * weight, is the greatest of (total - caps before) / (weights left) in the order in
    which sources reach their caps, so one pass over that order finds it.
    """
    named = in_order(sources.withColumn("_all", F.lit(0)), ["_all"], [F.col("source").asc_nulls_last()]).withColumnRenamed("place", "nth").drop("group_rows")
    named = named.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("nth") % len(weights) + 1).cast("int")).cast("long"))
    capped = in_order(named, ["_all"], [F.col("source_size") / F.col("weight"), F.col("nth")], sums=["source_size", "weight"]).drop("place", "group_rows")
    sums = named.agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(0))).first()
    level = (F.lit(share * sums[0]) - most * F.col("source_size_before")) / (F.lit(sums[1]) - F.col("weight_before"))
    top = capped.agg(F.max(level)).first()[0] or 0.0
    return capped.drop("_all", "source_size_before", "weight_before").withColumn("target", F.least(F.col("weight") * F.lit(top), F.col("source_size") * F.lit(float(most))))


def seats(votes: DataFrame, total: int, houses: int) -> DataFrame:
    """Sainte-Laguë: seats of each (nth, votes, most) in the houses of total * h / houses seats, h = 1 to `houses`, as (nth, house, seats).

    A house of n seats takes the n highest quotients votes / (2 j + 1), of equal ones those of the
    smaller nth; `most` limits a party's seats. A divisor that is surely too large gives each party
    its seats but for a few, one that is small enough limits the quotients left to rank, so about as
    many are ranked as there are parties, and not as there are seats.
    """
    parties, sum_votes = votes.agg(F.count(F.lit(1)), F.coalesce(F.sum("votes"), F.lit(0.0))).first()
    by_house = votes.withColumn("house", F.explode(F.sequence(F.lit(1), F.lit(houses)))).withColumn("n", F.floor(F.lit(total) * F.col("house") / F.lit(houses)))
    at = lambda divisor: F.least(F.floor(F.col("votes") / divisor + 0.5), F.col("most"))
    left = F.col("n") - parties / 2 - 1
    sure = F.when((left > 0) & (F.col("votes") > 0), at(F.lit(sum_votes) / left)).otherwise(F.lit(0))
    small = F.lit(sum_votes) / (F.col("n") + parties / 2 + 1)
    shrink = 1.0
    while True:  # seats that are limited go to others, at a smaller divisor
        enough = F.when(F.col("votes") > 0, at(small * shrink)).otherwise(F.lit(0))
        house = by_house.groupBy("house", "n").agg(F.sum(enough).alias("given"), F.sum("most").alias("room"))
        if house.filter("given < least(n, room)").isEmpty():
            break
        shrink *= 0.9
    based = cut(by_house.withColumns({"sure": sure, "enough": F.greatest(sure, enough)}))
    open_seats = based.filter("enough > sure").select("house", "nth", "votes", F.explode(F.sequence(F.col("sure"), F.col("enough") - 1)).alias("j"))
    ranked = in_order(open_seats.withColumn("quotient", F.col("votes") / (2 * F.col("j") + 1)), ["house"], [F.col("quotient").desc(), F.col("nth"), F.col("j")])
    left_over = based.groupBy("house").agg((F.max("n") - F.sum("sure")).alias("left_over"))
    won = ranked.join(left_over, "house").filter("place < left_over").groupBy("house", "nth").agg(F.count(F.lit(1)).alias("won"))
    return based.join(won, ["house", "nth"], "left").select("nth", F.col("house"), (F.col("sure") + F.coalesce("won", F.lit(0))).alias("seats"))


def _pieces() -> Column:
    """What shards take of the document at [size_before, size_before + size) of its source's words.

    `marks` are the words that the source has given when each shard is full. The source's words are
    gone through again and again; a document comes once in each round.
    """
    rounds = F.sequence(F.lit(0), F.floor(F.element_at("marks", -1) / F.greatest("source_size", F.lit(1))).cast("int"))

    def one(turn: Column) -> Column:
        begin = turn * F.col("source_size") + F.col("size_before")

        def shard(mark: Column, k: Column) -> Column:
            since = F.when(k == 0, F.lit(0)).otherwise(F.element_at("marks", F.greatest(k, F.lit(1))))
            start, end = F.greatest(since, begin), F.least(mark, begin + F.col("size"))
            return F.struct(k.alias("shard"), (start - begin).alias("start"), (end - begin).alias("end"))

        return F.filter(F.transform("marks", shard), lambda p: p.end > p.start)

    return F.flatten(F.transform(rounds, one))


def mix(
    docs: DataFrame,
    weights: Sequence[int] = (5, 2, 1),
    share: float = 1.5,
    most: int = 2,
    shards: int = 8,
    block_words: int = 32,
    seed: int = 1,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """What a mix by weighted sources takes of each document.

    Returns doc_id, source, size (words), source_size, target (its source's words in the mix), quota
    (blocks of its source), pieces (shard, start, end: the words that a shard takes, a word twice if
    it is in two pieces) and taken (their sum). A source's words, in the order of a seeded hash of
    its documents, are cut into equal blocks of at most `block_words` words; its votes are its target
    in such blocks, and all shards together have as many blocks as votes. The first shards hold the
    highest quotients, so the mix is apportioned at the end of every shard. Blocks are taken in
    order, from the beginning again when all are taken: whole documents but for the two at a quota's
    ends, each word at most `most` times, and rounds differ by one at most. A source's words in the
    mix are its target but for about half a block.

    Defined cases: a null text has no words and gives none; a null source is a source of its own,
    the last; sources without words have target 0; null ids and repeated rows are rows like others
    (equal ones stand side by side); a table without words or rows takes nothing; further columns
    are dropped. Runs with the same seed agree.
    """
    words = F.coalesce(F.regexp_count(text_col, F.lit(WORD)), F.lit(0)).cast("long")
    shuffled = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col(id_col).cast("string"), F.lit("-"))))
    sized = in_order(
        docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), words.alias("size"), shuffled.alias("_order")),
        ["source"],
        [F.col("_order"), F.col("size")],
        sums=["size"],
    ).drop("place", "_order")
    sized = cut(sized)
    sources = cut(targets(cut(sized.groupBy("source").agg(F.sum("size").alias("source_size"))), weights, share, most))
    blocks = F.ceil(F.col("source_size") / block_words)
    votes = cut(sources.withColumn("blocks", blocks).withColumn("votes", F.coalesce(F.try_divide(F.col("target") * F.col("blocks"), F.col("source_size")), F.lit(0.0))).withColumn("most", F.col("blocks") * most))
    millionths = votes.agg(F.coalesce(F.sum(F.floor(F.col("votes") * 1_000_000)), F.lit(0))).first()[0]
    quotas = seats(votes.select("nth", "votes", "most"), (millionths + 500_000) // 1_000_000, shards)
    # words given at the end of each shard: whole rounds, and blocks of the round begun
    full, rest = F.floor(F.col("seats") / F.col("blocks")), F.col("seats") % F.col("blocks")
    mark = F.when(F.col("blocks") > 0, full * F.col("source_size") + F.floor(rest * F.col("source_size") / F.col("blocks"))).otherwise(F.lit(0))
    marks = (
        quotas.join(votes.drop("votes", "most"), "nth")
        .groupBy("nth")
        .agg(
            F.first("source").alias("source"), F.first("source_size").alias("source_size"), F.first("target").alias("target"), F.max("seats").alias("quota"),
            F.transform(F.array_sort(F.collect_list(F.struct("house", mark.alias("mark")))), lambda m: m.mark).alias("marks"),
        )
    )
    return (
        join_groups(sized, cut(marks), "source")
        .withColumn("pieces", _pieces())
        .withColumn("taken", F.aggregate("pieces", F.lit(0).cast("long"), lambda n, p: n + p.end - p.start))
        .select("doc_id", "source", "size", "source_size", "target", "quota", "pieces", "taken")
    )
