"""Exact duplicates by deterministic block naming."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tarnfold.llm.common import cut, first_row_key, in_small_batches, scratch

#: Naming buckets. A name is a bucket's number and a rank in it, so names need no global sort.
BUCKETS = 1 << 20
#: Groups of more than this share of all rows, fewer than 1000, are joined by broadcast, so that none of them fills a task.
HOT_SHARE = 1000
SPACE = frozenset(b" \t\n\x0b\x0c\r")


def normalised(text: bytes | None) -> bytes:
    r"""Each run of [\x20\x09-\x0D] as one space. bytes.split() knows exactly these six."""
    if not text:
        return b""
    return (b" " if text[0] in SPACE else b"") + b" ".join(text.split()) + (b" " if text[-1] in SPACE and text.strip() else b"")


BLOCKS = "id long, block binary, row array<long>, doc_id array<long>, pos array<int>, n array<int>, sha array<binary>"
#: Blocks of more rows than so many, and than one in HOT_BLOCKS of all, are merged in SALTS groups before they are ranked.
OFTEN, HOT_BLOCKS, SALTS = 64, 1_000_000, 256


def _blocks(block_bytes: int, flush_bytes: int = 32 << 20):
    """A task's equal blocks leave it as one row: its id, the block, and the places that hold it."""
    kinds = [pa.int64(), pa.binary(), *[pa.list_(k) for k in (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary())]]
    names = [c.split()[0] for c in BLOCKS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, held, size = first_row_key(), {}, 0
        row = given = first

        def out() -> pa.RecordBatch:
            columns = [range(given, given + len(held)), held, *[[v[k] for v in held.values()] for k in range(5)]]
            return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names=names)

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                whole = normalised(text.as_py())
                n = max(1, -(-len(whole) // block_bytes))
                for k in range(n):
                    block = whole[k * block_bytes : (k + 1) * block_bytes]
                    places = held.get(block)
                    if places is None:
                        places = held[block] = ([], [], [], [], [])
                        size += len(block) + 64
                    for at, value in enumerate((row, doc_id, k, n, hashlib.sha256(whole).digest() if k == 0 else None)):
                        places[at].append(value)
                    size += 32
                row += 1
                if size > flush_bytes:
                    yield out()
                    given += len(held)
                    held, size = {}, 0
        if held:
            yield out()

    return run


def _named(df: DataFrame, *by: str) -> DataFrame:
    """Adds name: equal values of `by` share one, different values never do."""
    buckets = df.withColumn("bucket", F.pmod(F.xxhash64(*by), F.lit(BUCKETS)))
    rank = F.dense_rank().over(Window.partitionBy("bucket").orderBy(*by))
    return buckets.withColumn("name", F.shiftleft(F.col("bucket"), 40) + rank).drop("bucket")


def _ranked(stored: DataFrame) -> DataFrame:
    """id, name of each stored row, by its block.

    A block that very many tasks hold would bring one ranking partition a row for each of them.
    Such blocks are told by counts of their hashes, of which fewer than HOT_BLOCKS can be so
    frequent, and their rows are first merged in SALTS groups each, by content, so that the ranking
    reads at most SALTS rows of any block but those of few tasks. A hash that different blocks
    share only sends them the same way.
    """
    often = max(OFTEN, stored.count() // HOT_BLOCKS)
    hot = F.broadcast(stored.groupBy("hash").agg(F.count(F.lit(1)).alias("held")).filter(F.col("held") > often).select("hash"))
    rows = stored.select("id", "hash", "block")
    plain = rows.join(hot, "hash", "left_anti").select("block", F.array("id").alias("ids"))
    salt = F.pmod(F.xxhash64("id"), F.lit(SALTS))
    merged = rows.join(hot, "hash", "left_semi").groupBy("block", salt.alias("salt")).agg(F.collect_list("id").alias("ids")).select("block", "ids")
    return _named(plain.unionByName(merged), "block").select("name", F.explode("ids").alias("id"))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = 4096) -> DataFrame:
    r"""Groups of texts that are equal after each run of [\x20\x09-\x0D] becomes one space.

    Texts are cut into blocks of `block_bytes`; sorted distinct blocks get integer names, then
    adjacent pairs of names get names, level by level, until a document has one. Names come from
    comparing contents, never from a hash alone (a hash only deals out the work), so the pair
    (number of blocks, last name) identifies a text without collisions. Blocks that repeat within
    a task are merged before anything is shuffled and reach the ranking as one row without their
    places; rows of blocks that very many tasks hold are merged again on the way (see _ranked).
    Places are joined back by the ids of those rows, which are unique. Pairs are made distinct with
    map-side combining. Groups of more than a thousandth of all rows are joined back by broadcast
    (there are fewer than a thousand). Rows shuffled: the text once, then 8-byte names that halve
    with each level.

    The documents are read once: blocks and places are written to the shared folder, as a table
    that goes when the names are known, so the order in which rows come is of no account.

    Defined cases: null is empty, and all empty texts are one group; repeated rows are rows of their
    own, of which one is kept; of equal texts the smallest doc_id stays (null ids last); an empty
    table gives an empty result; further columns are dropped.
    Returns doc_id, keep_id, group_size, kept, text_sha256, and row, a key of the input row.
    """
    source = in_small_batches(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    with scratch(docs.sparkSession) as store:
        stored = store(source.mapInArrow(_blocks(block_bytes), BLOCKS).withColumn("hash", F.xxhash64("block")))
        places = stored.select("id", "row", "doc_id", "pos", "n", "sha").join(_ranked(stored), "id")
        blocks = cut(places.select("name", F.inline(F.arrays_zip("row", "doc_id", "pos", "n", "sha"))))

    widest = blocks.agg(F.max("n")).first()[0] or 1
    active, done, level = blocks.select("row", "pos", "n", "name"), [], 0
    while (1 << level) < widest:
        done.append(active.filter(F.col("n") <= 1 << level))
        pairs = (
            active.filter(F.col("n") > 1 << level)
            .groupBy("row", "n", F.expr("pos div 2").cast("int").alias("pos"))
            .agg(F.max(F.when(F.col("pos") % 2 == 0, F.col("name"))).alias("a"), F.coalesce(F.max(F.when(F.col("pos") % 2 == 1, F.col("name"))), F.lit(-1)).alias("b"))
        )
        names = _named(pairs.select("a", "b").distinct(), "a", "b")
        active = cut(pairs.join(names, ["a", "b"]).select("row", "pos", "n", "name"))
        level += 1
    done.append(active)
    identity = done[0]
    for x in done[1:]:
        identity = identity.unionByName(x)

    whole = cut(blocks.filter("pos = 0").select("row", "doc_id", "sha").join(identity.select("row", "n", "name"), "row"))
    best = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row"))
    groups = cut(whole.groupBy("n", "name").agg(best.alias("best"), F.count(F.lit(1)).alias("group_size")))
    hot = F.broadcast(groups.filter(F.col("group_size") * HOT_SHARE > whole.count()))
    rest = whole.join(hot, ["n", "name"], "left_anti").join(groups, ["n", "name"])
    return whole.join(hot, ["n", "name"]).unionByName(rest).select(
        "doc_id",
        F.col("best.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("best.row")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
        "row",
    )


#: Names for columns in between, which no table is expected to have.
SOME, SHA, KEPT, KEPT_SHA = (f"__keep_first_{x}" for x in ("some", "sha", "kept", "kept_sha"))
#: Of so many ids at most a broadcast is made.
BROADCAST_IDS = 2_000_000


def without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """docs without the rows of the ids (doc_id, no nulls). Ids are broadcast if they are few enough, else shuffled.

    Rows with a null doc_id stay, all rows of an id go, an empty table gives an empty result.
    """
    few = ids.count() <= BROADCAST_IDS
    return docs.join(F.broadcast(ids) if few else ids, "doc_id", "left_anti").select(docs.columns)


def keep_first(docs: DataFrame, groups: DataFrame | None = None) -> DataFrame:
    """Rows of docs (doc_id, text, further columns), one for each group of equal texts.

    An id all of whose rows are dropped is taken out by id. Rows whose id is null or repeats, some
    of them kept, are told apart by the text's hash as well; of equal rows one stays. A null text is
    an empty one; an empty table gives an empty result; columns may have any names but KEPT's and such.
    """
    groups = cut(exact_groups(docs) if groups is None else groups)
    by_id = groups.groupBy("doc_id").agg(F.max("kept").alias("some"), F.min("kept").alias("every"))
    gone = by_id.filter("doc_id is not null and not some").select("doc_id")
    partly = cut(by_id.filter("doc_id is null or (some and not every)").select("doc_id"))
    if partly.isEmpty():
        return without(docs, gone)
    sha = F.sha2(F.regexp_replace(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+", " "), 256)
    rest = docs.filter("doc_id is not null")
    of_some = docs.join(partly.withColumnRenamed("doc_id", SOME), docs["doc_id"].eqNullSafe(F.col(SOME)), "left_semi").withColumn(SHA, sha)
    kept = groups.filter("kept").select(F.col("doc_id").alias(KEPT), F.col("text_sha256").alias(KEPT_SHA))
    one = of_some.join(kept, F.col("doc_id").eqNullSafe(F.col(KEPT)) & (F.col(SHA) == F.col(KEPT_SHA)), "left_semi").dropDuplicates(["doc_id", SHA])
    return without(without(rest, gone), partly.filter("doc_id is not null")).unionByName(one.drop(SHA))
