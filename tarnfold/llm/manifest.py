"""A Merkle manifest of the documents: leaves, subroots of languages, a root, and a proof for each row.

The tree is rolled up by grouping: a row's rank in its language is written in binary digits, and the
digits are grouped away one after the other, so a node is a struct that holds its children. A block
of 2^BLOCK_BITS leaves is one nested row; its hash is a leaf of the next tier, whose blocks are
nested the same way, up to one row a language, and the languages are the leaves of a last tree.
Proofs go down again: a block's nested row and the path of its own node meet in one group, nested
transforms hand each child its path, and an explode gives the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnfold.llm.common import cut, in_order

#: Levels of the tree that one nested row holds: 256 leaves, about 100 KB.
BLOCK_BITS = 8


def _part(value: Column) -> Column:
    """'-' of a null, else the value's length in UTF-8 bytes, a colon and the value: fields cannot run into each other."""
    text = value.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def digest(*fields: Column) -> Column:
    return F.sha2(F.concat(*[_part(f) for f in fields]), 256)


def _levels(n: Column) -> Column:
    """Levels above n leaves: the binary digits of n - 1."""
    return F.when(n < 2, 0).otherwise(F.length(F.bin(n - 1)))


def _nested(nodes: DataFrame, bits: int) -> DataFrame:
    """Nodes (grp, rank, levels, hash, item) to blocks (grp, block, levels, node): each digit of the rank is grouped away in turn.

    Blocks are shuffled once: what is grouped by block and more digits lies together already.
    """
    digits = [f"_d{j}" for j in range(bits)]
    at = nodes.select("grp", F.shiftright("rank", bits).alias("block"), "levels", *[F.shiftright("rank", j).bitwiseAND(F.lit(1)).alias(d) for j, d in enumerate(digits)], F.struct("hash", "item").alias("node"))
    at = at.repartition("grp", "block")
    for j, digit in enumerate(digits):
        rest = ["grp", "block", "levels", *digits[j + 1 :]]
        at = at.groupBy(*rest).agg(F.transform(F.array_sort(F.collect_list(F.struct(digit, "node"))), lambda k: k.node).alias("kids"))
        joined = F.sha2(F.array_join(F.transform("kids", lambda k: k.hash), ""), 256)
        at = at.select(*rest, F.struct(F.when(F.col("levels") > j, joined).otherwise(F.col("kids")[0].hash).alias("hash"), "kids").alias("node"))
    return at


def _paths(node: Column, above: Column, levels: Column, level: int) -> Column:
    """Of all leaves under a node of this level: hash, item and path, a step (hashes before, hashes after) for each level that has one."""
    if level == 0:
        return F.array(F.struct(node.hash.alias("hash"), node["item"].alias("item"), above.alias("path")))

    def kid(child: Column, i: Column) -> Column:
        hashes = F.transform(node.kids, lambda k: k.hash)
        step = F.struct(F.array_join(F.slice(hashes, F.lit(1), i), "").alias("before"), F.array_join(F.slice(hashes, i + 2, F.size(hashes)), "").alias("after"))
        own = F.filter(F.array(step), lambda _: levels >= level)  # above the group's top there are no steps
        return _paths(child, F.concat(own, above), levels, level - 1)

    return F.flatten(F.transform(node.kids, kid))


def _tree(nodes: DataFrame, bits: int, most_levels: int) -> tuple[list[DataFrame], DataFrame]:
    """The tiers' nested blocks, from the leaves up, and the top: a row (grp, hash) for each group."""
    tiers, tier = [], nodes
    while True:
        blocks = cut(_nested(tier, bits))
        tiers.append(blocks)
        if most_levels <= bits:
            return tiers, blocks.select("grp", F.col("node.hash").alias("hash"))
        most_levels -= bits
        tier = blocks.select("grp", F.col("block").alias("rank"), F.greatest(F.col("levels") - bits, F.lit(0)).alias("levels"), F.col("node.hash").alias("hash"), F.col("block").alias("item"))


def _spread(tiers: list[DataFrame], tops: DataFrame, bits: int) -> DataFrame:
    """Paths of the leaves. tops: (grp, above, ...), the path above each group's top and what all its leaves carry."""
    carried = [c for c in tops.columns if c not in ("grp", "above")]
    paths = tops.withColumn("block", F.lit(0).cast("long"))
    for k, blocks in reversed(list(enumerate(tiers))):
        one = [F.first(c, ignorenulls=True).alias(c) for c in ("node", "levels", "above", *carried)]  # each is given once
        met = blocks.unionByName(paths, allowMissingColumns=True).groupBy("grp", "block").agg(*one)
        leaf = F.explode(_paths(F.col("node"), F.col("above"), F.col("levels"), bits)).alias("leaf")
        paths = met.select("grp", *carried, leaf)
        if k:
            paths = paths.select("grp", F.col("leaf.item").alias("block"), F.col("leaf.path").alias("above"), *carried)
    return paths


def _fold(leaf: Column, path: Column) -> Column:
    return F.aggregate(path, leaf, lambda acc, step: F.sha2(F.concat(step.before, acc, step.after), 256))


def manifest(docs: DataFrame, tampers: Column | None = None, bits: int = BLOCK_BITS) -> DataFrame:
    """A row for each document: doc_id, lang, rank, leaf, subroot, root, path, proof_sha256, folded_root, verified.

    A leaf is the hash of doc_id, source, lang, n_chars and text. In a language leaves stand by
    doc_id; every two consecutive nodes become the hash of both, the last of an odd number the hash
    of itself, until one is left, the subroot. Subroots, by language, give the root the same way.
    `path` has a step for each level: the hashes before and after the row's own node. Where
    `tampers` holds, n_chars is one more when the proof is checked: folded_root comes from that
    leaf and the original path, verified says whether it is the root.

    Defined cases: null fields count as such and not as empty; null ids come first in their
    language, the null language before others; rows of one id stand by their leaf, so equal rows
    are leaves of their own, side by side; an empty table gives an empty result; further columns
    are dropped. A language may hold any share of the rows.
    """
    fields = lambda n_chars: digest(F.col("doc_id"), F.col("source"), F.col("lang"), n_chars, F.col("text"))
    leaf = fields(F.col("n_chars"))
    false_leaf = leaf if tampers is None else F.when(F.coalesce(tampers, F.lit(False)), fields(F.col("n_chars") + 1)).otherwise(leaf)
    leaves = docs.select("doc_id", F.col("lang").alias("grp"), leaf.alias("hash"), false_leaf.alias("shown"))
    ranked = in_order(leaves, ["grp"], [F.col("doc_id"), F.col("hash")])
    most = ranked.agg(F.max(_levels(F.col("group_rows")))).first()[0] or 0
    nodes = ranked.select("grp", F.col("place").alias("rank"), _levels(F.col("group_rows")).alias("levels"), "hash", F.struct("doc_id", "shown", "place").alias("item"))
    tiers, subroots = _tree(nodes, bits, most)

    langs = in_order(subroots.select(F.lit(0).alias("all"), F.col("grp").alias("lang"), "hash"), ["all"], [F.col("lang")])
    top_levels = max(0, subroots.count() - 1).bit_length()
    lang_nodes = langs.select(F.lit(0).alias("grp"), F.col("place").alias("rank"), F.lit(top_levels).alias("levels"), "hash", F.struct("lang").alias("item"))
    lang_tiers, root = _tree(lang_nodes, bits, top_levels)
    none = F.array().cast("array<struct<before: string, after: string>>")
    down = _spread(lang_tiers, root.select("grp", none.alias("above"), F.col("hash").alias("root")), bits)
    tops = down.select(F.col("leaf.item.lang").alias("grp"), F.col("leaf.path").alias("above"), F.col("leaf.hash").alias("subroot"), "root")

    rows = _spread(tiers, tops, bits).select("grp", "subroot", "root", "leaf.*")
    siblings = F.array_join(F.transform("path", lambda s: F.concat(s.before, s.after)), "")
    out = rows.select(
        F.col("item.doc_id").alias("doc_id"),
        F.col("grp").alias("lang"),
        F.col("item.place").alias("rank"),
        F.col("hash").alias("leaf"),
        "subroot",
        "root",
        "path",
        F.sha2(siblings, 256).alias("proof_sha256"),
        _fold(F.col("item.shown"), F.col("path")).alias("folded_root"),
    )
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
