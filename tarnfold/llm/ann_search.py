"""Approximate nearest neighbours with an adaptive dimension scan of probed lists."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarnfold.llm.common import cut

#: Memory for distances to centroids at a time.
BLOCK_BYTES = 4 << 20


@dataclass
class Index:
    """A rotation and the centroids of the lists, fitted on a bounded sample, and how many lists a query probes."""

    dim: int
    rotation: np.ndarray  # dim x dim, orthogonal
    centroids: np.ndarray  # lists x dim
    probes: int = 1

    def distances(self, x: np.ndarray) -> np.ndarray:
        """Squared distances of rows to centroids: as large as rows x lists, so of a few rows at a time."""
        d = (x**2).sum(axis=1)[:, None] + (self.centroids**2).sum(axis=1) - 2 * x @ self.centroids.T
        return np.maximum(d, 0)

    def some_rows(self, x: np.ndarray) -> Iterator[slice]:
        """Slices of x whose distances take about BLOCK_BYTES."""
        rows = max(1, BLOCK_BYTES // (8 * len(self.centroids)))
        yield from (slice(at, at + rows) for at in range(0, len(x), rows))

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each row's nearest list, and the distance of its centroid."""
        at, away = np.zeros(len(x), np.int64), np.zeros(len(x))
        for rows in self.some_rows(x):
            d = self.distances(x[rows])
            at[rows] = d.argmin(axis=1)
            away[rows] = np.sqrt(d.min(axis=1))
        return at, away


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """vec_id, v (floats as they are, other numbers as doubles), key (a number for each row).

    Without vectors that are null, zero, or hold null or non-finite components.
    """
    floats = vectors.schema[vec_col].dataType == T.ArrayType(T.FloatType()) or vectors.schema[vec_col].dataType == T.ArrayType(T.FloatType(), False)
    v = F.col(vec_col) if floats else F.col(vec_col).cast("array<double>")
    ok = F.col(id_col).isNotNull() & v.isNotNull() & (F.size(v) > 0)
    whole = ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists("v", lambda x: x != 0)
    rows = vectors.filter(ok).select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v")).filter(F.coalesce(whole, F.lit(False)))
    return rows.withColumn("key", F.monotonically_increasing_id())


def stacked(column: pd.Series, dim: int) -> np.ndarray:
    return np.array(column.tolist(), float).reshape(-1, dim)


def probes_for(index: Index, x: np.ndarray, k: int, recall: float, asked: int = 500) -> int:
    """Lists to probe for `recall` of the k nearest rows of x, measured for its first `asked` rows.

    Neighbours in a sample lie farther away than those in the whole table, so the number is rather
    too large than too small.
    """
    lists, at = len(index.centroids), index.nearest(x)[0]
    ranks = []
    for own, q in enumerate(x[:asked]):
        d = ((x - q) ** 2).sum(axis=1)
        d[own] = np.inf
        near = np.argpartition(d, min(k, len(d) - 1))[:k]
        order = np.empty(lists, int)
        order[np.argsort(index.distances(q[None])[0], kind="stable")] = np.arange(lists)
        ranks += order[at[near[near != own]]].tolist()
    return int(np.quantile(ranks, recall, method="higher")) + 1 if ranks else lists


def fit(vectors: DataFrame, rows: int, dim: int, k: int = 10, recall: float = 0.98, sample_rows: int = 20_000, per_list: int = 512, most_lists: int = 4096, seed: int = 5) -> Index:
    """Lists by k-means (Lloyd) on at most `sample_rows` rows, those whose keys have the least hashes: no part of the table is left out.

    One list for each `per_list` rows, at most `most_lists`. The sample and the centroids are all
    that the driver holds; distances are made in blocks of BLOCK_BYTES. The filter keeps back rows
    that cannot be among the least, so no task sorts more than it needs.
    """
    draw = F.pmod(F.xxhash64("key", F.lit(seed)), F.lit(1 << 40))
    sample = vectors.withColumn("_draw", draw).filter(F.col("_draw") < int(min(1.0, 1.2 * sample_rows / max(1, rows)) * (1 << 40))).orderBy("_draw", "key").limit(sample_rows)
    x = np.array([r[0] for r in sample.select("v").collect()], float).reshape(-1, dim)
    rng = np.random.default_rng(seed)
    rotation = np.linalg.qr(rng.normal(size=(dim, dim)))[0]
    n = max(1, min(most_lists, rows // per_list, len(x)))
    if not len(x):
        return Index(dim, rotation, np.zeros((1, dim)))
    centroids = x[rng.choice(len(x), n, replace=False)]
    for _ in range(10):
        at = Index(dim, rotation, centroids).nearest(x)[0]
        sums = np.zeros_like(centroids)
        np.add.at(sums, at, x)
        count = np.bincount(at, minlength=n)
        centroids = np.where(count[:, None] > 0, sums / np.maximum(count, 1)[:, None], centroids)
    index = Index(dim, rotation, centroids)
    index.probes = probes_for(index, x, k, recall)
    return index


def scan_block(index: Index, queries: np.ndarray, bounds: np.ndarray, query_keys: np.ndarray, vectors: np.ndarray, ids: np.ndarray, keys: np.ndarray, k: int, columns: int = 16, doubt: float = 2.1) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k nearest of one block for each query within its bound: (places of queries, of vectors, distances).

    Vectors are rotated and scanned column block by column block. A query brings the distance of
    the k-th best that it knows; where it knows none (infinite), the first vectors of the block give
    a bound by their full distances. After d of D rotated columns, the squared partial distance
    times D / d estimates the whole; a candidate goes when even (1 + doubt / sqrt(d)) times the
    bound cannot hold it. Distances of what remains come from the original vectors in double
    precision.
    """
    dim = index.dim
    rotated, turned = vectors @ index.rotation, queries @ index.rotation
    seeds = min(len(vectors), max(4 * k, 32))
    out_q, out_v, out_d = [], [], []
    for i in range(len(queries)):
        bound = bounds[i] ** 2
        if not np.isfinite(bound):
            first = ((rotated[:seeds] - turned[i]) ** 2).sum(axis=1)[keys[:seeds] != query_keys[i]]
            bound = np.partition(first, k - 1)[k - 1] if len(first) >= k else np.inf
        alive, partial = np.flatnonzero(keys != query_keys[i]), 0.0
        for c in range(0, dim, columns):
            partial = partial + ((rotated[alive, c : c + columns] - turned[i, c : c + columns]) ** 2).sum(axis=1)
            d = min(dim, c + columns)
            if d < dim:
                keep = partial * (dim / d) <= bound * (1 + doubt / np.sqrt(d)) ** 2
            else:
                keep = partial <= bound * (1 + 1e-9) + 1e-12
            alive, partial = alive[keep], partial[keep]
        exact = np.sqrt(((vectors[alive] - queries[i]) ** 2).sum(axis=1))
        order = np.lexsort((ids[alive], exact))[:k]
        out_q.append(np.full(len(order), i))
        out_v.append(alive[order])
        out_d.append(exact[order])
    return np.concatenate(out_q), np.concatenate(out_v), np.concatenate(out_d)


def meet(asked: DataFrame, placed: DataFrame, held: DataFrame, index: Index, k: int, block: int) -> DataFrame:
    """query_key, query_id, vec_id, score: the k best of every block of the lists that queries ask for.

    asked: key, vec_id, v, bound, lists. held: list, n. A list of n rows is dealt by a hash of the
    row's key to blocks of about `block`, and those who ask for it to turns of about `block`, so no
    list is too large for a task; a list that nobody asks for is not moved.
    """
    each = asked.select(F.col("key").alias("query_key"), F.col("vec_id").alias("query_id"), F.col("v").alias("q"), "bound", F.explode("lists").alias("list"))
    pieces = lambda n: F.ceil(n / F.lit(block)).cast("int")
    dealt = each.groupBy("list").agg(F.count(F.lit(1)).alias("_a")).join(F.broadcast(held), "list").select("list", pieces(F.col("n")).alias("parts"), pieces(F.col("_a")).alias("turns"))
    dealt = F.broadcast(cut(dealt))  # a row a list: at most most_lists
    upto = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    left = each.join(dealt, "list").select("query_key", "query_id", "q", "bound", "list", F.pmod(F.xxhash64("query_key"), F.col("turns")).cast("int").alias("turn"), upto(F.col("parts")).alias("part"))
    right = placed.join(dealt, "list").select("list", F.pmod(F.xxhash64("key"), F.col("parts")).cast("int").alias("part"), upto(F.col("turns")).alias("turn"), "vec_id", "key", "v")

    def scan(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if not len(a) or not len(b):
            return pd.DataFrame({"query_key": np.array([], np.int64), "query_id": np.array([], np.int64), "vec_id": np.array([], np.int64), "score": np.array([], float)})
        b = b.sort_values(["vec_id", "key"])
        ids = b["vec_id"].to_numpy()
        i, j, d = scan_block(index, stacked(a["q"], index.dim), a["bound"].to_numpy(), a["query_key"].to_numpy(), stacked(b["v"], index.dim), ids, b["key"].to_numpy(), k)
        return pd.DataFrame({"query_key": a["query_key"].to_numpy()[i], "query_id": a["query_id"].to_numpy()[i], "vec_id": ids[j], "score": d})

    at = ["list", "part", "turn"]
    return left.groupBy(*at).cogroup(right.groupBy(*at)).applyInPandas(scan, "query_key long, query_id long, vec_id long, score double")


def search(vectors: DataFrame, is_query: Callable[[Column], Column], k: int = 10, recall: float = 0.98, block: int = 4096, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """The k nearest other vectors of every query row by Euclidean distance.

    Every usable vector is put into the list of its nearest centroid. A query first scans its
    nearest list (and on until the lists hold more than k vectors), and takes the distance of its
    k-th best from there to the farther lists, of which it probes as many as gave `recall` on the
    sample that the index is fitted on. A list whose centroid is farther away than its radius and
    that distance holds nothing nearer and is left out.

    Defined cases: vectors that are null, zero, or hold null or non-finite components take no part,
    as candidates or queries; nor do vectors of another length than the most frequent one (the
    smaller on a tie); ties go to the smaller vec_id; rows that repeat a vec_id are rows for
    themselves, each a candidate for all others and each a query, if its id is one; fewer than k
    candidates are all returned; an empty table gives an empty result; further columns are dropped.
    Returns query_id, rank, vec_id, score.
    """
    spark = vectors.sparkSession
    good = usable(vectors, id_col, vec_col)
    sizes = good.groupBy(F.size("v").alias("n")).agg(F.count(F.lit(1)).alias("c")).orderBy(F.desc("c"), "n").limit(1).collect()
    if not sizes:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dim, rows = sizes[0]["n"], sizes[0]["c"]
    good = good.filter(F.size("v") == dim)
    index = fit(good, rows, dim, k, recall)
    lists = len(index.centroids)
    element = good.schema["v"].dataType.elementType.simpleString()

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            at, away = index.nearest(stacked(pdf["v"], dim))
            yield pdf.assign(list=at, away=away)

    placed = cut(good.mapInPandas(assign, f"vec_id long, v array<{element}>, key long, list int, away double"))
    held = cut(placed.groupBy("list").agg(F.count(F.lit(1)).alias("n"), F.max("away").alias("radius")))
    counts, radius = np.zeros(lists, int), np.zeros(lists)
    for r in held.collect():  # a row a list: at most most_lists
        counts[r["list"]], radius[r["list"]] = r["n"], r["radius"]

    def probe(home: bool) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
        def chosen(d: np.ndarray, bound: float) -> list[int]:
            near = np.argsort(d, kind="stable")
            enough = int(np.searchsorted(np.cumsum(counts[near]), k + 1)) + 1
            if home:
                near = near[:enough]
            else:
                near = near[enough : max(index.probes, enough)]
                near = near[np.sqrt(d[near]) - radius[near] <= bound * (1 + 1e-9) + 1e-6]
            return near[counts[near] > 0].tolist()

        def lists_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                x = stacked(pdf["v"], dim)
                for rows in index.some_rows(x):
                    some = pdf.iloc[rows]
                    yield some.assign(lists=[chosen(*row) for row in zip(index.distances(x[rows]), some["bound"], strict=True)])

        return lists_of

    asked = placed.filter(is_query(F.col("vec_id"))).select("vec_id", "v", "key")
    shape = f"vec_id long, v array<{element}>, key long, bound double, lists array<int>"
    best = Window.partitionBy("query_key").orderBy("score", "vec_id")
    top = lambda found: found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    near = cut(top(meet(asked.withColumn("bound", F.lit(float("inf"))).mapInPandas(probe(True), shape), placed, held, index, k, block)).drop("rank"))
    bounds = near.groupBy(F.col("query_key").alias("key")).agg(F.when(F.count(F.lit(1)) == k, F.max("score")).alias("bound"))
    knowing = asked.join(bounds, "key", "left").select("vec_id", "v", "key", F.coalesce("bound", F.lit(float("inf"))).alias("bound"))
    far = meet(cut(knowing.mapInPandas(probe(False), shape)), placed, held, index, k, block)
    return top(near.unionByName(far)).select("query_id", "rank", "vec_id", "score")
