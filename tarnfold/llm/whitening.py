"""Whitening of embeddings: eigenvectors in single precision, refined to double by matrix products.

Sums and covariances are gathered by Spark over distinct vectors; what reaches the driver is a few
matrices of dimension x dimension. There the eigenvectors of the covariance in float32 are corrected
by Ogita-Aishima steps in a longer precision; eigenvalues that lie too close for the step are taken
together and told apart by a solve inside the space they span.
"""

from __future__ import annotations

import io
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnfold.llm.common import cut

#: Precision of the refinement: 64 bits of mantissa on x86, double where the platform has no more.
LONG = np.longdouble
#: 64 * entry has to be below this, or the whole number does not fit.
LARGEST = 2.0**62
#: Rows that a task multiplies at a time.
ROWS = 1024
#: Partial matrices that one task adds up.
FAN_IN = 8


def refined(a: np.ndarray, x: np.ndarray | None = None, steps: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (falling) and orthonormal eigenvectors (columns) of the symmetric a, in LONG.

    Starts from the float32 eigenvectors. Each step measures the defects r = I - x'x and
    s = x'ax, corrects x to x + xe with e_ij = (s_ij + l_j r_ij) / (l_j - l_i), or r_ij / 2 where the
    gap is below what the defects let one see, and so doubles the number of right digits. After a
    step, values of which neighbours lie below that gap form a cluster: its vectors span the right
    space but are mixed, so the small matrix x_c' (a - m I) x_c, whose entries are of the size of the
    differences, is solved and turns them. Equal values stay together; any basis of theirs is right.
    """
    a = a.astype(LONG)
    size = float(np.abs(a).max()) or 1.0
    a = a / size
    if x is None:
        x = np.linalg.eigh(a.astype(np.float32))[1]
    x = x.astype(LONG)
    one, eps = np.eye(len(a), dtype=LONG), float(np.finfo(LONG).eps)
    norm = float(np.linalg.norm(a.astype(float)))
    for _ in range(steps):
        values, r, s = _defects(a, x)
        gap = 2 * (float(np.linalg.norm((s - np.diag(values)).astype(float))) + norm * float(np.linalg.norm(r.astype(float))))
        between = values[None, :] - values[:, None]
        far = np.abs(between) > gap
        e = np.where(far, (s + values[None, :] * r) / np.where(far, between, 1), r / 2)
        x = x + x @ e
        for c in _clusters(values, gap):
            x[:, c] = x[:, c] @ _inside(a, x[:, c], one)
        if float(np.abs(e).max()) < 64 * eps:
            break
    values, r, _ = _defects(a, x)
    x = x + x @ (r / 2)
    order = np.argsort(-values, kind="stable")
    return values[order] * size, x[:, order]


def _defects(a: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    r = np.eye(len(a), dtype=LONG) - x.T @ x
    s = x.T @ (a @ x)
    s = (s + s.T) / 2
    return np.diag(s) / (1 - np.diag(r)), r, s


def _clusters(values: np.ndarray, gap: float) -> Iterator[np.ndarray]:
    """Places of two or more values of which each lies within gap of the next."""
    order = np.argsort(values, kind="stable")
    for run in np.split(order, np.nonzero(np.diff(values[order]) > gap)[0] + 1):
        if len(run) > 1:
            yield run


def _inside(a: np.ndarray, x: np.ndarray, one: np.ndarray) -> np.ndarray:
    """The turn of the basis x of a cluster that makes x'ax diagonal."""
    middle = np.trace(x.T @ (a @ x)) / x.shape[1]
    small = x.T @ ((a - middle * one) @ x)
    scale = float(np.abs(small).max())
    if scale == 0:
        return np.eye(x.shape[1], dtype=LONG)
    return np.linalg.eigh(((small + small.T) / 2 / scale).astype(float))[1].astype(LONG)


def _packed(*arrays: np.ndarray) -> bytes:
    """Arrays of LONG as pairs of doubles."""
    out = io.BytesIO()
    np.savez(out, *[np.stack([hi := v.astype(float), (v - hi).astype(float)]) for v in arrays])
    return out.getvalue()


def _unpacked(blob: bytes) -> list[np.ndarray]:
    with np.load(io.BytesIO(blob)) as z:
        return [z[k][0].astype(LONG) + z[k][1].astype(LONG) for k in z.files]


def _met(p: list[np.ndarray], q: list[np.ndarray]) -> list[np.ndarray]:
    """(count, mean, centred products) of two sets of rows together."""
    n = p[0] + q[0]
    if n == 0:
        return p
    d = q[1] - p[1]
    return [n, p[1] + d * (q[0] / n), p[2] + q[2] + np.outer(d, d) * (p[0] * q[0] / n)]


def covariance(rows: DataFrame, vectors: Callable[[pa.Array], np.ndarray], dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Mean and covariance (divisor n) of what `vectors` makes of the column x; rows are centred before they are multiplied.

    Each task gives one matrix; they are added eight at a time, so no task and not the driver holds
    more than eight.
    """

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [np.zeros(1, LONG), np.zeros(dim, LONG), np.zeros((dim, dim), LONG)]
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                z = vectors(batch.column(0).slice(at, ROWS))
                mean = z.mean(axis=0)
                own = z - mean
                total = _met(total, [np.array([len(z)], LONG), mean.astype(LONG), (own.T @ own).astype(LONG)])
        if total[0] > 0:
            yield pa.RecordBatch.from_pydict({"m": [_packed(*total)]})

    def met(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        total = None
        for blob in frame.sort_values("nth")["m"]:
            total = _unpacked(blob) if total is None else _met(total, _unpacked(blob))
        return pd.DataFrame({"nth": [key[0]], "m": [_packed(*total)]})

    parts = cut(rows.select("x").mapInArrow(partial, "m binary").select(F.spark_partition_id().cast("long").alias("nth"), "m"))
    left = parts.agg(F.max("nth")).first()[0]
    while left is not None and left >= FAN_IN:
        parts = cut(parts.groupBy(F.floor(F.col("nth") / FAN_IN).alias("nth_of")).applyInPandas(met, "nth long, m binary"))
        left //= FAN_IN
    total = [np.zeros(1, LONG), np.zeros(dim, LONG), np.zeros((dim, dim), LONG)]
    for row in sorted(parts.collect()):  # FAN_IN matrices at most
        total = _met(total, _unpacked(row["m"]))
    n = max(total[0][0], LONG(1))
    return total[1], total[2] / n


def _matrix(column: pa.Array) -> np.ndarray:
    """The vectors of a column of equally long lists, as rows."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def _usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """Rows (vec_id, x): entries as whole numbers. Rows that hold null, infinite or too large entries go, empty ones, and those of other lengths than the most common."""
    v = F.col(vector_col)
    good = v.isNotNull() & F.forall(v, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e.cast("double") * 64) < LARGEST)) & (F.size(v) > 0)
    rows = vectors.select(F.col(id_col).alias("vec_id"), v.alias("v")).filter(F.coalesce(good, F.lit(False)))
    lengths = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    rows = rows.filter(F.size("v") == (lengths["d"] if lengths else 0))
    return rows.select("vec_id", F.transform("v", lambda e: F.floor(e.cast("double") * 64) + F.lit(1_000_000).cast("long")).alias("x"))


def _sums(fit: DataFrame) -> tuple[int, list[int]]:
    """Number of vectors and exact sum of each dimension, whatever the size."""

    def halves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(0))
            d = x.shape[1]
            yield pa.RecordBatch.from_pydict({"d": np.arange(d), "n": np.full(d, len(x)), "high": (x >> 31).sum(axis=0), "low": (x & (2**31 - 1)).sum(axis=0)})

    each = fit.select("x").mapInArrow(halves, "d long, n long, high long, low long").groupBy("d")
    exact = lambda c: F.sum(F.col(c).cast("decimal(38,0)")).alias(c)
    rows = each.agg(F.sum("n").alias("n"), exact("high"), exact("low")).orderBy("d").collect()  # a row for each dimension
    return (rows[0]["n"], [(int(r["high"]) << 31) + int(r["low"]) for r in rows]) if rows else (0, [])


def whiten(vectors: DataFrame, components: int = 16, id_col: str = "vec_id", vector_col: str = "embedding", least: float = 1e-12) -> DataFrame:
    """Rows (vec_id, component, n, deviation, whitened, explained, identity_error), a row for each vector and component.

    An entry c becomes x = floor(64 c) + 1000000; covariances are over the n distinct x-vectors.
    `whitened` is x minus their mean, on the component's unit eigenvector, over the root of its
    eigenvalue; `deviation` the sum over dimensions of (n x - S)^2; `explained` the eigenvalue's share
    of the trace; `identity_error` the largest entry of the whitened vectors' covariance minus the
    identity, measured over all of them.

    Defined cases: rows whose vector is null, empty, or has an entry that is null, not finite or
    beyond 2^56 go, as do vectors of another length than the most common (of equally common ones
    the longest); repeated rows and ids are rows like others; null ids stay; a component whose
    eigenvalue is below `least` times the greatest is no component, so one distinct vector gives no
    rows, and an empty table none; a deviation beyond 2^63 - 1 is null; further columns are dropped.
    The driver holds a few dim x dim matrices (dim is up to a few thousand).
    """
    spark = vectors.sparkSession
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    usable = _usable(vectors, id_col, vector_col)
    fit = cut(usable.select("x").distinct())
    n, sums = _sums(fit)
    if not n:
        return spark.createDataFrame([], schema)
    dim = len(sums)
    base = np.array([s // n for s in sums], dtype=np.int64)
    rest = np.array([(s % n) / n for s in sums])  # mean = base + rest

    def centred(column: pa.Array) -> np.ndarray:
        return (_matrix(column) - base).astype(float) - rest

    _, v = covariance(fit, centred, dim)
    values, turn = refined(v)
    kept = [k for k in range(min(components, dim)) if values[k] > max(0.0, least * float(values[0]))]
    to_white = (turn[:, kept] / np.sqrt(values[kept])).astype(float)
    explained = [float(values[k] / np.trace(v)) for k in kept]
    if not kept:
        return spark.createDataFrame([], schema)
    _, white = covariance(fit, lambda column: centred(column) @ to_white, len(kept))
    error = float(np.abs(white - np.eye(len(kept))).max())
    shift = np.array([s % n for s in sums], dtype=object)

    def deviations(x: np.ndarray) -> list[int | None]:
        y = x - base
        if n * (float(np.abs(y).max(initial=0)) + 1) * dim**0.5 < 2.0**31:
            d = y * n - shift.astype(np.int64)
            return (d * d).sum(axis=1).tolist()
        wide = y.astype(object) * int(n) - shift
        return [s if s < 2**63 else None for s in (wide * wide).sum(axis=1)]

    def out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(kept)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                m, x = part.num_rows, part.column(1)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(pa.array(np.repeat(np.arange(m), k))).cast(pa.int64()),
                        pa.array(np.tile(np.arange(1, k + 1), m), pa.int32()),
                        pa.array(np.full(m * k, n), pa.int64()),
                        pa.array(deviations(_matrix(x)), pa.int64()).take(pa.array(np.repeat(np.arange(m), k))),
                        pa.array((centred(x) @ to_white).ravel(), pa.float64()),
                        pa.array(np.tile(explained, m), pa.float64()),
                        pa.array(np.full(m * k, error), pa.float64()),
                    ],
                    names=[c.split()[0] for c in schema.split(", ")],
                )

    return usable.mapInArrow(out, schema)
