"""Whitening against numpy in one process, and the refinement on spectra with clusters."""

from __future__ import annotations

import numpy as np
import pytest

from tarnfold.llm.whitening import LONG, covariance, refined, whiten, _matrix

SCHEMA = "vec_id long, embedding array<float>, x string, v string, d int, n int, component int"


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if e is None else float(e) for e in v], "x", "x", 1, 1, 1) for i, v in rows], SCHEMA).repartition(3)


def some(n: int = 300, dim: int = 20, seed: int = 1) -> list[tuple]:
    rng = np.random.default_rng(seed)
    scale = 3.0 ** -(np.arange(dim) // 3)
    rows = [(i, (rng.normal(size=dim) * scale).astype(np.float32)) for i in range(n)]
    rows += [(1000 + i, rows[3][1]) for i in range(200)] + [(3, rows[3][1]), (None, rows[5][1])]  # a hot vector, repeats
    bad = [None, [], [None] * dim, [float("nan")] + [0.0] * (dim - 1), [float("inf")] * dim, [-float("inf")] + [1.0] * (dim - 1), [1e30] * dim, [1.0] * (dim - 1), [1.0] * (dim + 1)]
    return rows + [(2000 + i, v) for i, v in enumerate(bad)]


def plain(rows, components=16):
    good = [(i, np.floor(64 * np.asarray(v, float)).astype(int) + 1_000_000) for i, v in rows if i is None or i < 2000]
    x = np.unique(np.stack([v for _, v in good]), axis=0)
    s, n = x.sum(axis=0), len(x)
    z = x - s / n
    values, turn = np.linalg.eigh(z.T @ z / n)
    values, turn = values[::-1], turn[:, ::-1]
    return good, n, s, values, turn


def test_whitened_vectors_are_those_of_numpy(spark):
    rows = some()
    got = whiten(frame(spark, rows)).collect()
    good, n, s, values, turn = plain(rows)
    assert len(got) == 16 * len(good) and {r.n for r in got} == {n} and {r.component for r in got} == set(range(1, 17))
    of = {}
    for r in got:
        of.setdefault((r.vec_id, r.component), []).append(r)
    by_component = {k: [(of[i, k][0].whitened, (x - s / n) @ turn[:, k - 1] / np.sqrt(values[k - 1])) for i, x in good] for k in range(1, 17)}
    for pairs in by_component.values():
        a, b = np.array(pairs).T
        assert np.allclose(a, b * np.sign(a @ b), atol=1e-9)
    for i, x in good:
        assert of[i, 1][0].deviation == int(((n * x - s) ** 2).sum())
    assert all(abs(r.explained - values[r.component - 1] / values.sum()) < 1e-12 for r in got)
    assert len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-9


def test_fewer_dimensions_constant_ones_and_no_vectors(spark):
    rows = [(i, [i % 7, 1.0, (i * i) % 5]) for i in range(40)]
    got = whiten(frame(spark, rows)).collect()
    assert {r.component for r in got} == {1, 2} and got[0].identity_error < 1e-9  # the constant dimension has no component
    assert whiten(frame(spark, [])).count() == 0
    assert whiten(frame(spark, [(1, None), (2, [])])).count() == 0
    assert whiten(frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).count() == 0  # one distinct vector


def test_large_entries_stay_exact(spark):
    rows = [(i, [2.0**50 * (i % 5), 2.0**20 * (i % 3)]) for i in range(30)] + [(50, [1.0, 2.0])]
    got = {r.vec_id: r for r in whiten(frame(spark, rows)).collect()}
    x = {i: [int(64 * e) + 1_000_000 for e in v] for i, v in rows}
    fit = set(map(tuple, x.values()))
    s = [sum(v[k] for v in fit) for k in range(2)]
    for i, v in x.items():
        deviation = sum((len(fit) * e - t) ** 2 for e, t in zip(v, s, strict=True))
        assert got[i].deviation == (deviation if deviation < 2**63 else None) and got[i].n == len(fit)
    some_rows = [(i, [2.0**12 * (i % 5), 2.0**20 * (i % 3)]) for i in range(30)]
    exact = {r.vec_id: r.deviation for r in whiten(frame(spark, some_rows)).collect()}
    x = {i: [int(64 * e) + 1_000_000 for e in v] for i, v in some_rows}
    fit = set(map(tuple, x.values()))
    s = [sum(v[k] for v in fit) for k in range(2)]
    assert exact == {i: sum((len(fit) * e - t) ** 2 for e, t in zip(v, s, strict=True)) for i, v in x.items()}


SPECTRA = {
    "apart": np.linspace(1, 5, 30),
    "clusters": np.r_[1, 1 + 1e-9, 1 + 2e-9, 2, 2 + 1e-7, 3, 3 + 1e-5, 7, 8, 9],
    "at the end of double": np.r_[1, 1 + 1e-13, 1 + 3e-13, 2, 5],
    "equal": np.r_[1, 1, 1, 4, 4, 9.0],
    "wide": 10.0 ** -np.arange(12.0),
    "nothing": np.zeros(5),
    "one": np.ones(1),
}


@pytest.mark.parametrize("name", sorted(SPECTRA))
def test_refinement_gives_eigenvectors_to_double_precision(name):
    true = np.sort(SPECTRA[name])[::-1].astype(LONG)
    q = np.linalg.qr(np.random.default_rng(2).normal(size=(len(true), len(true))))[0].astype(LONG)
    for _ in range(3):
        q = q + q @ ((np.eye(len(true), dtype=LONG) - q.T @ q) / 2)
    a = (q * true) @ q.T
    values, x = refined(a)
    assert np.abs(x.T @ x - np.eye(len(true))).max() < 1e-17
    assert np.abs(a @ x - x * values).max() < 1e-16 and np.abs(values - true).max() < 1e-16
    if name in ("apart", "clusters", "wide"):
        assert np.abs(np.abs((q * x).sum(axis=0)) - 1).max() < 1e-15
    single = np.linalg.eigh(a.astype(np.float32))[1]
    if name == "clusters":  # what the start alone would give: the clusters' vectors mixed
        assert np.abs(np.abs((q[:, ::-1] * single).sum(axis=0)) - 1).max() > 1e-3


def test_matrices_of_many_tasks_are_added_in_a_tree(spark):
    x = np.random.default_rng(3).integers(-1000, 1000, (500, 4))
    df = spark.createDataFrame([(list(map(int, v)),) for v in x], "x array<long>").repartition(70)
    mean, v = covariance(df, lambda column: _matrix(column).astype(float), 4)
    assert np.allclose(mean.astype(float), x.mean(axis=0)) and np.allclose(v.astype(float), np.cov(x.T, bias=True), rtol=1e-14)
