"""The Merkle manifest against a tree built in one list."""

from __future__ import annotations

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from tarnfold.llm.manifest import manifest

COLUMNS = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, grp string, rank int, hash string, levels int, item string, node string, place int, _tie int"


def tampers():
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0


def h(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(r, n_chars) -> str:
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (r.doc_id, r.source, r.lang, n_chars, r.text)))


def tree(nodes: list[str]) -> tuple[str, list[list[tuple[str, str]]]]:
    """Root, and for each leaf the hashes before and after its node, level by level."""
    paths, own = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for leaf, i in enumerate(own):
            run = range(i // 2 * 2, min(i // 2 * 2 + 2, len(nodes)))
            paths[leaf].append(("".join(nodes[k] for k in run if k < i), "".join(nodes[k] for k in run if k > i)))
            own[leaf] = i // 2
        nodes = [h(*nodes[i : i + 2]) for i in range(0, len(nodes), 2)]
    return nodes[0], paths


def brute(rows) -> list[tuple]:
    by: dict = {}
    for r in rows:
        by.setdefault(r.lang, []).append(r)
    langs = sorted(by, key=lambda x: (x is not None, (x or "").encode()))
    for lang in langs:
        by[lang].sort(key=lambda r: (r.doc_id is not None, r.doc_id or 0, leaf_of(r, r.n_chars)))
    trees = {lang: tree([leaf_of(r, r.n_chars) for r in by[lang]]) for lang in langs}
    root, above = tree([trees[lang][0] for lang in langs])
    out = []
    for lang, up in zip(langs, above, strict=True):
        for r, path in zip(by[lang], trees[lang][1], strict=True):
            off = r.doc_id is not None and r.n_chars is not None and zlib.crc32(str(r.doc_id).encode()) % 7 == 0
            folded = leaf_of(r, r.n_chars + 1 if off else r.n_chars)
            for before, after in path + up:
                folded = h(before, folded, after)
            out.append((r.doc_id, leaf_of(r, r.n_chars), trees[lang][0], root, h(*(a + b for a, b in path + up)), folded, folded == root))
    return out


def in_order(rows) -> list[tuple]:
    return sorted(tuple("" if x is None else str(x) for x in r) for r in rows)


def held(docs, bits: int) -> list:
    got = manifest(docs, tampers(), bits).select(*COLUMNS).collect()
    assert in_order(got) == in_order(brute(docs.collect()))
    return got


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, lang, s, n, *["x", 1, "x", 1, "x", "x", 1, 1]) for i, t, lang, s, n in rows], SCHEMA).repartition(3)


@pytest.mark.parametrize("bits", [1, 3])
def test_a_tree_of_several_tiers_is_that_of_one_list(spark, bits):
    rows = [(i, f"text {i} é" * (i % 5), "en", f"s{i % 3}", i) for i in range(45)]  # a hot language, of several tiers
    rows += [(100 + i, "x" * 1000, "de", "s", 5) for i in range(7)] + [(200 + i, "y", None, None, None) for i in range(4)] + [(300, "alone", "fr", "s", 5)]
    rows += [(None, "no id", "en", "s", 5), (None, None, None, None, None), (400, "", "", "", 0)]
    rows += [(7, "text 7 again", "en", "s", 1)] * 3 + [(500, "z" * 100_000, "ü", "s", 9), (501, "a", "zz", "s", 1), (502, "a", "Z", "s", 1)]
    got = held(docs_of(spark, rows), bits)
    assert {r.verified for r in got} == {True, False} and len({r.root for r in got}) == 1


def test_a_lone_document_is_its_own_root_and_none_gives_none(spark):
    (r,) = held(docs_of(spark, [(1, "only", "en", "s", 4)]), 8)
    assert r.leaf == r.subroot == r.root == r.folded_root and r.proof_sha256 == h("")
    assert manifest(docs_of(spark, []), tampers()).count() == 0


def test_fields_cannot_run_into_each_other(spark):
    rows = [(1, "b", "en", "a", 1), (1, "b", "en", "a:", 1), (1, "1:b", "en", "a", None), (1, None, "en", "-", 1), (1, "-", "en", None, 1)]
    assert len({r.leaf for r in held(docs_of(spark, rows), 2)}) == len(rows)


def test_a_path_has_a_step_for_each_level(spark):
    got = manifest(docs_of(spark, [(i, "t", "en" if i < 9 else "fr", "s", 1) for i in range(11)])).collect()
    assert {(r.lang, len(r.path)) for r in got} == {("en", 5), ("fr", 2)} and all(r.verified for r in got)
    assert sorted(r["rank"] for r in got if r.lang == "en") == list(range(9))
