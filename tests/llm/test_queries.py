"""The registered queries on the smallest tables: their columns, their SQL, and the pipeline."""

from __future__ import annotations

from collections import Counter, defaultdict

import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from tarnfold.llm import queries
from tests.compare import same
from tests.llm.test_operators import SCHEMA, norm, shingles, texts

COLUMNS = {
    "op1_": ["doc_id:bigint", "size:bigint", "text_crc32:bigint", "law:string", "shard:int", "slot:bigint", "grown_shard:int"],
    "op2_": ["doc_id:bigint", "held_out:boolean", "lang_pred:string", "score:double"],
    "op3_": ["query_id:bigint", "rank:int", "vec_id:bigint", "score:double"],
    "op4_": ["conv_id:bigint", "n_turns:bigint", "turns_sha256:string", "loss_chars:bigint", "loss_sha256:string", "formatted_chars:bigint"],
    "op5_": ["doc_id:bigint", "keep_id:bigint", "group_size:bigint", "kept:boolean", "text_sha256:string"],
    "op6_": ["doc_id:bigint", "n_ids:bigint"],
    "op7_": ["page_id:bigint", "url:string", "text:string", "n_chars:bigint"],
    "op8_": ["doc_id:bigint", "held_out:boolean", "n_tokens:bigint", "n_known:bigint", "train_tokens:bigint", "base_score:double", "score:double"],
    "op9_": ["doc_id:bigint", "n_shingles:bigint", "component_id:bigint", "kept:boolean"],
    "op10_": ["doc_id:bigint", "start:bigint", "length:bigint", "ids_crc32:bigint", "doc_tokens:bigint", "sequence_id:bigint", "offset:bigint"],
    "op11_": ["vec_id:bigint", "component:int", "n:bigint", "deviation:bigint", "whitened:double", "explained:double", "identity_error:double"],
    "op12_": ["doc_id:bigint", "size:bigint", "source_size:bigint", "target:double", "taken:bigint"],
    "op13_": ["doc_id:bigint", "leaf:string", "subroot:string", "root:string", "proof_sha256:string", "folded_root:string", "verified:boolean"],
}


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_columns_and_rows(spark, sf_dir, name):
    df = queries.QUERIES[name](spark, sf_dir)
    want = next(v for k, v in COLUMNS.items() if name.startswith(k))
    assert [f"{n}:{t}" for n, t in df.dtypes][: len(want)] == want
    assert df.count() >= 1


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_matches_sql(spark, duck, sf_dir, name):
    same(queries.QUERIES[name](spark, sf_dir).toPandas(), duck.execute(queries.ORACLE_SQL[name]).df())


def test_pipeline_matches_brute_force(spark, tmp_path):
    rows = [(i, t) for i, t in texts() if i is not None]
    docs = spark.createDataFrame([(i, t, "en", *["x"] * (len(SCHEMA) - 3)) for i, t in rows], SCHEMA)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    # language: nothing but texts without a letter goes, since one language cannot be ambiguous
    kept = [(i, t) for i, t in rows if t and any(c.isalpha() for c in t)]
    groups = defaultdict(list)
    for i, t in kept:
        groups[norm(t)].append((i, t))
    kept = sorted(min(g) for g in groups.values())
    sets = [(i, t, shingles(t, 5)) for i, t in kept]
    top = {i: i for i, _, _ in sets}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for a, (i, _, s) in enumerate(sets):
        for j, _, u in sets[:a]:
            if 100 * len(s & u) >= 80 * len(s | u):
                x, y = find(i), find(j)
                top[max(x, y)] = min(x, y)
    kept = [(i, t) for i, t, _ in sets if find(i) == i]
    tokenizer = Tokenizer.from_file(queries.tokenizer_path())
    want = Counter((i, len(tokenizer.encode(t, add_special_tokens=False).ids) + 1) for i, t in kept)
    got = defaultdict(list)
    for r in corpus_pipeline.run(spark, str(tmp_path)).collect():
        got[(r.doc_id, r.doc_tokens)].append((r.start, r.length))
    assert set(got) == set(want)
    assert all(sum(n for _, n in parts) == tokens for (_, tokens), parts in got.items())


def test_pipeline_of_ambiguous_texts_and_of_none(spark, tmp_path):
    import random

    rng = random.Random(5)
    pick = lambda words, n: " ".join(rng.choice(words.split()) for _ in range(n))
    en, fr = "the thing that they think of when the other one has gone there", "le jour que nous avons dans la maison ou il etait une fois"
    clean = [(k, pick(line, n), lang) for k, (line, lang, n) in enumerate([(en, "en", 60), (fr, "fr", 60), (en, "en", 4), (fr, "fr", 4)] * 6)]
    # from mostly French to mostly English: some of them lie between the two
    mixed = [(300 + k, " ".join(pick(en if rng.random() < k / 400 else fr, 1) for _ in range(800)), None) for k in range(401)]
    docs = spark.createDataFrame([*clean, *mixed, (200, "1 2 3", "en"), (201, None, None)], "doc_id long, text string, lang string")
    (tmp_path / "some").mkdir(), (tmp_path / "none").mkdir()
    docs.write.parquet(f"{tmp_path}/some/documents.parquet")
    docs.limit(0).write.parquet(f"{tmp_path}/none/documents.parquet")
    kept = {r.doc_id for r in corpus_pipeline.language(spark, docs, "").collect()}
    assert {i for i, _, _ in clean} <= kept and not kept & {200, 201} and len(kept & {i for i, _, _ in mixed}) < 401
    assert {r.doc_id for r in corpus_pipeline.run(spark, f"{tmp_path}/some").collect()} <= kept
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").count() == 0


def test_stages_return_the_columns_of_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        assert out.columns == docs.columns, name
        assert 0 < out.count() <= docs.count()
