"""The ten operators on small tables with nulls, empty and very long texts, ties, repeats and clashing columns."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarnfold.llm import ann_search, chat_format, exact_dedup, gru_scoring, html_extract, language_id, near_dedup, packing, pieces, sharding

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType())] + [T.StructField(c, T.StringType()) for c in ("row", "name", "sig", "keys", "word", "_sha", "key", "size", "rep", "some_id")])


def words(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice("alpha beta gamma delta Epsilon zeta, eta. theta iota kappa lambda mu nu xi".split()) + str(rng.randint(0, 40)) for _ in range(n))


def texts() -> list[tuple]:
    rng = random.Random(1)
    base = [words(rng, rng.randint(3, 120)) for _ in range(40)]
    rows = [(i, t) for i, t in enumerate(base)]
    rows += [(100, None), (101, ""), (102, "   "), (103, "\t\n "), (104, "one"), (105, "ONE"), (106, words(rng, 30_000)), (107, "é ü 中文 🙂"), (None, "no id"), (None, base[0])]
    rows += [(110 + i, base[3]) for i in range(30)] + [(150, base[3].replace(" ", " \n")), (151, " " + base[3]), (152, base[3].upper())]
    for i in range(30):  # near copies of a long text, and of each other
        w = base[5].split() + words(random.Random(7), 150).split()
        w[(i * 7) % len(w)] = f"changed{i}"
        rows.append((200 + i, " ".join(w)))
    rows += [(3, base[3]), (3, base[3]), (104, "one")]
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en" if i is None or i % 2 else "fr", *["x"] * (len(SCHEMA) - 3)) for i, t in texts()]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def norm(t: str | None) -> bytes:
    import re

    return re.sub(rb"[\x20\x09-\x0D]+", b" ", (t or "").encode())


# ---------------------------------------------------------------- 1


def test_shards_are_near_equal_and_gapless(docs, empty):
    got = sharding.shard_by_bytes(docs, shards=4).collect()
    assert Counter((r.doc_id, r.text_crc32, r.size) for r in got) == Counter((i, zlib.crc32((t or "").encode()), len((t or "").encode()) + 16) for i, t in texts())
    size, slots = Counter(), defaultdict(list)
    for r in got:
        size[r.shard] += r["size"]
        slots[r.shard].append(r.slot)
        assert r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < 4
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    largest = max(r["size"] for r in got)
    assert max(size.values()) - sum(size.values()) / 4 <= largest
    assert sharding.shard_by_bytes(empty).count() == 0


def test_shards_split_a_hot_text_and_keep_small_groups(spark):
    rows = [(i, "hot text " * 20 if i < 400 else f"text {i // 2} " * 20) for i in range(1200)]
    got = sharding.shard_by_bytes(spark.createDataFrame(rows, "doc_id long, text string"), shards=8).collect()
    size, of = Counter(), defaultdict(set)
    for r in got:
        size[r.shard] += r["size"]
        of[r.text_crc32].add(r.shard)
    mean = sum(size.values()) / 8
    assert len(size) == 8 and max(size.values()) < 1.1 * mean and min(size.values()) > 0.9 * mean
    assert max(map(len, of.values())) > 1 and sum(len(s) > 1 for s in of.values()) == 1


@pytest.mark.parametrize("part_rows", [1_000_000, 25])
def test_shards_are_those_of_one_sorted_list(spark, part_rows):
    # 300 null texts are few bytes and many rows: one shard, many parts
    texts_of = [None] * 300 + ["hot text " * 30] * 300 + [f"text {i // 3} " * (i % 40) for i in range(900)]
    rows = [(i if i % 50 else None, t) for i, t in enumerate(texts_of)] + [(7, None)] * 30
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3).withColumns({"part": F.lit(1), "key": F.lit("x")})
    got = sharding.shard_by_bytes(df, shards=8, part_rows=part_rows).collect()
    keys = {t: k for t, k in spark.createDataFrame([(t or "",) for t in set(texts_of)], "t string").select("t", F.xxhash64("t")).collect()}
    order = sorted(((keys[t or ""], -(2**63) if i is None else i, i, len(t or "") + 16) for i, t in rows), key=lambda r: r[:2])
    group, total = Counter(), sum(r[3] for r in order)
    for k, _, _, n in order:
        group[k] += n
    expect, run, starts = [], 0, {}
    for k, _, i, n in order:
        starts.setdefault(k, run)
        middle = starts[k] + group[k] / 2 if group[k] <= total / 8 * 0.1 else run + n / 2
        expect.append((i, n, min(int(middle * 8 // total), 7)))
        run += n
    seen = Counter()
    slots = []
    for i, n, shard in expect:
        slots.append((i, n, shard, seen[shard]))
        seen[shard] += 1
    none = lambda r: tuple(-1 if x is None else x for x in r)
    assert sorted(map(none, ((r.doc_id, r["size"], r.shard, r.slot) for r in got))) == sorted(map(none, slots))


# ---------------------------------------------------------------- 2


def test_language_held_out_accuracy_and_undetermined(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = language_id.identify(docs, language_id.fit(docs.filter(~language_id.held_out()))).join(docs.select("doc_id", "lang"), "doc_id").collect()
    out = [r for r in got if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert len(out) > 20 and np.mean([r.lang_pred == r.lang for r in out]) > 0.97
    assert all(0 <= r.score <= 1 for r in got)


def test_language_edges(docs, empty):
    model = language_id.fit(docs)
    got = {r.doc_id: r for r in language_id.identify(docs, model).collect()}
    assert {i for i, r in got.items() if r.lang_pred == "und"} == {100, 101, 102, 103}
    assert language_id.fit(empty) is None and language_id.identify(empty, model).count() == 0
    assert {r.lang_pred for r in language_id.identify(docs, None).collect()} == {"und"}
    assert language_id.keep_identified(docs, None).columns == docs.columns
    assert language_id.keep_identified(docs, None).count() == docs.count() - 4


def plain_features(text: str) -> np.ndarray:
    """Counted gram by gram."""
    kept = "".join(chr(b) if b >= 128 or 97 <= b <= 122 else " " for b in text.lower().encode())
    while "  " in (kept := f" {kept} " if kept[:1] != " " or kept[-1:] != " " else kept):
        kept = kept.replace("  ", " ")
    b, out = kept.encode("latin-1"), np.zeros(language_id.FEATURES, np.int64)
    for i in range(len(b)):
        hashes = [b[i] * 7919]
        if i + 1 < len(b):
            hashes.append(b[i] * 104729 + b[i + 1] * 1299709 + 1)
        if i + 2 < len(b):
            hashes.append(b[i] * 15485863 + b[i + 1] * 32452843 + b[i + 2] * 49979687 + 2)
        for h in hashes:
            out[(h ^ (h >> 11)) & (language_id.FEATURES - 1)] += 1
    return out


LINES = {"en": "the thing that they think of when the other one has gone there with them", "fr": "le jour que nous avons été dans la maison où il était une fois", "de": "der Mann hat sich nicht über das Haus und die Straße gefreut"}


def test_language_matches_brute_force_decoding(spark):
    rng = random.Random(2)
    rows = [(k, " ".join(rng.choice(LINES[lang].split()) for _ in range(n)), lang) for k, (lang, n) in enumerate((lang, n) for lang in LINES for n in (5, 30, 200) for _ in range(4))]
    mixed = [(1000 + k, " ".join(rng.choice((LINES["en"] + " " + LINES["fr"]).split()) for _ in range(400)), None) for k in range(6)]
    df = spark.createDataFrame(rows + mixed + [(2000, "été " * 3, None), (2001, "12 34", "en")], "doc_id long, text string, lang string")
    model = language_id.fit(df)
    counts = {lang: sum(plain_features(t) for _, t, x in rows if x == lang) + 0.5 for lang in LINES}
    share = {lang: c / c.sum() for lang, c in counts.items()}
    names, code = sorted(LINES), language_id.codebook(3)
    weights = np.array([np.log(sum(share[x] for x, s in zip(names, bit, strict=True) if s > 0) / (bit > 0).sum() / (sum(share[x] for x, s in zip(names, bit, strict=True) if s < 0) / (bit < 0).sum())) for bit in code.T])
    own = np.mean([np.abs(weights @ share[x]) for x in names], axis=0)
    ambiguous = set()
    for r in language_id.identify(df, model).collect():
        text = df.filter(F.col("doc_id") == r.doc_id).first().text
        if r.doc_id == 2001:
            assert r.lang_pred == "und"
            continue
        f = plain_features(text)
        margin = weights @ f / f.sum() / own
        loss = [sum(o / own.sum() * np.log1p(np.exp(-2 * s * m)) for o, s, m in zip(own, word, margin, strict=True)) for word in code]
        assert r.lang_pred == names[int(np.argmin(loss))]
        gap = sorted(loss)[1] - min(loss)
        assert r.ambiguous == (gap < 0.05 * f.sum() / (f.sum() + 200))
        ambiguous |= {r.doc_id} if r.ambiguous else set()
    assert ambiguous and ambiguous <= {i for i, _, _ in mixed}
    assert {r.doc_id for r in language_id.keep_identified(df, model).collect()} == {r.doc_id for r in df.collect()} - ambiguous - {2001}


def test_features_in_parts():
    for text in ("", "a", "ab", "Été, 12 x" * 50, "a  b\n" * 7):
        whole = language_id.features(text.encode())
        assert (whole == plain_features(text)).all()
        for part in (1, 2, 5, 64):
            assert (language_id.features(text.encode(), part) == whole).all()


@pytest.mark.parametrize("n", [1, 2, 4, 6, 7, 20])
def test_codewords_lie_apart(n):
    code = language_id.codebook(n)
    assert len({tuple(c) for c in code}) == n
    if n > 2:
        assert min((code[i] != code[j]).sum() for i in range(n) for j in range(i)) >= (1 << (n - 2) if n <= 6 else 5)


# ---------------------------------------------------------------- 3


def test_search_recall_order_and_edges(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, 24)).astype(np.float32)
    x[10] = x[0]
    x[11] = x[0]
    rows = [(i, [float(a) for a in v]) for i, v in enumerate(x)]
    bad = [(5000, None), (5100, [0.0] * 24), (5200, [float("nan")] * 24), (5300, [1.0] * 23 + [None]), (5400, [float("inf")] * 24), (5500, [1.0, 2.0]), (None, [1.0] * 24), (7, rows[7][1])]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<float>").withColumns({"list": F.lit("x"), "v": F.lit(1), "part": F.lit(2)})
    got = defaultdict(list)
    for r in ann_search.search(df, lambda v: v % 100 == 0).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.rank, r.vec_id, r.score))
    assert set(got) == set(range(0, 3000, 100))
    hit = 0
    for q, found in got.items():
        d = np.sqrt(((x.astype(float) - x[q].astype(float)) ** 2).sum(axis=1))
        d[q] = np.inf
        hit += len({v for _, v, _ in found} & set(np.argsort(d)[:10].tolist()))
        assert [r for r, _, _ in found] == list(range(1, 11)) and [(s, v) for _, v, s in found] == sorted((s, v) for _, v, s in found)
        assert all(abs(d[v] - s) < 1e-12 for _, v, s in found)
    assert hit / 300 >= 0.9
    assert [v for _, v, _ in got[0][:2]] == [10, 11]


def test_search_few_and_none(spark):
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [2.0, 0.0])], "vec_id long, embedding array<float>")
    assert [(r.rank, r.vec_id) for r in ann_search.search(few, lambda v: v == 0).orderBy("rank").collect()] == [(1, 2), (2, 1)]
    assert ann_search.search(few.limit(0), lambda v: v == 0).count() == 0


def test_search_takes_every_row_of_a_repeated_id(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.0, 2.0]), (1, [5.0, 5.0]), (2, [1.0, 1.0]), (2, [1.0, 1.0]), (100, [3.0, 3.0]), (100, [4.0, 4.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in ann_search.search(df, lambda v: v % 100 == 0).collect())
    truth = []
    for i, (q, v) in enumerate(rows):
        if q % 100 == 0:
            others = sorted((float(np.sqrt(((np.array(v) - np.array(w)) ** 2).sum())), c) for j, (c, w) in enumerate(rows) if j != i)
            truth += [(q, n, c, d) for n, (d, c) in enumerate(others, 1)]
    assert got == sorted(truth)


def test_search_of_clusters_probes_few_lists(spark):
    rng = np.random.default_rng(1)
    hearts = rng.normal(size=(40, 32)) * 4
    x = hearts[rng.integers(0, 40, 12_000)] + rng.normal(size=(12_000, 32)) * 0.5
    x[:4000] = x[0] + rng.normal(size=(4000, 32)) * 0.01  # a third of all rows in one place
    df = spark.createDataFrame(pd.DataFrame({"vec_id": np.arange(len(x)), "embedding": x.tolist()}), "vec_id long, embedding array<double>")
    keyed = ann_search.usable(df, "vec_id", "embedding")
    index = ann_search.fit(keyed, len(x), 32)
    assert len(index.centroids) == 23 and index.probes < len(index.centroids) / 2
    got = defaultdict(set)
    for r in ann_search.search(df, lambda v: v % 100 == 0, block=512).collect():
        got[r.query_id].add(r.vec_id)
    hit = 0
    for q in range(0, len(x), 100):
        d = ((x - x[q]) ** 2).sum(axis=1)
        d[q] = np.inf
        hit += len(got[q] & set(np.argsort(d)[:10].tolist()))
    assert hit / (10 * len(got)) >= 0.95 and len(got) == 120


def test_a_carried_bound_leaves_only_what_may_be_nearer():
    rng = np.random.default_rng(2)
    x, q = rng.normal(size=(500, 32)), rng.normal(size=(3, 32))
    index = ann_search.Index(32, np.linalg.qr(rng.normal(size=(32, 32)))[0], np.zeros((1, 32)))
    d = np.sqrt(((x[None] - q[:, None]) ** 2).sum(axis=2))
    bounds = np.sort(d, axis=1)[:, 4]
    i, j, found = ann_search.scan_block(index, q, bounds, np.array([-1, -2, -3]), x, np.arange(500), np.arange(500), 10)
    assert np.allclose(found, d[i, j]) and (found <= bounds[i] * (1 + 1e-9)).all()
    assert len(found) >= 14


def test_index_of_most_lists_takes_little_memory():
    import tracemalloc

    rng = np.random.default_rng(8)
    x = rng.normal(size=(20_000, 64))
    index = ann_search.Index(64, np.eye(64), rng.normal(size=(4096, 64)))
    tracemalloc.start()
    at, away = index.nearest(x)
    for rows in index.some_rows(x):
        assert index.distances(x[rows]).nbytes <= ann_search.BLOCK_BYTES
    index.probes = ann_search.probes_for(index, x, 10, 0.98, asked=20)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100e6, peak
    some = rng.choice(20_000, 50)
    d = index.distances(x[some])
    assert (d.argmin(axis=1) == at[some]).all() and np.allclose(np.sqrt(d.min(axis=1)), away[some])


def test_sample_of_the_index_comes_from_the_whole_table(spark):
    rows = 30_000
    df = spark.range(rows).select(F.array(F.col("id").cast("double"), F.lit(1.0)).alias("v"), F.col("id").alias("key"))
    index = ann_search.fit(df, rows, 2, sample_rows=2000, per_list=100)
    share = [(index.centroids[:, 0] >= rows * k / 6).mean() for k in range(6)]
    assert abs(share[5] - 1 / 6) < 0.05 and abs(share[3] - 1 / 2) < 0.07


# ---------------------------------------------------------------- 4


def test_chat_round_trip(spark):
    rows = [
        (1, 2, "assistant", "<|im_end|><|im_start|>user\n<\\|x <\\\\| <||"), (1, 1, "user", "a<"), (1, 3, "assistant", "|im_end|>"), (1, 4, "user", None), (1, 4, "user", ""), (1, 4, "user", "b"),
        (2, 0, "assistant", "ü🙂\n\n"), (2, 0, "assistant", "ü🙂\n\n"), (3, None, "ro\nle<|nl|>", "x" * 300_000), (None, 0, None, "y"), (4, 1, "user", "only"),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns({"ts": F.lit(1), "blocks": F.lit("x")})
    formatted = chat_format.format_chat(df)
    got = {r.conv_id: r for r in chat_format.read_back(formatted).collect()}
    for conv in {r[0] for r in rows}:
        turns = sorted(((t is not None, t or 0, role or "", text or "") for c, t, role, text in rows if c == conv))
        assert [(t.role, t.text) for t in got[conv].turns] == [t[2:] for t in turns]
        assert got[conv].loss_text == "".join(t[3] for t in turns if t[2] == "assistant")
    assert got[1].formatted.count("<|im_start|>") == 3 and got[1].formatted.count("<|im_end|>") == 3
    assert chat_format.read_back(chat_format.format_chat(df.limit(0))).count() == 0


def test_chat_of_many_turns_and_of_other_spans(spark):
    turns = [(1, k, ("user", "assistant", "assistant")[k % 3], f"t{k}ü<|im_sep|>" * (k % 4)) for k in range(3000)]
    formatted = chat_format.format_chat(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string"))
    got = chat_format.read_back(formatted).first()
    assert [(t.role, t.text) for t in got.turns] == [t[2:] for t in turns] and got.loss_text == "".join(t[3] for t in turns if t[2] == "assistant")
    assert [got.formatted[s.start : s.start + s.length] for s in got.loss_spans] == [t[3].replace("<|", "<\\|") for t in turns if t[2] == "assistant"]
    other = formatted.withColumn("loss_spans", F.expr("slice(loss_spans, 2, 5)"))
    assert chat_format.read_back(other).first().loss_text == "".join([t[3] for t in turns if t[2] == "assistant"][1:6])


# ---------------------------------------------------------------- 5


@pytest.mark.parametrize("block", [1, 16, 4096])
def test_exact_groups_match_brute_force(docs, block):
    if block == 1:
        docs = docs.filter("length(text) < 200 or text is null")
    groups = defaultdict(list)
    for r in docs.collect():
        groups[norm(r.text)].append(r.doc_id)
    want = Counter()
    for t, ids in groups.items():
        keep = min(ids, key=lambda i: (i is None, i or 0))
        for i in ids:
            want[(i, keep, len(ids), hashlib.sha256(t).hexdigest())] += 1
    got = exact_dedup.exact_groups(docs, block_bytes=block).collect()
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == want
    assert sum(r.kept for r in got) == len(groups) and all(r.doc_id == r.keep_id for r in got if r.kept)


def test_blocks_that_many_tasks_hold_are_merged_before_the_ranking(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "OFTEN", 4)
    monkeypatch.setattr(exact_dedup, "SALTS", 3)
    parts, most = 40, []
    named = exact_dedup._named
    monkeypatch.setattr(exact_dedup, "_named", lambda df, *by: (most.append(df.groupBy(*by).count().agg(F.max("count")).first()[0]) if by == ("block",) else None) or named(df, *by))
    # the middle block of every text is the same, as is a third of the texts; each read deals the rows anew
    text = F.concat(F.repeat(F.lit("a"), 8), F.repeat(F.lit("b"), 8), F.when(F.col("id") % 3 == 0, "c").otherwise(F.col("id").cast("string")))
    rows = spark.range(600).select(F.col("id").alias("doc_id"), text.alias("text")).repartition(parts, F.rand())
    got = {r.doc_id: r for r in exact_dedup.exact_groups(rows, block_bytes=8).collect()}
    assert len(got) == 600 and all((r.keep_id, r.group_size) == ((0, 200) if i % 3 == 0 else (i, 1)) for i, r in got.items())
    assert most == [3]  # 40 tasks hold the block
    assert not [d for d in spark.catalog.listDatabases() if d.name.startswith("scratch_")]


def test_keep_first_keeps_one_of_each(docs, empty):
    kept = exact_dedup.keep_first(docs)
    assert kept.columns == docs.columns
    assert sorted(norm(r.text) for r in kept.collect()) == sorted({norm(t) for _, t in texts()})
    assert exact_dedup.exact_groups(empty).count() == 0 and exact_dedup.keep_first(empty).count() == 0


# ---------------------------------------------------------------- 6


@pytest.fixture(scope="module")
def piece_set():
    return pieces.Pieces(public_tokenizers.path("piece_bpe_32k.model"))


def test_pieces_round_trip(docs, empty):
    path = public_tokenizers.path("piece_bpe_32k.model")
    got = pieces.digest(docs, path).collect()
    assert all(r.round_trip for r in got) and Counter(r.decoded_sha256 for r in got) == Counter(hashlib.sha256((t or "").encode()).hexdigest() for _, t in texts())
    back = pieces.decode(pieces.encode(docs, path), path).collect()
    assert Counter(r.text for r in back) == Counter(t for _, t in texts())
    assert pieces.digest(empty, path).count() == 0


def test_viterbi_is_the_best_segmentation_and_streams(piece_set):
    rng = random.Random(3)
    for text in ["", "▁", "▁▁▁a▁", "中文🙂", "".join(rng.choice("abcdefgh▁ei") for _ in range(3000)), "the" * 200]:
        parts = list(pieces.viterbi_stream(piece_set, text))
        best = [0.0] + [-np.inf] * len(text)
        for i in range(len(text)):
            for size in range(1, min(piece_set.longest, len(text) - i) + 1):
                p = piece_set.id_of.get(text[i : i + size])
                s = piece_set.score[p] if p is not None else piece_set.byte_score * len(text[i].encode()) if size == 1 else -np.inf
                best[i + size] = max(best[i + size], best[i] + s)
        ids = [i for p in parts for i in p]
        bytes_ = set(piece_set.byte_id)
        assert b"".join(piece_set.text[i] for i in ids).decode() == text.replace("▁", " ")
        assert abs(sum(piece_set.byte_score if i in bytes_ else piece_set.score[i] for i in ids) - best[-1]) <= 1e-6 * max(1, abs(best[-1]))
        assert len(parts) > 10 or len(text) < 1000
        assert ids == [i for p in pieces.viterbi_stream(piece_set, text, keep=5) for i in p]


def test_ids_are_the_models(piece_set, spark, sf_dir):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    encode, rng = pieces.Encoder(piece_set), random.Random(4)
    for text in ("", "▁", "x▁y", " ▁", "▁ ", "▁▁▁▁", " ", "x ▁ y", "▁x" * 300, "=▁" * 100, "no_blank_" * 500):
        assert encode(text).tolist() == model.encode(text), text[:20]
    odd = ["a des des", "the" * 200, "".join(rng.choice("abcdefghei") for _ in range(3000)), "e" * 1000, "中文🙂 ü", "x  y   z", "can't\n\nstop"]
    for text in odd + [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").limit(150).collect() if r.text]:
        assert encode(text).tolist() == model.encode(text), text[:80]
    merges = pieces.Merges(piece_set)
    text = "".join(rng.choice("abcdefgh▁ei") for _ in range(3000))
    parts = list(pieces.merged_stream(piece_set, merges, text))
    assert len(parts) > 10 and [i for p in parts for i in p] == [i for p in pieces.merged_stream(piece_set, merges, text, keep=5) for i in p]
    words = ["".join(rng.choice("abcdefgh▁ei中t") for _ in range(rng.randint(1, 40))) for _ in range(3000)]
    words += ["".join(rng.choice("abcdefgh▁ei中t") for _ in range(rng.randint(60, 2000))) for _ in range(40)] + ["a" * 5000, "the" * 900, "中" * 700, "", "▁" * 300, "=" * 400]
    assert merges.encode(words) == [np.array([i for p in pieces.merged_stream(piece_set, merges, w) for i in p], "<i4").tobytes() for w in words]


def test_few_stretches_go_on_by_themselves_and_many_abreast(piece_set):
    merges, rng = pieces.Merges(piece_set), random.Random(9)
    texts_of = ["".join(rng.choice("thequickbrown▁fox") for _ in range(900)) for _ in range(40)]
    one_by_one = [merges.encode([t])[0] for t in texts_of]
    assert merges.encode(texts_of) == one_by_one
    few = merges.FEW
    try:
        merges.FEW = 0
        assert merges.encode(texts_of[:3]) == one_by_one[:3]
        merges.FEW = 10_000
        assert merges.encode(texts_of[:3]) == one_by_one[:3]
    finally:
        merges.FEW = few


def test_whole_documents_stream_with_early_ends(piece_set, spark, sf_dir):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    merges = pieces.Merges(piece_set)
    for r in spark.read.parquet(f"{sf_dir}/documents.parquet").filter("length(text) > 1000").limit(10).collect():
        parts = list(pieces.merged_stream(piece_set, merges, "▁" + r.text.replace(" ", "▁")))
        assert len(parts) > len(r.text) // 100 and [i for p in parts for i in p] == model.encode(r.text)


# ---------------------------------------------------------------- 7

PAGE = """<html><head><title>T</title></head><body><header><a href=x>Home</a></header><div class="cookie-notice"><p>We use cookies, really, a lot of them, on this page.</p></div>
<nav><ul><li>a<li>b</ul></nav><aside><p>aside text, long enough to score, is not wanted here</p></aside><div id="content" class="no-sidebar"><article><h1>Head &amp; line</h1><p>First,   one
para.<script>var a="</p>";</script><p>Second <b>bold<br>text</b>, with&nbsp;more, and a <a href=y>link</a>.</p><ul><li>item one<li>item two</ul><form><p>Send, this, form</p></form></article>
<div class="comments"><p>A reader, says, something, long and winding, that nobody asked for at all.</p></div></div><footer>&copy; x</footer></body></html>"""


def test_main_text():
    assert html_extract.extract(PAGE) == "Head & line\n\nFirst, one para.\n\nSecond bold text, with more, and a link.\n\nitem one\n\nitem two"


LONG = "".join(f"<p>Body {i}, with words, and more of them, so that this part scores best of all on the page.</p>" for i in range(12))
BESIDE_BODY = f"<h1>Title</h1><div class=lead><p>A short lead</p></div><div class=body>{LONG}</div><ul><li>an item</ul><table><tr><td>cell</table><pre>code</pre><h2>End</h2><p>bye</p>"


@pytest.mark.parametrize("around", ["<article>{}</article>", "<main><article>{}</article></main>", "<body><div>{}</div></body>", "<body>{}</body>"])
def test_main_text_keeps_what_lies_beside_the_best_part(around):
    menu = "<div><a href=1>one</a> <a href=2>two</a> <a href=3>three</a></div>"
    got = html_extract.extract(around.format(BESIDE_BODY + menu)).split("\n\n")
    assert got[:3] == ["Title", "A short lead", "Body 0, with words, and more of them, so that this part scores best of all on the page."]
    assert got[14:] == ["an item", "cell", "code", "End", "bye"]


def test_names_forms_and_pages_of_links():
    kept = f"<article>{LONG}<div class='notice-period'><p>Notice of a month</p></div><p class='side-effects'>Side effects, rare</p><p class=sharecropper>Shared, too</p></article>"
    assert html_extract.extract(kept).split("\n\n")[12:] == ["Notice of a month", "Side effects, rare", "Shared, too"]
    for name in ("cookie-notice", "site-notice-bar", "navMenu", "ad-slot-3", "related_posts", "newsletter-signup", "share"):
        assert html_extract.extract(f"<article>{LONG}<div class='x {name}'><p>Not, this</p></div></article>").count("\n\n") == 11, name
    wrapped = f"<body><form action=x id=aspnetForm><article>{LONG}<p>inside</p></article><input type=hidden><button>Go</button></form><form><p>Send, this, please</p></form></body>"
    assert html_extract.extract(wrapped).split("\n\n")[12:] == ["inside"]
    assert html_extract.extract("<body><nav><a href=x>a</a></nav><div><a href=x>one</a> <a href=y>two</a></div></body>") == ""


@pytest.mark.parametrize("seed", range(30))
def test_main_text_of_generated_pages_is_their_truth(seed):
    """Pages put together from article blocks, whose texts are the truth, and from other parts around and among them."""
    rng, truth, n = random.Random(seed), [], 0

    def sentence(size: int) -> str:
        nonlocal n
        n += 1
        return f"Text {n} " + ", ".join(rng.choice("alpha beta gamma delta".split()) for _ in range(size)) + "."

    def block() -> str:
        text = sentence(rng.choice([1, 4, 30, 60]))
        truth.append(text)
        body = text.replace(" ", rng.choice([" ", "\n  "]), 1)
        tag = rng.choice(["p", "p", "p", "h2", "blockquote", "pre", "li", "td"])
        body = f"<{tag}>{body}</{tag}>"
        return {"li": f"<ul>{body}</ul>", "td": f"<table><tr>{body}</tr></table>"}.get(tag, body)

    def noise() -> str:
        text = sentence(rng.choice([2, 10, 30]))
        return rng.choice([f"<script src=https://cdn.example/>var leak = '{text}';</script>", f"<style/>.x{{content: '{text}'}}</style>", f"<svg><title/><path d='M 0 0'/><text>{text}</text></svg>", f"<div class=share><p>Tweet {n}</p></div>", f"<div class=related><a href=1>{text}</a></div>", f"<nav><ul><li>{text}</ul></nav>", f"<aside><p>{text}</p></aside>", f"<div class='x comments'><p>{text}</p></div>", f"<footer>{text}</footer>", f"<div id=cookie-banner><p>{text}</p></div>", f"<form><p>{text}</p><input></form>", f"<script>var x='{text}'</script>", f"<div class=ad>{text}</div>"])

    parts = [block() for _ in range(3)]
    for _ in range(rng.randint(2, 10)):
        before = len(truth)
        group = "".join(block() for _ in range(rng.randint(1, 3)))
        around = rng.choice(["{}", "<div>{}</div>", "<section>{}</section>", "<section class=social><p>Policy, in detail, and more of it, too.</p>{}</section>"])
        if "social" in around:
            truth.insert(before, "Policy, in detail, and more of it, too.")
        parts.append(around.format(group))
        if rng.random() < 0.4:
            parts.append(noise())
    page = noise() + "<article>" + "".join(parts) + "</article>" + noise() + noise()
    if rng.random() < 0.5:  # beside the article
        page += f"<section><h2>{truth.append('Part two') or 'Part two'}</h2>" + block() + "</section>"
    if rng.random() < 0.5:
        truth.append("own text of the parent")
        page += "own <b>text</b> of <a href=/>the</a> parent"
    page = rng.choice(["{}", "<form id=all>{}</form>", "<div class=has-sidebar><main>{}</main></div>"]).format(page)
    assert html_extract.extract(f"<html><body>{page}</body></html>").split("\n\n") == truth


def plain_text(source: str) -> str:
    """The rules of extract() over the standard library's parser, for pages whose tags are closed; scores by going up from each paragraph."""
    from html.parser import HTMLParser

    class Tree(HTMLParser):
        def __init__(self):
            super().__init__(convert_charrefs=True)
            self.at = self.root = {"tag": "#root", "names": "", "parts": [], "up": None, "hidden": False}

        def handle_starttag(self, tag, attrs):
            a = {k: v or "" for k, v in attrs}
            child = {"tag": tag, "names": " ".join(a.get(k, "") for k in ("class", "id", "role")), "parts": [], "up": self.at, "hidden": "hidden" in a or "display:none" in a.get("style", "").replace(" ", "")}
            self.at["parts"].append(child)
            if tag not in html_extract.VOID:
                self.at = child

        def handle_startendtag(self, tag, attrs):
            self.handle_starttag(tag, attrs)
            if tag not in html_extract.VOID and self.up_of("svg"):
                self.at = self.at["up"]
            elif tag in ("script", "style"):
                self.set_cdata_mode(tag)

        def up_of(self, *tags):
            n = self.at
            while n is not None and n["tag"] not in tags:
                n = n["up"]
            return n

        def handle_endtag(self, tag):
            n = self.up_of(tag)
            if n is not None:
                self.at = n["up"]

        def handle_data(self, data):
            self.at["parts"].append(data)

    tree = Tree()
    tree.feed(source)
    tree.close()

    def nodes(n):
        yield n
        for x in n["parts"]:
            if isinstance(x, dict):
                yield from nodes(x)

    def within(n, *tags):
        while n is not None and n["tag"] not in tags:
            n = n["up"]
        return n is not None

    text = lambda n: sum(len(x.strip()) if isinstance(x, str) else text(x) for x in n["parts"])
    links = lambda n: text(n) if n["tag"] == "a" else sum(links(x) for x in n["parts"] if isinstance(x, dict))
    dense = lambda n: links(n) / text(n) if text(n) else 0
    flow = lambda n: "".join(x if isinstance(x, str) else "" if x["tag"] in html_extract.BLOCK else flow(x) for x in n["parts"])

    def points(n):
        t = flow(n).strip()
        return 1 + t.count(",") + min(len(t) / 100, 3) if n["tag"] in html_extract.PARAGRAPH and t and dense(n) <= 0.5 else 0

    def drop(wrong):
        for n in [n for n in nodes(tree.root) if n["up"] is not None and wrong(n)]:
            n["up"]["parts"] = [x for x in n["up"]["parts"] if x is not n]

    def named(n):
        if n["tag"] in ("html", "body", "article", "main"):
            return 0
        return max((html_extract._unlikely(x) for x in n["names"].split()), default=0)

    drop(lambda n: n["tag"] in html_extract.NEVER or n["hidden"] or named(n) == 2 or named(n) == 1 and not within(n, "article", "main") or n["tag"] == "header" and not within(n, "article", "main"))
    all_text = text(tree.root)
    drop(lambda n: n["tag"] == "form" and not any(x["tag"] in ("article", "main", "h1") for x in nodes(n)) and 2 * text(n) <= all_text)
    drop(lambda n: named(n) == 1 and sum(map(points, nodes(n))) < 3)
    score = Counter()
    for n in nodes(tree.root):
        up = n["up"]
        for share in (1, 2, 6, 9, 12):
            if up is not None:
                score[id(up)] += points(n) / share
                up = up["up"]
    for n in nodes(tree.root):
        if n["tag"] in ("article", "main") and text(n):
            score[id(n)] = 1.5 * score[id(n)] + 5
        score[id(n)] *= 1 - dense(n)
    best = max(nodes(tree.root), key=lambda n: score[id(n)])
    top, n, above = None, best, []
    while n is not None:
        above.append(id(n))
        top, n = (n if n["tag"] in ("article", "main") else top), n["up"]
    if score[id(best)] > 0:
        kept = {id(x) for x in nodes(best)} | set(above)
        drop(lambda n: id(n) not in kept and n["tag"] in html_extract.LISTS and dense(n) > 0.5 and sum(x["tag"] == "a" for x in nodes(n)) > 1 and not any(x["tag"] in html_extract.HEADINGS for x in nodes(n)))
    elif dense(tree.root) > 0.5:
        return ""
    out = []

    def blocks(parts):
        for x in parts:
            if isinstance(x, str):
                out.append(x)
            elif x["tag"] == "br":
                out.append(" ")
            elif x["tag"] in html_extract.BLOCK:
                out.append("\0")
                blocks(x["parts"])
                out.append("\0")
            else:
                blocks(x["parts"])

    blocks(tree.root["parts"] if top is None or score[id(best)] <= 0 else top["up"]["parts"])
    return "\n\n".join(t for t in (" ".join(b.split()) for b in "".join(out).split("\0")) if t)


def test_main_text_of_pages_is_that_of_plain_rules(spark, sf_dir):
    pages = [r.html for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()]
    got = [html_extract.extract(page) for page in pages]
    assert len(pages) > 20 and got == [plain_text(page) for page in pages] and all(got)


PROBES = {
    "<div><main><p>One, a.</p><p>Two, b.</p></main><section><h2>Part two</h2><p>Short second part.</p></section></div>": ["One, a.", "Two, b.", "Part two", "Short second part."],
    "<body>Own text <b>bold</b> here<main><p>One, a, b, c.</p></main>tail &amp; end</body>": ["Own text bold here", "One, a, b, c.", "tail & end"],
    "<article><script src=https://cdn.example/>var leak = 1;</script><p>Body, text</p></article>": ["Body, text"],
    "<article><style/>.x{color:red}</style><p>Body, text</p></article>": ["Body, text"],
    "<article><p>See <a href=https://x.example/>the page</a>, please, now.</p></article>": ["See the page, please, now."],
    "<article><p>Text, long, enough.</p><section class='social'><p>Social policy, in detail, and more of it, too.</p></section></article>": ["Text, long, enough.", "Social policy, in detail, and more of it, too."],
    "<article><div class=header><h1>A title, with, commas</h1></div><p>Text, long, enough.</p><div class=share><p>Share this</p></div></article>": ["A title, with, commas", "Text, long, enough."],
    "<article><p>Before, it.</p><svg/><math><mi/></math><p>After, it.</p></article>": ["Before, it.", "After, it."],
}


@pytest.mark.parametrize("page", sorted(PROBES))
def test_main_text_neither_leaks_nor_loses(page):
    assert html_extract.extract(page).split("\n\n") == PROBES[page]


def test_main_text_of_an_empty_table(spark):
    assert html_extract.main_text(spark.createDataFrame([], "page_id long, url string, html string, text int")).count() == 0


def test_hidden_is_an_attribute():
    page = "<article><p title='no hidden costs' data-id=menu>Shown, all</p><p data-x='display: none'>Also, this</p><p hidden>no</p><p style='display:none'>no</p></article>"
    assert html_extract.extract(page) == "Shown, all\n\nAlso, this"


@pytest.mark.parametrize("page", [None, "", "<", "<p", "<nav>x</nav>", "<!-- <p>x</p>", "<script>x", "<div><a href=x>only a link</a></div>"])
def test_main_text_of_odd_pages(page):
    assert isinstance(html_extract.extract(page), str)


def test_main_text_keeps_everything_of_long_and_deep_pages(spark):
    long = "<article>" + "".join(f"<p>para {i}, text</p>" for i in range(3000)) + "</article>"
    deep = "<div>" * 3000 + "<p>deep, text</p>" + "</div>" * 3000
    df = spark.createDataFrame([(1, "u", long), (2, None, deep), (3, "u", None), (3, "u", None)], "page_id long, url string, html string")
    got = html_extract.main_text(df.withColumn("text", F.lit(1))).collect()
    assert [r.text for r in got] == ["\n\n".join(f"para {i}, text" for i in range(3000)), "deep, text", "", ""]
    assert all(r.n_chars == len(r.text) for r in got)


# ---------------------------------------------------------------- 8


def test_scores_match_brute_force_and_model_learns(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = gru_scoring.score(docs).collect()
    rows = {r.doc_id: (r.text or "").encode().lower().split() for r in docs.collect()}
    count = Counter()
    for i, w in rows.items():
        if zlib.crc32(str(i).encode()) % 10:
            count.update([*w, None])
    n, v = sum(count.values()), len(count)
    assert len(got) == len(rows)
    for r in got:
        w = [*rows[r.doc_id], None]
        assert (r.n_tokens, r.n_known, r.train_tokens, r.held_out) == (len(w), sum(count[x] > 0 for x in w), n, zlib.crc32(str(r.doc_id).encode()) % 10 == 0)
        assert abs(r.base_score - sum(np.log10((count[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w)) < 1e-6 * len(w)
    assert sum(r.score for r in got if r.held_out) > sum(r.base_score for r in got if r.held_out)


def test_model_learns_from_every_training_document(spark):
    # alike in all counts; one document's words stand in another order
    def weights(turned):
        rows = [(i, " ".join(("a b c d e f " * 4).split()[:: -1 if i == turned else 1])) for i in ids]
        docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).select("doc_id", F.col("text").cast("binary").alias("text"))
        return gru_scoring.train(docs, gru_scoring.vocabulary(gru_scoring.token_counts(docs))).flat()

    ids = [1, 2, 3, 4, None]
    plain = weights("none")
    assert (weights("none") == plain).all()
    for i in ids:
        assert (weights(i) != plain).any(), i


def test_model_gives_probabilities_that_sum_to_one():
    v = gru_scoring.Vocabulary({b"a": 0, b"b": 1, gru_scoring.END: 2}, np.array([5.0, 3.0, 2.0]), np.full(gru_scoring.SHAPES, 0.1), 10, 3)
    model = gru_scoring.Gru(v)
    state = np.random.default_rng(0).normal(size=(1, gru_scoring.HIDDEN)).astype(np.float32)
    every = np.arange(gru_scoring.MODEL_WORDS + gru_scoring.SHAPES)
    logs, _ = model.outputs(np.repeat(state, len(every), 0), every)
    assert abs(np.exp(logs).sum() - 1) < 1e-3


def test_gradients_are_right():
    v = gru_scoring.Vocabulary({b"a": 0, b"b": 1, gru_scoring.END: 2}, np.array([5.0, 3.0, 2.0]), np.full(gru_scoring.SHAPES, 0.1), 10, 3)
    model = gru_scoring.Gru(v)
    model.p = {k: x.astype(np.float64) for k, x in model.p.items()}
    h, y, g = np.random.default_rng(0).normal(size=(3, gru_scoring.HIDDEN)), np.array([0, 1, gru_scoring.MODEL_WORDS]), {}
    _, back = model.outputs(h, y, g)
    loss = lambda: -model.outputs(h, y, {})[0].sum()
    for array, grad, at in ((model.p["wc"], g["wc"], (2, 0)), (model.p["ww"], g["ww"], (0, 3, 1)), (h, back, (1, 4))):
        old = array[at]
        array[at] = old + 1e-5
        up = loss()
        array[at] = old - 1e-5
        down = loss()
        array[at] = old
        assert abs((up - down) / 2e-5 - grad[at]) < 1e-5


def small_model(seed=0):
    v = gru_scoring.Vocabulary({b"a": 0, b"b": 1, gru_scoring.END: 2}, np.array([5.0, 3.0, 2.0]), np.full(gru_scoring.SHAPES, 0.1), 10, 3)
    model, rng = gru_scoring.Gru(v), np.random.default_rng(seed)
    model.p = {k: (x + rng.normal(0, 0.3, x.shape)).astype(np.float64) for k, x in model.p.items()}
    return model, rng


def test_gradients_through_time_are_right():
    model, rng = small_model()
    end, symbols = 2, [0, 1, 2, gru_scoring.MODEL_WORDS + 1, 70]
    inputs, targets = rng.choice(symbols, (7, 3)), rng.choice(symbols, (7, 3))
    h, real = rng.normal(size=(gru_scoring.HIDDEN, 3)), rng.random((7, 3)) < 0.8
    _, grads, used, _ = model.gradients(inputs, targets, h, end, real)
    row = {int(x): k for k, x in enumerate(used)}
    loss = lambda: model.gradients(inputs, targets, h, end, real)[0]
    at = [("u", (2, 5)), ("u", (0, 20)), ("u", (7, 40)), ("wc", (3, 0)), ("bc", (1,)), ("ww", (0, 3, 1)), ("bw", (1, 6))]
    at += [("x", (x, k)) for x in row for k in (1, 17, 40)]
    for name, i in at:
        p = model.p[name]
        old, p[i] = p[i], p[i] + 1e-5
        up, p[i] = loss(), old - 1e-5
        down, p[i] = loss(), old
        told = grads[name][(row[i[0]], i[1]) if name == "x" else i]
        assert abs((up - down) / 2e-5 - told) < 1e-5 * max(1, abs(told)), (name, i)


def test_the_state_is_carried_and_cleared():
    model, rng = small_model(1)
    inputs, targets = rng.choice([0, 1, 2, 65], (12, 4)), rng.choice([0, 1, 2, 65], (12, 4))
    zero = np.zeros((gru_scoring.HIDDEN, 4))
    whole, _, _, last = model.gradients(inputs, targets, zero, 2)
    one, _, _, h = model.gradients(inputs[:5], targets[:5], zero, 2)
    two, _, _, h = model.gradients(inputs[5:], targets[5:], h, 2)
    assert abs(whole - one - two) < 1e-9 and np.allclose(h, last)
    fresh = np.full((1, 4), 2)
    assert np.allclose(model.gradients(fresh, fresh, h, 2)[3], model.gradients(fresh, fresh, zero, 2)[3])


def test_scores_match_a_plain_loop():
    model, rng = small_model(2)
    h_, end = gru_scoring.HIDDEN, 2
    lines = [rng.choice([0, 1, 65, gru_scoring.MODEL_WORDS + 2], n) for n in (0, 1, 5, 40, 200)]
    got = model.score(lines, end, rows=16)
    sigmoid = lambda x: 1 / (1 + np.exp(-x))
    for line, found in zip(lines, got, strict=True):
        h, before, total = np.zeros(h_), end, 0.0
        for y in [*line, end]:
            g, a = model.p["x"][before], h @ model.p["u"]
            z, r = sigmoid(g[:h_] + a[:h_]), sigmoid(g[h_ : 2 * h_] + a[h_ : 2 * h_])
            c = np.tanh(g[2 * h_ :] + r * a[2 * h_ :])
            h = (1 - z) * c + z * h
            k = y // gru_scoring.CLASS_WORDS if y < gru_scoring.MODEL_WORDS else y - gru_scoring.MODEL_WORDS + gru_scoring.WORD_CLASSES
            e = np.exp(h @ model.p["wc"] + model.p["bc"])
            total += np.log(0.9 * e[k] / e.sum() + 0.1 * model.class_share[k])
            if y < gru_scoring.MODEL_WORDS:
                e = np.exp(h @ model.p["ww"][k] + model.p["bw"][k])
                total += np.log(0.9 * e[y % gru_scoring.CLASS_WORDS] / e.sum() + 0.1 * model.word_share[y])
            before = y
        assert abs(found - total) < 1e-3 * len(line) + 1e-4


def test_every_symbol_is_a_target_once():
    model, _ = small_model(3)
    model.p = {k: x.astype(np.float32) for k, x in model.p.items()}
    seen, plain = [], model.outputs
    model.outputs = lambda states, targets, grads=None: (seen.extend(targets.tolist()), plain(states, targets, grads))[1]
    stream = np.random.default_rng(4).choice([0, 1, 2, 65, 130], 1003).astype(np.int32)
    assert model.train(stream, 2, streams=8) == 1003 and Counter(seen) == Counter(stream.tolist())
    assert model.train(stream[:0], 2) == 0 and model.train(stream[:1], 2) == 1


def test_the_head_is_bounded_and_full(spark, monkeypatch):
    monkeypatch.setattr(gru_scoring, "HEAD_WORDS", 100)
    rows = [(b" ", 5)] + [(b"w%d" % i, 1) for i in range(5000)] + [(b"often%d" % i, 1000) for i in range(20)] + [(b"x" * 300, 4000)]
    v = gru_scoring.vocabulary(spark.createDataFrame(rows, "word binary, c long"))
    assert 60 <= len(v.head) <= 140 and {b" ", b"x" * 300, *(b"often%d" % i for i in range(20))} <= set(v.head)
    assert v.tokens == sum(c for _, c in rows) and v.distinct == len(rows)


def test_scores_of_odd_tables(docs, empty):
    got = gru_scoring.score(docs).collect()
    assert len(got) == len(texts()) and all(np.isfinite(r.score) and r.score < 0 for r in got)
    assert {r.n_tokens for r in got if r.doc_id in (100, 101, 102, 103)} == {1}
    assert gru_scoring.score(empty).count() == 0
    alone = gru_scoring.score(docs.filter("doc_id = 10")).collect()  # crc32('10') % 10 decides what is learned
    assert len(alone) == 1


# ---------------------------------------------------------------- 9


def shingles(t: str | None, n: int) -> frozenset:
    w = (t or "").encode().lower().split()
    return frozenset([tuple(w)] if 0 < len(w) < n else [tuple(w[i : i + n]) for i in range(len(w) - n + 1)] if w else [])


@pytest.mark.parametrize("block", [8, 2048])
def test_near_groups_match_brute_force(docs, empty, block):
    rows = [(i, t) for i, t in texts() if i is not None]
    got = near_dedup.near_groups(docs, words=4, block=block, set_bytes=5000 if block == 8 else 32 << 20).collect()
    sets = {(i, t): shingles(t, 4) for i, t in rows}
    comp = {i: i for i, _ in rows}

    def find(x):
        while comp[x] != x:
            x = comp[x]
        return x

    items = list(sets.items())
    for a, ((i, _), s) in enumerate(items):
        for (j, _), u in items[:a]:
            if s and u and 100 * len(s & u) >= 80 * len(s | u):
                x, y = find(i), find(j)
                comp[max(x, y)] = min(x, y)
    want = Counter((i, len(sets[(i, t)]), find(i)) for i, t in rows)
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got if r.doc_id is not None) == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got if r.doc_id is not None)
    assert sum(r.doc_id is None for r in got) == 2
    if block > 8:
        assert near_dedup.near_groups(empty).count() == 0


def test_components_of_a_long_chain(spark):
    chain = spark.range(1, 200).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    got = {r.node: r.comp for r in near_dedup.components(chain.union(spark.range(500, 501).selectExpr("id", "id + 7"))).collect()}
    assert {got[i] for i in range(1, 201)} == {1} and got[507] == 500


# ---------------------------------------------------------------- 10


def test_packing_holds_every_id_once(docs, empty):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    tokenizer = Tokenizer.from_file(path)
    # distinct ids: the pieces are told apart by them
    df = docs.select("text").dropDuplicates().coalesce(2).select(F.monotonically_increasing_id().alias("doc_id"), "text")
    got = packing.pack(df, path, block_tokens=3000).collect()
    ids = {r.doc_id: tokenizer.encode(r.text or "", add_special_tokens=False).ids + [0] for r in df.collect()}
    parts, sequences = defaultdict(list), defaultdict(list)
    for r in got:
        parts[r.doc_id].append((r.start, r.length))
        sequences[r.sequence_id].append((r.offset, r.length))
        piece = np.array(ids[r.doc_id][r.start : r.start + r.length], "<u4")
        assert r.ids_crc32 == zlib.crc32(piece.tobytes()) and r.doc_tokens == len(ids[r.doc_id])
    for i, x in ids.items():
        at = 0
        for start, length in sorted(parts[i]):
            assert start == at
            at += length
        assert at == len(x)
    padding = 0
    for s in sequences.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at and length > 0
            at += length
        assert at <= 1024
        padding += 0 if at & (at - 1) == 0 else 1024 - at
    assert padding < 0.1 * sum(map(len, ids.values()))
    assert packing.pack(empty, path).count() == 0


def test_ids_are_the_tokenizers(docs):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    encode, tokenizer = packing.Encoder(path), Tokenizer.from_file(path)
    assert encode.fast is not None
    rng = random.Random(5)
    odd = ["", "  a\n\n  b\t c's  ", "x<|endoftext|>y", "\x85 a\x1c b", "a  \n", " 's'll ' s 12ab_c__ ", "ÀÖ ×÷ ß", "don't DON'T", "\r\n\r\n x", "中文 🙂\u3000x\u2028y ½²", "a" * 30_000, " " * 30_000 + "x", "é" * 25_000]
    odd += ["".join(rng.choice("ab Zé'\n\t 1,_<|>s中\x1f\xa0") for _ in range(60)) for _ in range(300)]
    for t in odd + [t for _, t in texts() if t]:
        assert np.frombuffer(encode(t), "<u4").tolist() == tokenizer.encode(t, add_special_tokens=False).ids, t[:50]


@pytest.mark.parametrize("rows", [0, 1, 7])
def test_packing_of_repeated_rows_and_clashing_names(spark, rows):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    given = [(3, "a b c " * 50), (3, "a b c " * 50), (None, None), (4, ""), (5, "z" * 3000)] * rows
    df = spark.createDataFrame(given, "doc_id long, text string").withColumns({n: F.lit("x") for n in ("start", "length", "tier", "step", "offset", "sequence_id", "ids")})
    got = packing.pack(df, path).collect()
    tokenizer = Tokenizer.from_file(path)
    want = Counter()
    for i, t in given:
        want[i] += len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1
    held = Counter()
    for r in got:
        held[r.doc_id] += r.length
    assert held == want
    firsts = Counter(r.doc_id for r in got if r.start == 0)
    assert firsts == Counter(i for i, _ in given)
