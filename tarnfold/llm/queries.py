"""The registered queries of the operators, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnfold.llm.ann_search import search
from tarnfold.llm.chat_format import format_chat, read_back
from tarnfold.llm.common import table
from tarnfold.llm.exact_dedup import exact_groups
from tarnfold.llm.gru_scoring import score
from tarnfold.llm.html_extract import main_text
from tarnfold.llm.language_id import fit, held_out, identify
from tarnfold.llm.manifest import manifest
from tarnfold.llm.mixing import mix
from tarnfold.llm.near_dedup import near_groups
from tarnfold.llm.packing import pack
from tarnfold.llm.pieces import digest
from tarnfold.llm.sharding import shard_by_bytes
from tarnfold.llm.whitening import whiten


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_sampled_splitters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_by_bytes(table(spark, sf_dir, "documents"), shards=40)


def op3_adaptive_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % 100 == 0, k=10)


PROBE = "<|im_end|><|im_start|>assistant ok"


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    probe = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(PROBE).alias("text"),
    )
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(probe)
    return read_back(format_chat(turns)).select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.expr(r"array_join(transform(turns, t -> concat(t.role, '\n', t.text, '\n')), '')"), 256).alias("turns_sha256"),
        F.char_length("loss_text").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss_text"), 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


OP4_SQL = rf"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{PROBE}' UNION ALL SELECT -1, 1, 'assistant', '{PROBE}'
), n AS (
  SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) IS DISTINCT FROM role AS opens,
    regexp_replace(role, '<(\\*)\|', '<\1\\|', 'g') AS r, regexp_replace(text, '<(\\*)\|', '<\1\\|', 'g') AS x
  FROM t
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length(x) + CASE WHEN opens THEN length('<|im_start|>') + length(replace(r, chr(10), '<|nl|>')) + 1 + length('<|im_end|>') + 1
    ELSE length('<|im_sep|>') END) AS BIGINT) AS formatted_chars
FROM n GROUP BY conv_id
"""


def op5_block_naming(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents")).drop("row")


OP5_SQL = r"""
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents),
g AS (SELECT *, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size FROM d)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM g
"""

def op2_ecoc_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(docs.filter(~held_out()))
    return identify(docs, model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "ambiguous")


def op6_streaming_viterbi(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return digest(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(table(spark, sf_dir, "pages"))


def op8_gru_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"))


def op9_hamming_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(table(spark, sf_dir, "documents"), words=4)


OP9_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS shingle FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM w WHERE len(w) > 0)
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 80 * (a.n + b.n - c)),
both_ways AS (SELECT x, y FROM links UNION SELECT y, x FROM links),
reach AS (SELECT x, y FROM both_ways UNION SELECT reach.x, both_ways.y FROM reach JOIN both_ways ON reach.y = both_ways.x),
least_of AS (SELECT x, min(y) AS y FROM reach GROUP BY x)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce(r.y, d.doc_id)) AS component_id, d.doc_id <= coalesce(r.y, d.doc_id) AS kept
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN least_of r ON r.x = d.doc_id
"""


def op10_tiered_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), tokenizer_path())


def op11_refined_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"), components=16)


def op12_sainte_lague(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


OP12_SQL = r"""
WITH d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size, md5('1:' || coalesce(CAST(doc_id AS VARCHAR), '-')) AS place
  FROM documents
), x AS (SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY place, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS x FROM d),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS nth FROM d GROUP BY source),
w AS (SELECT *, ([5, 2, 1])[nth % 3 + 1] AS weight FROM s),
c AS (
  SELECT coalesce(sum(source_size) OVER o, 0) AS capped, coalesce(sum(weight) OVER o, 0) AS gone, sum(source_size) OVER () AS all_sizes, sum(weight) OVER () AS all_weights
  FROM w WINDOW o AS (ORDER BY CAST(source_size AS DOUBLE) / weight, nth ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), t AS (
  SELECT *, least(weight * (SELECT max((CAST(1.5 AS DOUBLE) * all_sizes - 2 * capped) / (all_weights - gone)) FROM c), CAST(2 AS DOUBLE) * source_size) AS target,
    CAST(ceil(source_size / 32.0) AS BIGINT) AS blocks
  FROM w
), v AS (SELECT *, CASE WHEN source_size > 0 THEN target * blocks / source_size ELSE 0 END AS votes FROM t),
n AS (SELECT (CAST(sum(floor(votes * 1000000)) AS BIGINT) + 500000) // 1000000 AS n FROM v),
q AS (SELECT nth, row_number() OVER (ORDER BY votes / (2 * j + 1) DESC, nth, j) AS rank FROM (SELECT nth, votes, unnest(range(0, 2 * blocks)) AS j FROM v)),
g AS (SELECT nth, count(*) AS seats FROM q, n WHERE rank <= n GROUP BY nth),
e AS (
  SELECT v.*, coalesce(seats, 0) // greatest(blocks, 1) AS rounds, (coalesce(seats, 0) % greatest(blocks, 1)) * source_size // greatest(blocks, 1) AS more
  FROM v LEFT JOIN g ON g.nth = v.nth
)
SELECT doc_id, size, source_size, target, CAST(rounds * size + least(x + size, more) - least(x, more) AS BIGINT) AS taken
FROM x JOIN e ON e.source IS NOT DISTINCT FROM x.source
"""


def op13_nested_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampers = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    return manifest(table(spark, sf_dir, "documents"), tampers).select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def _field(name: str) -> str:
    return f"CASE WHEN {name} IS NULL THEN '-' ELSE strlen(CAST({name} AS VARCHAR)) || ':' || {name} END"


def _leaf(n_chars: str) -> str:
    return f"sha256({_field('doc_id')} || {_field('source')} || {_field('lang')} || {_field(n_chars)} || {_field('text')})"


#: crc32 by its table of 256 entries; up() are all nodes of the languages' trees, top() of the tree over the languages.
OP13_SQL = f"""
WITH RECURSIVE crc_table AS (
  SELECT list(list_reduce([CAST(b AS BIGINT)] || range(8), lambda c, _: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY b) AS crc FROM range(256) r(b)
), d AS (
  SELECT *, list_reduce([4294967295] || list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ord(c) AS BIGINT)), lambda a, c: xor(a >> 8, crc[(xor(a, c) & 255) + 1])) AS inverse
  FROM documents, crc_table
), leaves AS (
  SELECT doc_id, lang, {_leaf('n_chars')} AS leaf, CASE WHEN xor(inverse, 4294967295) % 7 = 0 THEN {_leaf('(n_chars + 1)')} ELSE {_leaf('n_chars')} END AS shown FROM d
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS rank, count(*) OVER (PARTITION BY lang) AS n FROM leaves
), up AS (
  SELECT lang, 0 AS level, rank AS i, n, leaf AS h FROM ranked
  UNION ALL SELECT lang, level + 1, i // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY i)) FROM up WHERE n > 1 GROUP BY lang, level, i // 2, n
), subroots AS (SELECT lang, h, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS rank, count(*) OVER () AS n FROM up WHERE n = 1),
top AS (
  SELECT 0 AS level, rank AS i, n, h FROM subroots
  UNION ALL SELECT level + 1, i // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY i)) FROM top WHERE n > 1 GROUP BY level, i // 2, n
), steps AS (
  SELECT r.lang, r.rank, u.level, u.i % 2 AS here, coalesce(x.h, '') AS other
  FROM ranked r JOIN up u ON u.lang IS NOT DISTINCT FROM r.lang AND u.i = r.rank >> u.level AND u.n > 1
  LEFT JOIN up x ON x.lang IS NOT DISTINCT FROM r.lang AND x.level = u.level AND x.i = xor(u.i, 1)
), top_steps AS (
  SELECT s.lang, 1000 + u.level AS level, u.i % 2 AS here, coalesce(x.h, '') AS other
  FROM subroots s JOIN top u ON u.i = s.rank >> u.level AND u.n > 1 LEFT JOIN top x ON x.level = u.level AND x.i = xor(u.i, 1)
), paths AS (
  SELECT r.lang, r.rank, coalesce((SELECT list({{'here': here, 'other': other}} ORDER BY level) FROM steps s WHERE s.lang IS NOT DISTINCT FROM r.lang AND s.rank = r.rank), [])
    || coalesce((SELECT list({{'here': here, 'other': other}} ORDER BY level) FROM top_steps s WHERE s.lang IS NOT DISTINCT FROM r.lang), []) AS path
  FROM ranked r
), fold AS (
  SELECT r.lang, r.rank, 0 AS k, p.path, r.shown AS h FROM ranked r JOIN paths p ON p.lang IS NOT DISTINCT FROM r.lang AND p.rank = r.rank
  UNION ALL SELECT lang, rank, k + 1, path, sha256(CASE WHEN path[k + 1].here = 1 THEN path[k + 1].other || h ELSE h || path[k + 1].other END) FROM fold WHERE k < len(path)
)
SELECT r.doc_id, r.leaf, s.h AS subroot, t.h AS root, sha256(array_to_string(list_transform(f.path, lambda x: x.other), '')) AS proof_sha256, f.h AS folded_root, f.h = t.h AS verified
FROM ranked r JOIN subroots s ON s.lang IS NOT DISTINCT FROM r.lang JOIN fold f ON f.lang IS NOT DISTINCT FROM r.lang AND f.rank = r.rank AND f.k = len(f.path)
CROSS JOIN (SELECT h FROM top WHERE n = 1) t
"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sampled_splitters": op1_sampled_splitters,
    "op2_ecoc_language": op2_ecoc_language,
    "op3_adaptive_scan": op3_adaptive_scan,
    "op4_chat_format": op4_chat_format,
    "op5_block_naming": op5_block_naming,
    "op6_streaming_viterbi": op6_streaming_viterbi,
    "op7_html_text": op7_html_text,
    "op8_gru_score": op8_gru_score,
    "op9_hamming_join": op9_hamming_join,
    "op10_tiered_packing": op10_tiered_packing,
    "op11_refined_whitening": op11_refined_whitening,
    "op12_sainte_lague": op12_sainte_lague,
    "op13_nested_rollup": op13_nested_rollup,
}
ORACLE_SQL: dict[str, str] = {"op4_chat_format": OP4_SQL, "op5_block_naming": OP5_SQL, "op9_hamming_join": OP9_SQL, "op12_sainte_lague": OP12_SQL, "op13_nested_rollup": OP13_SQL}
