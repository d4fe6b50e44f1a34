"""Driver queries of the training-data operators, one per operator."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from civgraph.llm import (
    chat, decontaminate, jaccard, merkle, mixing, neighbours, quality, runs, secrets, sharding, simple8b, substrings,
    topk)
from civgraph.llm.common import shared_folder, table


def word_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simple8b.token_digest(table(spark, sf_dir, "documents"), f"{shared_folder(spark)}/tokens", word_tokenizer())


def op2_chat_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.chat_digest(chat.with_probe(table(spark, sf_dir, "conversations")), f"{shared_folder(spark)}/chat",
                            word_tokenizer())


def op3_quality_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination_digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_repeated_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.repeat_digest(table(spark, sf_dir, "documents"))


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join_digest(table(spark, sf_dir, "documents"))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_digest(table(spark, sf_dir, "documents"))


def op8_stable_projections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % 50 == 0)


def op9_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_digest(table(spark, sf_dir, "documents"))


def op10_histogram_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_digest(table(spark, sf_dir, "documents"))


def op11_impact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top(table(spark, sf_dir, "embeddings"), 50)


def op12_grammar_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.run_digest(table(spark, sf_dir, "documents"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest_digest(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_token_output, op2_chat_tree, op3_quality_votes, op4_decontaminate, op5_repeated_spans, op6_ngram_join, op7_secret_scan,
    op8_stable_projections, op9_mix_sources, op10_histogram_shards, op11_impact_topk, op12_grammar_runs,
    op13_merkle_manifest)}

ORACLE = {
    "op4_decontaminate": r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS rid,
             regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
           FROM documents),
b AS (SELECT item_id,
             regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
      FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(len(w), 13) AS n, list_slice(w, pos, pos + least(len(w), 13) - 1) AS win
       FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS pos FROM b WHERE len(w) > 0)),
dw AS (SELECT rid, n, pos, list_slice(w, pos, pos + n - 1) AS win
       FROM (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS pos FROM d, (SELECT DISTINCT n FROM bw) WHERE len(w) >= n)),
h AS (SELECT dw.rid, dw.pos, dw.n, bw.item_id FROM dw JOIN bw ON dw.n = bw.n AND dw.win = bw.win),
p AS (SELECT rid, count(DISTINCT word) AS n_hit FROM (SELECT rid, unnest(range(pos, pos + n)) AS word FROM (SELECT DISTINCT rid, pos, n FROM h)) GROUP BY rid),
i AS (SELECT rid, count(item) AS n_items, string_agg(item, ',' ORDER BY item) AS items
      FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS item FROM h) GROUP BY rid)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(p.n_hit, 0) AS n_hit, coalesce(i.n_items, 0) AS n_items,
       sha256(coalesce(i.items, '')) AS items_sha256,
       coalesce(p.n_hit, 0) > 0 AND 20 * coalesce(p.n_hit, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN p USING (rid) LEFT JOIN i USING (rid)""",
    "op9_mix_sources": r"""
WITH d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         CAST(concat('0x', left(md5(concat('mix:', coalesce(CAST(doc_id AS VARCHAR), 'null'), ':', md5(coalesce(text, '')),
           CASE WHEN count(*) OVER (PARTITION BY doc_id, text, source) > 1
                THEN ':' || row_number() OVER (PARTITION BY doc_id, text, source) || ':' ELSE '' END)), 15)) AS BIGINT) AS key
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
r AS (SELECT *, (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 + 1 AS w, 3 * source_size AS c FROM s),
l AS (SELECT *, ((SELECT sum(source_size) FROM s) - coalesce(sum(c) OVER (ORDER BY c / w, encode(source) NULLS LAST
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
             / sum(w) OVER (ORDER BY c / w, encode(source) NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
      FROM r),
v AS (SELECT level FROM l WHERE level * w <= c ORDER BY c / w, level DESC LIMIT 1),
t AS (SELECT source, source_size, least(v.level * w, CAST(c AS DOUBLE)) AS target FROM r, v),
b AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS epochs FROM t),
k AS (SELECT source, key, CAST(sum(size) AS BIGINT) AS size,
             CAST(sum(sum(size)) OVER (PARTITION BY source ORDER BY key) AS BIGINT) AS upto
      FROM d GROUP BY source, key)
SELECT d.doc_id, d.size, b.source_size, b.target,
       d.size * (b.epochs + CASE WHEN k.upto - k.size / 2 <= b.target - b.epochs * b.source_size THEN 1 ELSE 0 END) AS taken
FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source
JOIN k ON k.source IS NOT DISTINCT FROM d.source AND k.key = d.key""",
    "op11_impact_topk": r"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS w FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.w, c.w) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.w) = len(c.w))
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY rank <= 5""",
    "op13_merkle_manifest": r"""
WITH RECURSIVE crc AS (
  SELECT rid, xor(4294967295, list_reduce([4294967295] || list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT)),
           lambda c, b: list_reduce([xor(c, b)] || range(8), lambda x, i: xor(x >> 1, 3988292384 * (x & 1))))) AS crc
  FROM (SELECT row_number() OVER () AS rid, doc_id FROM documents) WHERE doc_id IS NOT NULL),
f AS (
  SELECT row_number() OVER () AS rid, doc_id, source, text,
         coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
           || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS head
  FROM documents),
leaves AS (
  SELECT f.rid, doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
         CASE WHEN crc % 5 = 0 THEN sha256(head || coalesce(strlen(text) || ':' ||
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-')) END AS now
  FROM f LEFT JOIN crc USING (rid)),
placed AS (
  SELECT *, dense_rank() OVER (ORDER BY encode(source) NULLS FIRST) AS tree,
         row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
         count(*) OVER (PARTITION BY source) AS n FROM leaves),
low(tree, level, pos, n, hash) AS (
  SELECT tree, 0, pos, n, leaf FROM placed
  UNION ALL
  SELECT tree, level + 1, pos // 16, (n + 15) // 16, sha256(string_agg(hash, '' ORDER BY pos)) FROM low WHERE n > 1 GROUP BY tree, level, pos // 16, n),
subroots AS (SELECT tree, hash, tree - 1 AS pos, count(*) OVER () AS n FROM low WHERE n = 1),
high(level, pos, n, hash) AS (
  SELECT 0, pos, n, hash FROM subroots
  UNION ALL
  SELECT level + 1, pos // 16, (n + 15) // 16, sha256(string_agg(hash, '' ORDER BY pos)) FROM high WHERE n > 1 GROUP BY level, pos // 16, n),
nodes AS (
  SELECT tree, level, pos, n, hash FROM low WHERE n > 1
  UNION ALL SELECT 0, level, pos, n, hash FROM high WHERE n > 1),
steps AS (
  SELECT rid, 0 AS tier, level, tree, p.pos // CAST(pow(16, level) AS BIGINT) AS own
  FROM placed p JOIN (SELECT DISTINCT tree, level FROM nodes) l USING (tree)
  UNION ALL
  SELECT rid, 1, level, 0, (p.tree - 1) // CAST(pow(16, level) AS BIGINT) FROM placed p, (SELECT DISTINCT level FROM nodes WHERE tree = 0)),
runs AS (
  SELECT rid, row_number() OVER (PARTITION BY rid ORDER BY tier, s.level) AS step,
         coalesce(string_agg(hash, '' ORDER BY pos) FILTER (WHERE pos < own), '') AS before,
         coalesce(string_agg(hash, '' ORDER BY pos) FILTER (WHERE pos > own), '') AS after
  FROM steps s JOIN nodes k ON k.tree = s.tree AND k.level = s.level AND k.pos // 16 = own // 16 GROUP BY rid, tier, s.level),
fold(rid, step, hash) AS (
  SELECT rid, 0, coalesce(now, leaf) FROM placed
  UNION ALL
  SELECT fold.rid, runs.step, sha256(before || hash || after) FROM fold JOIN runs ON runs.rid = fold.rid AND runs.step = fold.step + 1),
proofs AS (SELECT rid, string_agg(before || after, '' ORDER BY step) AS proof FROM runs GROUP BY rid),
root AS (SELECT hash AS root FROM high WHERE n = 1)
SELECT doc_id, leaf, s.hash AS subroot, root, sha256(coalesce(proof, '')) AS proof_sha256,
       folded.hash AS folded_root, folded.hash = root AS verified
FROM placed p JOIN subroots s USING (tree) LEFT JOIN proofs USING (rid) CROSS JOIN root
JOIN (SELECT rid, arg_max(hash, step) AS hash FROM fold GROUP BY rid) folded USING (rid)""",
}
