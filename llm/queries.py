"""The registered queries of this package: thin calls of its operators, and their SQL twins."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm import byte_bpe, conversation_trie, filter_audit, jaccard_join, kd_topk, license_scan, source_mix, spot_signatures
from llm import token_counts, token_files, toxicity, url_filter, warc_chunks
from shelf.staging import stage, stage_path

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
WORDS = public_tokenizers.path("word_bpe_49k.json")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = toxicity.score(docs.select("doc_id", "lang", "text"), model)
    return scored.select(
        "doc_id", toxicity.held_out().alias("held_out"), "score", "predicted", "threshold", "flagged"
    )


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = stage_path(spark, "token-files")
    token_files.write_token_files(documents(spark, sf_dir), folder, WORDS)
    read = token_files.read_token_files(spark, folder)
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op3_spot_signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spot_signatures.compare_edits(documents(spark, sf_dir))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return license_scan.train(docs).scan(docs)


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(documents(spark, sf_dir))


def op6_warc_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = stage_path(spark, "warc")
    warc_chunks.write_archives(spark.read.parquet(f"{sf_dir}/pages.parquet"), path)
    return warc_chunks.read_archives(spark, path)


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = stage(token_counts.trees(documents(spark, sf_dir), RANKS), "token-trees")
    edited = token_counts.apply_edits(token_counts.self_edits(kept), RANKS)
    return edited.drop("text", "chars", "tokens")


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    done = byte_bpe.decode(byte_bpe.encode(docs, RANKS).select("doc_id", "n_tokens", "ids"), RANKS)
    return done.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op9_kd_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = kd_topk.whole_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return kd_topk.top_k(vectors, vectors.where("vec_id % 50 = 0"), 5)


def op10_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_mix.mix(source_mix.sized(documents(spark, sf_dir)))


URL_RULES = [
    url_filter.Rule(url_filter.BLOCK, "net", "/"), url_filter.Rule(url_filter.ALLOW, "example.net", "/en/"),
    url_filter.Rule(url_filter.BLOCK, "example.com", "/de/"), url_filter.Rule(url_filter.ALLOW, "org", "/fr/"),
]


def op11_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The URLs that the rules decide are the labelled table for the others."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    model = url_filter.train(url_filter.ruled(pages.select("url"), URL_RULES))
    return url_filter.judge(pages, URL_RULES, model)


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie.trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_toxicity, op2_token_files, op3_spot_signatures, op4_license_scan, op5_jaccard_join,
        op6_warc_chunks, op7_token_counts, op8_byte_bpe,
        op9_kd_topk, op10_source_mix, op11_url_filter, op12_conversation_trie, op13_filter_audit,
    )
}

# DuckDB twins, where SQL can state the result.
_BASE32 = """array_to_string(list_transform(range(8), lambda g:
  array_to_string(list_transform(range(4), lambda c: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    CAST((CAST('0x' || substr(h, CAST(g * 5 + 1 AS INT), 5) AS BIGINT) >> CAST(15 - 5 * c AS INT)) & 31 AS INT) + 1, 1)), '')), '')"""
SQL: dict[str, str] = {
    "op6_warc_chunks": f"""
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages),
f AS (SELECT *, max(page_id) OVER (PARTITION BY h) AS best FROM p)
SELECT page_id, payload_bytes, {_BASE32} AS payload_digest,
  CASE WHEN page_id = best THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = best THEN NULL ELSE best END AS refers_to
FROM f""",
    "op9_kd_topk": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id AND len(c.v) = len(q.v) WHERE q.vec_id % 50 = 0
), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM s)
SELECT query_id, CAST(n AS INTEGER) AS "rank", vec_id, score FROM r WHERE n <= 5""",
    "op12_conversation_trie": r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
), o AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role,
    sha256(length(role) || ':' || role || text)) AS n FROM t
), c AS (
  SELECT conv_id, list_reduce(list_transform(split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT)),
    lambda crc, byte: list_reduce([1, 2, 3, 4, 5, 6, 7, 8]::BIGINT[],
      lambda v, i: xor(v >> 1, (v & 1) * 3988292384), xor(crc, byte)), 4294967295::BIGINT) AS crc
  FROM (SELECT DISTINCT conv_id FROM t)
), h AS (SELECT conv_id, xor(crc, 4294967295::BIGINT) % 4 AS h FROM c),
r AS (
  SELECT h.conv_id, o.n, o.role, o.text FROM h JOIN o ON o.conv_id = h.conv_id - h.conv_id % 20 AND o.n <= h.h
  UNION ALL
  SELECT h.conv_id, o.n + 1000000, o.role, o.text FROM h JOIN o ON o.conv_id = h.conv_id AND o.n > h.h
), p AS (
  SELECT conv_id, list(sha256(length(role) || ':' || role || text) ORDER BY n) AS path,
    list(CAST(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS BIGINT) ORDER BY n) AS words
  FROM r GROUP BY conv_id
), w AS (
  SELECT h.conv_id, coalesce(path, []) AS path, coalesce(words, []) AS words FROM h LEFT JOIN p USING (conv_id)
), m AS (
  SELECT conv_id, d AS depth, array_to_string(path[1:d], '') AS node, array_to_string(path[1:d - 1], '') AS above,
    CASE WHEN d = 0 THEN 0 ELSE words[d] END AS words, d = len(path) AS ends
  FROM (SELECT *, unnest(range(len(path) + 1)) AS d FROM w)
), g AS (
  SELECT node, depth, any_value(above) AS above, min(conv_id) AS conv_id, count(*) AS n, any_value(words) AS words,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM m GROUP BY node, depth
), k AS (
  SELECT g.*, (SELECT count(*) FROM g x WHERE x.above = g.node AND x.depth = g.depth + 1) AS n_children FROM g
), s AS (
  SELECT k.node, k.n, k.words, k.n_children, unnest(range(k.depth + 1)) AS d FROM k
), u AS (
  SELECT substr(node, 1, CAST(64 * d AS INT)) AS top, CAST(sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_leaves,
    CAST(sum((n - 1) * words) AS BIGINT) AS saved_tokens
  FROM s GROUP BY 1
)
SELECT k.conv_id, CAST(k.depth AS BIGINT) AS depth, a.conv_id AS parent_conv_id, k.n AS n_convs, k.n_children, u.n_leaves,
  u.saved_tokens, k.ends_sha256
FROM k JOIN u ON u.top = k.node LEFT JOIN g a ON a.node = k.above AND a.depth = k.depth - 1""",
    "op13_filter_audit": r"""
WITH l AS (
  SELECT doc_id, bool_or(quality IS NOT DISTINCT FROM 1) AS good, bool_or(toxic IS NOT DISTINCT FROM 1) AS toxic FROM labels GROUP BY doc_id
), t AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents),
w AS (
  SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words, min(doc_id) OVER (PARTITION BY text) AS least FROM t
), m AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
    [len(words) < 50, 100 * len(list_distinct(words)) < 65 * len(words),
     100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text),
     regexp_matches(text, '[#$%&*|]'), coalesce(w.doc_id > least, false)] AS f
  FROM w LEFT JOIN l USING (doc_id)
), c AS (
  SELECT part, list_sum(list_transform(range(5), lambda i: CASE WHEN f[i + 1] THEN 1 << CAST(i AS INT) ELSE 0 END)) AS mask,
    count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
  FROM m GROUP BY ALL
), a AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM a, a b, a c, a d, a e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
), s AS (
  SELECT filter_order, CAST(k AS INTEGER) AS step, 1 << CAST(ascii(filter_order[k]) - 65 AS INT) AS own,
    coalesce(list_sum(list_transform(range(1, k), lambda j: 1 << CAST(ascii(filter_order[j]) - 65 AS INT))), 0) AS earlier
  FROM (SELECT *, unnest(range(1, 6)) AS k FROM o)
), r AS (
  SELECT part, filter_order, step, own,
    sum(CASE WHEN mask & (own | earlier) = 0 THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN mask & own <> 0 AND mask & earlier = 0 THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN mask & own <> 0 AND mask & earlier <> 0 THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN mask = own THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN mask & own <> 0 AND mask & earlier = 0 THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN mask & own <> 0 AND mask & earlier = 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM c, s GROUP BY part, filter_order, step, own
)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
  CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM r""",
}
