"""Registered queries of the subpackage and their DuckDB twins. Each query
applies its operator, with production parameters, to the whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline

from . import (op1_token_counts, op2_quality, op3_toxicity, op4_bpe, op5_exact_dedup, op6_sharding, op7_pii, op8_jaccard_join, op9_passages,
               op10_mixing, op11_codes, op12_search, op13_minhash)
from .common import documents, tokenizer


def op1_token_counts_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unigram token counts of every document."""
    return op1_token_counts.token_counts(documents(spark, sf_dir), tokenizer("piece_bpe_32k.model"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality rules: base counts, base_failed, kept and the broken rules."""
    out = op2_quality.quality(documents(spark, sf_dir))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
                      F.array_join("failed", ",").alias("failed"))


def op3_toxicity_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document; labels outside the held-out fold teach."""
    return op3_toxicity.toxicity(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op4_bpe_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """BPE ids and decoded text of every document, as digests."""
    out = op4_bpe.encode(documents(spark, sf_dir), tokenizer("word_bpe_49k.json"))
    return out.select("doc_id", *op4_bpe.digests(F.col("ids"), F.col("decoded")))


def op5_exact_dedup_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact duplicates: one row per document with the row that stays."""
    return op5_exact_dedup.dedup(documents(spark, sf_dir)).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op6_sharding_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sharding on the bounded-load ring; counts are at most one apart."""
    return op6_sharding.shard(documents(spark, sf_dir), 8).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op7_pii_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data: base spans and those that bootstrapping adds."""
    return op7_pii.digest(op7_pii.personal_data(documents(spark, sf_dir)))


def op8_jaccard_join_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of every document."""
    return op8_jaccard_join.join(documents(spark, sf_dir))


def op9_passages_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fuzzy passages that documents share."""
    return op9_passages.passages(documents(spark, sf_dir))


def op10_mixing_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mixing sources to target weights."""
    return op10_mixing.mix(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


def op11_codes_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of all vectors, by ball k-means."""
    out = op11_codes.compress(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return out.select("vec_id", op11_codes.hex_code(F.col("code")).alias("code"), "error", "label_error", "codebooks_sha256")


def op12_search_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best documents of every benchmark item."""
    return op12_search.search(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op13_minhash_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts."""
    return op13_minhash.edited(documents(spark, sf_dir))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five stages of corpus_pipeline, one after another."""
    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    "op1_token_counts": op1_token_counts_query,
    "op2_quality_rules": op2_quality_rules,
    "op3_toxicity": op3_toxicity_query,
    "op4_bpe": op4_bpe_query,
    "op5_exact_dedup": op5_exact_dedup_query,
    "op6_sharding": op6_sharding_query,
    "op7_pii": op7_pii_query,
    "op8_jaccard_join": op8_jaccard_join_query,
    "op9_passages": op9_passages_query,
    "op10_mixing": op10_mixing_query,
    "op11_codes": op11_codes_query,
    "op12_search": op12_search_query,
    "op13_minhash": op13_minhash_query,
    "pipeline": pipeline,
}

ORACLE = {
    "op2_quality_rules": r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
win AS (
  SELECT r, i, array_to_string(ws[i:(i + 7)], ' ') AS w FROM (SELECT r, ws, unnest(range(1, greatest(len(ws) - 6, 1))) AS i FROM d)),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, w) AS n FROM win) WHERE n > 1),
rep AS (SELECT r, sum(least(8, coalesce(next - i, 8)))::BIGINT AS n FROM (SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS next FROM twice) GROUP BY r),
c AS (
  SELECT doc_id, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars, len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols,
    len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words, len(lines) AS n_lines,
    length(regexp_replace(t, '\P{L}+', '', 'g')) AS letters, length(regexp_replace(t, '\P{Lu}+', '', 'g')) AS capitals,
    len(list_filter(ws, lambda x: regexp_matches(x, '\p{L}'))) AS lettered, len(list_filter(ws, lambda x: ends_with(x, '!'))) AS shouted,
    len(list_filter(ws, lambda x: list_contains(string_split('a an and are as at be by for from have he his in is it of on or that the this to was were with als auch auf das dem den der des die ein eine es für im ist mit nicht sich sie und von zu au avec ce dans de du elle en est et il la le les ne par pas pour que qui sur un une al como con del el las lo los más no para por se su una y', ' '),
      regexp_replace(lower(x), '[^\p{L}]+', '', 'g')))) AS stops,
    len(list_filter(lines, lambda x: regexp_matches(x, '(\.\.\.|…) *$'))) AS ellipses, len(list_distinct(ws)) AS kinds
  FROM d LEFT JOIN rep USING (r)),
j AS (
  SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
    concat_ws(',',
      CASE WHEN n_words >= 20 AND (word_chars / n_words < 2.0 OR word_chars / n_words > 14.0) THEN 'mean_word_len' END,
      CASE WHEN n_words > 0 AND n_symbols / n_words > 0.2 THEN 'symbols_per_word' END,
      CASE WHEN n_words >= 20 AND lettered / n_words < 0.7 THEN 'letter_word_share' END,
      CASE WHEN n_words >= 20 AND letters > 0 AND capitals / letters > 0.5 THEN 'capital_share' END,
      CASE WHEN n_words >= 20 AND shouted / n_words > 0.3 THEN 'shout_share' END,
      CASE WHEN n_words >= 50 AND stops / n_words < 0.04 THEN 'stop_word_share' END,
      CASE WHEN n_lines > 0 AND n_dup_lines / n_lines > 0.5 THEN 'dup_line_share' END,
      CASE WHEN n_words >= 20 AND n_lines > 0 AND ellipses / n_lines > 0.5 THEN 'ellipsis_line_share' END,
      CASE WHEN n_words >= 50 AND kinds / n_words < 0.15 THEN 'distinct_word_share' END) AS failed
  FROM c)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND failed = '' AS kept, failed FROM j
""",
    "op5_exact_dedup": r"""
WITH d AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = min(doc_id) OVER g AS kept, text_sha256
FROM d WINDOW g AS (PARTITION BY text_sha256)
""",
    "op8_jaccard_join": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS MATERIALIZED (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:(i + 4)], ' '))) END AS sh FROM w),
g AS MATERIALIZED (SELECT doc_id, len(sh) AS n, unnest(sh) AS g FROM s),
links AS MATERIALIZED (
  SELECT a.doc_id AS x, b.doc_id AS y FROM g a JOIN g b ON a.g = b.g AND a.doc_id <> b.doc_id
  WHERE 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
reach AS (SELECT x AS doc_id, x AS other FROM links UNION SELECT r.doc_id, y FROM reach r JOIN links ON x = r.other)
SELECT s.doc_id, len(sh)::BIGINT AS n_shingles, least(s.doc_id, min(other)) AS component_id
FROM s LEFT JOIN reach USING (doc_id) GROUP BY s.doc_id, sh
""",
    "op11_codes": r"""
WITH kept AS (
  SELECT row_number() OVER () AS r, vec_id, label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS (
  SELECT r, vec_id, label, p, v[(p * (len(v) // 16) + 1):((p + 1) * (len(v) // 16))] AS x FROM kept, range(16) AS ps(p)),
firsts AS (SELECT r, row_number() OVER (ORDER BY vec_id, v) - 1 AS e FROM kept ORDER BY vec_id, v LIMIT 64),
c0 AS MATERIALIZED (SELECT p, e, x AS c FROM parts JOIN firsts USING (r)),
a0 AS MATERIALIZED (
  SELECT r, p, min(list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) * 64 + e) % 64 AS e
  FROM parts JOIN c0 USING (p) GROUP BY r, p),
m0 AS (
  SELECT p, e, list(m ORDER BY i) AS c FROM (
    SELECT p, e, i, floor(sum(x[i]) / count(*))::BIGINT AS m FROM parts JOIN a0 USING (r, p), range(1, 257) AS ix(i) WHERE i <= len(x) GROUP BY p, e, i)
  GROUP BY p, e),
c1 AS MATERIALIZED (SELECT p, e, coalesce(m0.c, c0.c) AS c FROM c0 LEFT JOIN m0 USING (p, e)),
a1 AS MATERIALIZED (
  SELECT r, p, min(list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) * 64 + e) % 64 AS e
  FROM parts JOIN c1 USING (p) GROUP BY r, p),
m1 AS (
  SELECT p, e, list(m ORDER BY i) AS c FROM (
    SELECT p, e, i, floor(sum(x[i]) / count(*))::BIGINT AS m FROM parts JOIN a1 USING (r, p), range(1, 257) AS ix(i) WHERE i <= len(x) GROUP BY p, e, i)
  GROUP BY p, e),
c2 AS MATERIALIZED (SELECT p, e, coalesce(m1.c, c1.c) AS c FROM c1 LEFT JOIN m1 USING (p, e)),
a2 AS MATERIALIZED (
  SELECT r, vec_id, label, p, min(list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) * 64 + e) AS d
  FROM parts JOIN c2 USING (p) GROUP BY r, vec_id, label, p),
coded AS (
  SELECT r, vec_id, label, string_agg(lower(printf('%02x', d % 64)), '' ORDER BY p) AS code, sum(d // 64)::BIGINT AS error
  FROM a2 GROUP BY r, vec_id, label)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
  (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) FROM c2) AS codebooks_sha256
FROM coded
""",
    "op12_search": r"""
WITH d AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents),
n AS (SELECT doc_id, count(*) AS n FROM d GROUP BY doc_id),
s AS (SELECT count(*) AS big_n, sum(n)::BIGINT AS big_l FROM n),
q AS (
  SELECT item_id, term, count(*) AS times FROM (
    SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark)
  GROUP BY item_id, term),
f AS (SELECT doc_id, term, count(*) AS tf FROM d WHERE term IN (SELECT term FROM q) GROUP BY doc_id, term),
w AS (SELECT term, floor(1000 * ln((2 * any_value(big_n) + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM f, s GROUP BY term),
i AS (
  SELECT f.doc_id, f.term, w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * big_n) // big_l))) AS impact
  FROM f JOIN w USING (term) JOIN n USING (doc_id), s),
r AS (SELECT item_id, doc_id, sum(times * impact)::BIGINT AS score FROM q JOIN i USING (term) GROUP BY item_id, doc_id)
SELECT * FROM (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score FROM r WHERE score > 0)
WHERE rank <= 20
""",
}
