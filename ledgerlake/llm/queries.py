"""The registered queries of this subpackage, one per operator, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline

from . import digests, html_wrappers, license_scan, line_dedup, merge_dropout, ngram_join, packing, periodic_runs, pii_crf
from . import prefix_trie, quality_rules, simhash, toxicity
from .common import SPACE_PATTERN, read


def op3_wrapper_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_wrappers.extract(read(spark, sf_dir, "pages"))


def op4_host_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_rules.assess(read(spark, sf_dir, "documents"))
    return out.select("doc_id", *quality_rules.STAT_COLUMNS, "base_failed", "kept", "host_verdict")


def op1_partenum_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_groups(read(spark, sf_dir, "documents"))


def op2_cost_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = packing.pack(read(spark, sf_dir, "documents"))
    return out.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op5_crf_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_crf.detect(read(spark, sf_dir, "documents"))


def op6_feature_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests.digests(read(spark, sf_dir, "documents"))


def op7_gru_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op8_patience_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.remove_repeats(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select(
        "doc_id", F.array_join("deleted_lines", ",").alias("deleted"), F.size("deleted_lines").alias("n_deleted"), "text"
    )


def op9_merge_dropout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode, then decode the pieces again: the decoded text's hash is that of the text."""
    back = merge_dropout.decode(merge_dropout.encode(read(spark, sf_dir, "documents")))
    return back.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_pieces"),
        F.xxhash64("ids").alias("ids_hash"),
        F.length("text").cast("long").alias("decoded_chars"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )


def op10_patience_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(read(spark, sf_dir, "documents"))


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """``docs`` in which every tenth id's words repeat from some place on (the contract of op11)."""
    words = F.array_remove(F.split(F.coalesce("text", F.lit("")), SPACE_PATTERN), "")
    n = F.size(words).cast("long")
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)
    a = g % F.greatest(n, F.lit(1))
    p = F.lit(1) + F.floor((n - a) / (3 + g % 8))
    again = F.flatten(F.array_repeat(F.slice(words, (a + 1).cast("int"), p.cast("int")), F.ceil((n - a) / p).cast("int")))
    planted = F.concat(F.slice(words, F.lit(1), a.cast("int")), F.slice(again, F.lit(1), (n - a).cast("int")))
    text = F.when((h % 10 == 0) & (n > 0), F.array_join(planted, " ")).otherwise(F.col("text"))
    return docs.select("doc_id", text.alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.periodic_runs(with_planted_runs(read(spark, sf_dir, "documents")))
    best = F.array_max(
        F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period")))
    )
    line = lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.start")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"),
        F.floor(1000 * F.col("best.length") / -F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = prefix_trie.trie(prefix_trie.branched(read(spark, sf_dir, "conversations")))
    return nodes.drop("node", "parent")


def op13_simhash_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_groups(read(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_partenum_join": op1_partenum_join,
    "op2_cost_packing": op2_cost_packing,
    "op3_wrapper_text": op3_wrapper_text,
    "op4_host_quality": op4_host_quality,
    "op5_crf_pii": op5_crf_pii,
    "op6_feature_digest": op6_feature_digest,
    "op7_gru_toxicity": op7_gru_toxicity,
    "op8_patience_line_dedup": op8_patience_line_dedup,
    "op9_merge_dropout": op9_merge_dropout,
    "op10_patience_licenses": op10_patience_licenses,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_simhash_tiles": op13_simhash_tiles,
    "pipeline": corpus_pipeline.run,
}

#: DuckDB forms; an operator that SQL cannot express has none and is tested by brute force.
ORACLE: dict[str, str] = {
    "op4_host_quality": r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT rid, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
  FROM d
), tri AS (
  SELECT rid, unnest(list_transform(range(1, len(ws) - 1), lambda i: [ws[i], ws[i + 1], ws[i + 2]])) AS g,
         unnest(range(1, len(ws) - 1)) AS p
  FROM w WHERE len(ws) >= 3
), marked AS (
  SELECT rid, p FROM (SELECT rid, p, count(*) OVER (PARTITION BY rid, g) AS c FROM tri) WHERE c >= 2
), rep AS (
  SELECT rid, count(DISTINCT q) AS n_repeat_words
  FROM (SELECT rid, unnest([p, p + 1, p + 2]) AS q FROM marked) GROUP BY rid
), s AS (
  SELECT d.doc_id, d.source, CAST(len(w.ws) AS BIGINT) AS n_words,
         CAST(length(array_to_string(w.ws, '')) AS BIGINT) AS word_chars,
         CAST(length(d.t) - length(regexp_replace(d.t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(w.ls) - len(list_distinct(w.ls)) AS BIGINT) AS n_dup_lines,
         CAST(len(w.ls) AS BIGINT) AS n_lines,
         coalesce(rep.n_repeat_words, 0) AS n_repeat_words
  FROM d JOIN w USING (rid) LEFT JOIN rep USING (rid)
), f AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
         n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR 100 * n_symbols > 50 * n_words
           OR 100 * n_dup_lines > 30 * n_lines OR word_chars < 2.0 * n_words OR word_chars > 15.0 * n_words AS any_failed
  FROM s
), h AS (
  SELECT source, count(*) AS n, count(*) FILTER (any_failed) AS x FROM f WHERE source IS NOT NULL GROUP BY source
), t AS (
  SELECT count(*) AS k, sum(n) AS n, sum(x) AS x, sum(x * x / n) AS q, sum(1 / n) AS inv FROM h
), m AS (
  SELECT *, x / n AS mean, (x / n) * (1 - x / n) AS var,
         CASE WHEN k > 1 THEN k * (q - n * (x / n) * (x / n)) / ((k - 1) * n) END AS spread FROM t
), p AS (
  SELECT mean, CASE WHEN k > 1 AND var > 0 AND spread - var * inv / k > 0
                    THEN least(1e6, greatest(0.0, (var - spread) / (spread - var * inv / k))) ELSE 1e6 END AS strength
  FROM m
), v AS (
  SELECT source, CASE WHEN (x + mean * strength) / (n + strength) > 0.9 THEN 'reject'
                      WHEN (x + mean * strength) / (n + strength) > 0.5 THEN 'suspect' ELSE 'pass' END AS verdict
  FROM h, p
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND (coalesce(verdict, 'none') IN ('pass', 'none')
                            OR (verdict = 'suspect' AND NOT any_failed)) AS kept,
       coalesce(verdict, 'none') AS host_verdict
FROM f LEFT JOIN v USING (source)
""",
    "op12_prefix_trie": r"""
WITH own AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id
           ORDER BY turn NULLS FIRST, role, sha256(length(role) || ':' || role || text)) AS pos, role, text
  FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations)
  WHERE conv_id IS NOT NULL
), c AS (
  SELECT conv_id, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT),
           list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
           lambda a, b: list_reduce(list_prepend(xor(a, b), list_transform(range(8), lambda i: CAST(i AS BIGINT))),
             lambda u, i: CASE WHEN u & 1 = 1 THEN xor(u >> 1, CAST(3988292384 AS BIGINT)) ELSE u >> 1 END)),
           CAST(4294967295 AS BIGINT)) % 4 AS h
  FROM (SELECT DISTINCT conv_id FROM own)
), r AS (
  SELECT c.conv_id, 0 AS part, o.pos, o.role, o.text
  FROM c JOIN own o ON o.conv_id = c.conv_id - c.conv_id % 20 AND o.pos <= c.h
  UNION ALL
  SELECT c.conv_id, 1, o.pos, o.role, o.text FROM c JOIN own o ON o.conv_id = c.conv_id AND o.pos > c.h
), prefix AS (
  SELECT conv_id, row_number() OVER w AS depth, string_agg(md5(length(role) || ':' || role || text), '') OVER w AS path,
         len(list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '')) AS words,
         lead(conv_id) OVER w IS NULL AS ended
  FROM r WINDOW w AS (PARTITION BY conv_id ORDER BY part, pos)
  UNION ALL
  SELECT conv_id, 0, '', 0, conv_id NOT IN (SELECT conv_id FROM r) FROM c
), n AS (
  SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words,
         sha256(coalesce(string_agg(CASE WHEN ended THEN CAST(conv_id AS VARCHAR) END, ',' ORDER BY conv_id), '')) AS ends_sha256
  FROM prefix GROUP BY path, depth
), k AS (
  SELECT p.path, count(q.path) AS n_children FROM n p LEFT JOIN n q ON q.depth = p.depth + 1 AND starts_with(q.path, p.path)
  GROUP BY p.path
), sub AS (
  SELECT p.path, count(*) FILTER (k.n_children = 0) AS n_leaves, sum((q.n_convs - 1) * q.words) AS saved_tokens
  FROM n p JOIN n q ON starts_with(q.path, p.path) JOIN k ON k.path = q.path GROUP BY p.path
)
SELECT n.conv_id, n.depth, u.conv_id AS parent_conv_id, n.n_convs, k.n_children, sub.n_leaves,
       CAST(sub.saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
FROM n JOIN k USING (path) JOIN sub USING (path)
LEFT JOIN n u ON u.depth = n.depth - 1 AND u.path = left(n.path, 32 * (CAST(n.depth AS INTEGER) - 1))
""",
}
