"""The registered queries of the operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palaver.llm.blocks import documents
from palaver.llm.sql import prefix_trie_sql, sort_means_sql


def op1_pu_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from palaver.llm.pu_quality import classify

    return classify(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from palaver.llm.line_dedup import line_report

    return line_report(documents(spark, sf_dir), min_chars=40, min_docs=5)


def op3_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    from palaver.llm.repeats import remove_repeats

    gone = F.aggregate("removed", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["begin"])
    cut = remove_repeats(documents(spark, sf_dir)).select("doc_id", gone.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"), "kept")
    n_bytes = (F.octet_length("kept") + F.col("n_removed")).cast("long")
    return cut.select("doc_id", n_bytes.alias("n_bytes"), "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from palaver.llm.fingerprints import with_neighbours

    return with_neighbours(documents(spark, sf_dir))


def op5_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from palaver.llm.near_dup import classes

    return classes(documents(spark, sf_dir)).select("doc_id", "class_id", "n_links")


def op6_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from palaver.llm.mixing import mix

    return mix(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


def vocabulary() -> tuple[str, str]:
    """The rank file and the split pattern that the queries use."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from palaver.llm.bpe import encode

    both = encode(documents(spark, sf_dir).select("doc_id", "text"), *vocabulary(), decoded="decoded")
    n = F.floor(F.octet_length("ids") / 4).cast("long")
    return both.select("doc_id", n.alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from palaver.llm.quality_rules import judge

    judged = judge(documents(spark, sf_dir))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "bits", "low", "high")


def op9_backoff_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    from palaver.llm.backoff import scores

    return scores(documents(spark, sf_dir)).select("doc_id", "n_words", "score", F.round("per_word", 6).alias("per_word"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of every document before and after three edits, from its tree."""
    from palaver.llm.token_counts import apply_edits, build, three_edits

    trees = build(three_edits(documents(spark, sf_dir).select("doc_id", "text")), *vocabulary())
    done = apply_edits(trees, *vocabulary())
    n = F.size("leaf_tokens").cast("long")
    return done.select("doc_id", "n_before", "n_after", n.alias("n_pretokens"), "n_encoded", F.sha2(F.encode("text", "UTF-8"), 256).alias("edited_sha256"))


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from palaver.llm.toxicity import classify

    return classify(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op12_sort_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    from palaver.llm.sort_means import cluster_report

    return cluster_report(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from palaver.llm.prefix_trie import trie_report

    return trie_report(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pu_quality": op1_pu_quality,
    "op2_line_dedup": op2_line_dedup,
    "op3_repeats": op3_repeats,
    "op4_fingerprints": op4_fingerprints,
    "op5_near_dup": op5_near_dup,
    "op6_source_mixing": op6_source_mixing,
    "op7_byte_bpe": op7_byte_bpe,
    "op8_quality_rules": op8_quality_rules,
    "op9_backoff_scores": op9_backoff_scores,
    "op10_token_counts": op10_token_counts,
    "op11_toxicity": op11_toxicity,
    "op12_sort_means": op12_sort_means,
    "op13_prefix_trie": op13_prefix_trie,
}

ORACLE: dict[str, str] = {
    "op12_sort_means": sort_means_sql(),
    "op13_prefix_trie": prefix_trie_sql(),
    "op2_line_dedup": r"""
WITH lines AS (
  SELECT doc_id, u.i AS pos, string_split(coalesce(text, ''), chr(10))[u.i] AS line
  FROM documents, LATERAL (SELECT unnest(range(1, len(string_split(coalesce(text, ''), chr(10))) + 1)) AS i) u
), keyed AS (
  SELECT doc_id, pos, line,
         translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines
), repeated AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT doc_id) >= 5
), judged AS (
  SELECT k.doc_id, k.pos, k.line, (r.key IS NOT NULL AND k.doc_id <> r.keeper) AS gone
  FROM keyed k LEFT JOIN repeated r ON k.key = r.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id""",
    "op9_backoff_scores": r"""
WITH words AS (
  SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS pos
  FROM (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents)
), total AS (SELECT count(*)::DOUBLE AS n FROM words),
one AS (SELECT doc_id, word AS gram, count(*) AS n FROM words GROUP BY ALL),
pairs AS (
  SELECT b.doc_id, a.word || ' ' || b.word AS gram, a.word AS context, b.word AS suffix, count(*) AS n
  FROM words a JOIN words b ON a.doc_id = b.doc_id AND a.pos + 1 = b.pos GROUP BY ALL
), triples AS (
  SELECT c.doc_id, a.word || ' ' || b.word || ' ' || c.word AS gram, a.word || ' ' || b.word AS context, b.word || ' ' || c.word AS suffix, count(*) AS n
  FROM words a JOIN words b ON a.doc_id = b.doc_id AND a.pos + 1 = b.pos JOIN words c ON b.doc_id = c.doc_id AND b.pos + 1 = c.pos GROUP BY ALL
),
k1 AS (SELECT gram, sum(n)::DOUBLE AS n FROM one GROUP BY gram HAVING count(*) > 1),
k2 AS (SELECT gram, any_value(context) AS context, any_value(suffix) AS suffix, sum(n)::DOUBLE AS n FROM pairs GROUP BY gram HAVING count(*) > 1),
k3 AS (SELECT gram, any_value(context) AS context, any_value(suffix) AS suffix, sum(n)::DOUBLE AS n FROM triples GROUP BY gram HAVING count(*) > 1),
f1 AS (SELECT gram, ln(k1.n) AS c, ln(k1.n) - ln(total.n) AS f, ln(k1.n) - ln(0.4::DOUBLE) AS weight FROM k1, total),
f2 AS (
  SELECT k2.gram, ln(k2.n) AS c, ln(k2.n) - x.c AS f, (ln(k2.n) - x.c) - y.f - ln(0.4::DOUBLE) AS weight
  FROM k2 JOIN f1 x ON k2.context = x.gram JOIN f1 y ON k2.suffix = y.gram
), f3 AS (
  SELECT k3.gram, (ln(k3.n) - x.c) - y.f - ln(0.4::DOUBLE) AS weight
  FROM k3 JOIN f2 x ON k3.context = x.gram JOIN f2 y ON k3.suffix = y.gram
), sums AS (
  SELECT doc_id, sum(n * floor(weight * 1000000 + 0.5)::BIGINT)::BIGINT AS s FROM (
    SELECT doc_id, n, weight FROM one JOIN f1 USING (gram)
    UNION ALL SELECT doc_id, n, weight FROM pairs JOIN f2 USING (gram)
    UNION ALL SELECT doc_id, n, weight FROM triples JOIN f3 USING (gram)
  ) GROUP BY doc_id
), sized AS (SELECT d.doc_id, count(w.word) AS n_words FROM documents d LEFT JOIN words w ON d.doc_id = w.doc_id GROUP BY d.doc_id),
scored AS (
  SELECT z.doc_id, z.n_words,
         (z.n_words * floor((3 * ln(0.4::DOUBLE) - ln(greatest(total.n, 1))) * 1000000 + 0.5)::BIGINT + coalesce(sums.s, 0))::DOUBLE / 1000000 AS score
  FROM sized z CROSS JOIN total LEFT JOIN sums ON z.doc_id = sums.doc_id
)
SELECT doc_id, n_words, score, CASE WHEN n_words > 0 THEN round(score / n_words, 6) ELSE 0.0 END AS per_word FROM scored""",
}
