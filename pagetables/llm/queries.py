"""The queries of the operators: ``(spark, sf_dir) -> DataFrame`` over whole tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagetables.llm import bpe, exact_dedup, html_extract, jaccard_join, language_id, lm_scoring, mixing, pu_quality, pu_toxicity, quality_rules, source_divergence, token_align, token_files
from pagetables.llm.common import remainder, table


def held_out(column: str, n: int, rest: int) -> Column:
    """Rows kept from learning; a null identifier isn't one of them."""
    return F.coalesce(remainder(column, n) == rest, F.lit(False))


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents"))


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = lm_scoring.score(table(spark, sf_dir, "documents"), ~held_out("doc_id", 7, 2))
    return scored.withColumn("held_out", held_out("doc_id", 7, 2))


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join(table(spark, sf_dir, "documents"))


def op4_pu_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = pu_quality.score(docs, labels, ~held_out("_id", 4, 2))
    return scored.select("doc_id", held_out("doc_id", 4, 2).alias("held_out"), "score", "predicted")


def op5_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.main_text(table(spark, sf_dir, "pages"))


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digest(bpe.encode(table(spark, sf_dir, "documents"), bpe.default_path()))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken(table(spark, sf_dir, "documents"))


def op8_pu_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = pu_toxicity.score(docs, labels, ~held_out("_id", 5, 0))
    return scored.select("doc_id", held_out("doc_id", 5, 0).alias("held_out"), "score", "predicted")


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = language_id.identify(table(spark, sf_dir, "documents"), ~held_out("doc_id", 3, 1))
    return found.select("doc_id", held_out("doc_id", 3, 1).alias("held_out"), "lang_pred", "score", "phrases_per_byte")


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence.audit(table(spark, sf_dir, "documents"))


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.round_trip(table(spark, sf_dir, "documents"), token_files.default_path())


def op13_token_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_align.link_counts(table(spark, sf_dir, "documents"), *token_align.default_paths())


QUERIES = {f.__name__: f for f in (op1_quality_rules, op2_lm_scoring, op3_jaccard_join, op4_pu_quality, op5_html_extract, op6_bpe, op7_mixing, op8_pu_toxicity, op9_exact_dedup, op10_language_id, op11_source_divergence, op12_token_files, op13_token_align)}

SQL = {
    "op9_exact_dedup": r"""
WITH t AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = min(doc_id) OVER g AS kept, text_sha256
FROM t WINDOW g AS (PARTITION BY text_sha256)
""",
    "op11_source_divergence": r"""
WITH d AS (
  SELECT row_number() OVER () AS row_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
w AS (
  SELECT row_id, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS lang_n FROM w GROUP BY lang, term HAVING count(DISTINCT row_id) >= 30),
cells AS (SELECT lang, source, term, count(*) AS n FROM w JOIN kept USING (lang, term) GROUP BY lang, source, term),
langs AS (SELECT lang, count(*) AS v, sum(lang_n)::BIGINT AS total FROM kept GROUP BY lang),
totals AS (SELECT lang, source, sum(n)::BIGINT AS total FROM cells GROUP BY lang, source),
groups AS (
  SELECT g.lang, g.source, coalesce(t.total, 0) AS total, coalesce(l.v, 0) AS v, coalesce(l.total, 0) AS lang_total
  FROM (SELECT DISTINCT lang, source FROM d) g LEFT JOIN totals t USING (lang, source) LEFT JOIN langs l USING (lang)),
shares AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
         1 + (1000000000 * (coalesce(c.n, 0) + 5)) // (g.total + 5 * g.v) AS p,
         1 + (1000000000 * (k.lang_n + 5)) // (g.lang_total + 5 * g.v) AS q
  FROM groups g JOIN kept k USING (lang) LEFT JOIN cells c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
diffs AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
found AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(x.value, 0)::BIGINT AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN diffs x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
  UNION ALL SELECT lang, source, 'term', term, (p - q)::BIGINT FROM shares WHERE n > 0 AND p > q),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank FROM found)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 50
""",
}
