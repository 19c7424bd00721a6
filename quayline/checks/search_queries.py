"""Ranked search, fragments and what the index answers, as queries over the documents, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from quayline.operators import search
from quayline.operators.index import SearchIndex
from quayline.session import fresh_path

TERMS = ("the", "der", "Les", "and")
BEST = 100
FRAGMENT_TERMS = ("the", "and", "of")
FRAGMENT_WORDS = 20


def _documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def _index(spark: SparkSession, folder: str) -> SearchIndex:
    index = SearchIndex(spark, fresh_path(spark, "index"), block=256)
    index.build(_documents(spark, folder), "doc_id", "text")
    return index


def search_ranked(spark: SparkSession, folder: str) -> DataFrame:
    """The best documents for four words: a top list is what is asked for."""
    return _index(spark, folder).ranked(TERMS, BEST, key="doc_id")


def search_scores(spark: SparkSession, folder: str) -> DataFrame:
    """The score of every document that has one of the words."""
    return _index(spark, folder).ranked(TERMS, key="doc_id")


def search_index_terms(spark: SparkSession, folder: str) -> DataFrame:
    """Every word of the index, with its documents and occurrences."""
    rows = spark.read.parquet(f"{_index(spark, folder).path}/postings")
    times = F.aggregate("times", F.lit(0).cast("long"), lambda a, t: a + t)
    return rows.groupBy("term").agg(F.sum("docs").alias("docs"), F.sum(times).alias("times"))


def search_fragments(spark: SparkSession, folder: str) -> DataFrame:
    """The best fragment of every hit."""
    rows = search.best_fragments(_documents(spark, folder).select("doc_id", "text"), "text", FRAGMENT_TERMS, FRAGMENT_WORDS)
    return rows.select("doc_id", "fragment")


QUERIES = {f.__name__: f for f in (search_ranked, search_scores, search_index_terms, search_fragments)}

_LIST = ", ".join(f"'{t.lower()}'" for t in TERMS)
_SCORES = rf"""
WITH words AS (
    SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}]+')) AS term FROM documents),
lengths AS (SELECT doc_id, count(*) AS length FROM words GROUP BY doc_id),
totals AS (SELECT count(*) AS docs, avg(length) AS mean FROM lengths),
hits AS (SELECT doc_id, term, count(*) AS times FROM words WHERE term IN ({_LIST}) GROUP BY doc_id, term),
weights AS (
    SELECT term, ln(1 + (any_value(docs) - count(*) + 0.5) / (count(*) + 0.5)) AS weight FROM hits, totals GROUP BY term)
SELECT doc_id, round(sum(weight * times * 2.2 / (times + 1.2 * (0.25 + 0.75 * length / mean))), 9) AS score,
       count(*) AS found
FROM hits JOIN weights USING (term) JOIN lengths USING (doc_id), totals GROUP BY doc_id
"""

ORACLES = {
    "search_ranked": f"SELECT * FROM ({_SCORES}) ORDER BY score DESC, doc_id LIMIT {BEST}",
    "search_scores": _SCORES,
    "search_index_terms": r"""
        SELECT term, count(DISTINCT doc_id) AS docs, count(*)::BIGINT AS times
        FROM (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}]+')) AS term FROM documents)
        GROUP BY term""",
    "search_fragments": rf"""
        WITH cut AS (
            SELECT doc_id, regexp_extract_all(text, '[\p{{L}}\p{{N}}]+|[^\p{{L}}\p{{N}}]+') AS runs,
                   len(regexp_extract_all(text, '[\p{{L}}\p{{N}}]+')) AS number,
                   CASE WHEN regexp_matches(text, '^[\p{{L}}\p{{N}}]') THEN 0 ELSE 1 END AS skipped
            FROM documents),
        words AS (SELECT doc_id, unnest(generate_series(0, number - 1)) AS spot, runs, skipped FROM cut),
        found AS (
            SELECT doc_id, spot, lower(runs[2 * spot + skipped + 1]) AS term FROM words
            WHERE lower(runs[2 * spot + skipped + 1]) IN ({", ".join(f"'{t}'" for t in FRAGMENT_TERMS)})),
        spans AS (
            SELECT a.doc_id, a.spot, count(DISTINCT b.term) AS kinds, count(*) AS hits
            FROM found a JOIN found b
              ON a.doc_id = b.doc_id AND b.spot >= a.spot AND b.spot < a.spot + {FRAGMENT_WORDS}
            GROUP BY a.doc_id, a.spot),
        best AS (
            SELECT doc_id, spot FROM (SELECT *, row_number() OVER (
                PARTITION BY doc_id ORDER BY kinds DESC, hits DESC, spot) AS place FROM spans) WHERE place = 1),
        placed AS (
            SELECT c.*, greatest(0, least(spot, number - {FRAGMENT_WORDS})) AS start FROM cut c JOIN best USING (doc_id))
        SELECT doc_id, array_to_string(list_transform(
            runs[2 * start + skipped + 1:2 * (least(number, start + {FRAGMENT_WORDS}) - 1) + skipped + 1],
            lambda r: CASE WHEN lower(r) IN ({", ".join(f"'{t}'" for t in FRAGMENT_TERMS)}) THEN '<em>' || r || '</em>'
                           ELSE r END), '') AS fragment
        FROM placed""",
}
