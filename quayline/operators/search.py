"""Term search over text columns: hits, marked text, the best fragment, facets and counts."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

MARK = ("<em>", "</em>")
WORD = r"[\p{L}\p{N}]+"


def _pattern(terms: Sequence[str]) -> str:
    """Any of the terms as a whole word, in any case."""
    words = "|".join(re.escape(t) for t in terms)
    return rf"(?iu)(?<![\p{{L}}\p{{N}}])({words})(?![\p{{L}}\p{{N}}])"


def matches(column: str, terms: Sequence[str]) -> Column:
    """Whether a text contains one of the terms as a word."""
    return F.col(column).rlike(_pattern(terms))


def hits(df: DataFrame, column: str, terms: Sequence[str], limit: int = 0, order: Sequence[str] = ()) -> DataFrame:
    """The matching rows with every occurrence marked in the text; optionally only the first ``limit`` of them."""
    marked = df.where(matches(column, terms)).withColumn(
        column, F.regexp_replace(F.col(column), _pattern(terms), f"{MARK[0]}$1{MARK[1]}"))
    if order:
        marked = marked.orderBy(*order)
    return marked.limit(limit) if limit else marked


def count_matches(df: DataFrame, column: str, terms: Sequence[str]) -> DataFrame:
    return df.where(matches(column, terms)).agg(F.count(F.lit(1)).alias("total"))


def facets(df: DataFrame, column: str, terms: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """Matching documents in all (facet ``total``) and per value of each field, from one pass over the texts."""
    found = df.where(matches(column, terms)).select(*fields)
    names = list(fields)
    sets = [[F.col(n)] for n in names] + [[]]
    counted = found.groupingSets(sets, *[F.col(n) for n in names]).agg(
        F.grouping_id().alias("_set"), F.count(F.lit(1)).alias("docs"))
    every = (1 << len(names)) - 1
    facet, value = F.when(F.col("_set") == every, F.lit("total")), F.when(F.lit(False), F.lit(None).cast("string"))
    for i, name in enumerate(names):
        own = every ^ (1 << (len(names) - 1 - i))
        facet = facet.when(F.col("_set") == own, F.lit(name))
        value = value.when(F.col("_set") == own, F.col(name).cast("string"))
    return counted.select(facet.alias("facet"), value.alias("value"), "docs")


def words_of(text: Column) -> Column:
    """The words of a text in lower case; none for NULL."""
    return F.coalesce(F.regexp_extract_all(F.lower(text), F.lit(f"({WORD})"), F.lit(1)), F.array().cast("array<string>"))


def best_fragments(df: DataFrame, column: str, terms: Sequence[str], words: int = 30, name: str = "fragment") -> DataFrame:
    """The matching rows with their best ``words`` words in a row as ``name``, marked.

    Best are the words that hold the most different terms, then the most matches, then the first. A window slides from match
    to match; at the end of a text it is moved back, so that a text of so many words gives them all. Words are not cut, and
    what stands between them stays.
    """
    wanted = sorted({t.lower() for t in terms})
    runs, found, spans = (f"_{name}_{part}" for part in ("runs", "found", "spans"))
    # words and what is between them, in turn
    cut = df.where(matches(column, terms)).withColumn(
        runs, F.regexp_extract_all(F.col(column), F.lit(rf"({WORD}|[^\p{{L}}\p{{N}}]+)"), F.lit(1)))
    leading = F.when(F.col(runs)[0].rlike(f"^{WORD}$"), 0).otherwise(1)  # runs before the first word
    number = F.floor((F.size(runs) - leading + 1) / 2).cast("int")  # of words
    # the matches: which word of the text, and which term
    cut = cut.withColumn(found, F.filter(
        F.transform(runs, lambda r, i: F.struct(((i - leading) / 2).cast("int").alias("at"), F.lower(r).alias("term"))),
        lambda m: m["term"].isin(wanted)))

    def span(m: Column, i: Column) -> Column:
        # matches are as many as words at most
        near = F.filter(F.slice(found, i + 1, words), lambda x: x["at"] < m["at"] + words)
        return F.struct(F.size(F.array_distinct(F.transform(near, lambda x: x["term"]))).alias("terms"),
                        F.size(near).alias("matches"), (-m["at"]).alias("before"))

    cut = cut.withColumn(spans, F.array_max(F.transform(found, span)))
    first = F.greatest(F.lit(0), F.least(-F.col(spans)["before"], number - words))
    last = F.least(number, first + words) - 1
    part = F.slice(runs, first * 2 + leading + 1, (last - first) * 2 + 1)
    marked = F.transform(part, lambda r: F.when(F.lower(r).isin(wanted), F.concat(F.lit(MARK[0]), r, F.lit(MARK[1]))).otherwise(r))
    return cut.withColumn(name, F.array_join(marked, "")).drop(runs, found, spans)
