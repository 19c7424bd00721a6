"""Block and allow lists for URLs, looked up by hash prefixes.

A URL is expanded into the expressions a rule could be: each suffix of its host that starts at a label, followed by each
prefix of its path that ends with a slash. Rules and expressions meet in an equi-join on the first bytes of their SHA-256
digests; where those agree the whole digests are compared, and of the rules that fit the longest wins. No URL gets more
expressions than the rules' greatest number of labels and path parts allow.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from quayline.llm.common import table

PREFIX_HEX = 8  # four bytes
BROADCAST_RULES = 100_000  # about 20 MB

RULES = (("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"),
         ("net/fr/", "block"))


def rule_table(spark: SparkSession, rules: Sequence[tuple[str, str]]) -> DataFrame:
    """Rules as rows of ``rule`` and ``verdict``."""
    return spark.createDataFrame(list(rules), "rule string, verdict string")


def split_url(url):
    """Host and path: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, ASCII letters in lower case; then up
    to ``?``, ``#`` or the end. Both are empty without ``://`` or for NULL."""
    rest = F.when(F.instr(url, "://") > 0, F.substring_index(F.substring_index(
        F.substr(url, F.instr(url, "://") + 3), "#", 1), "?", 1))
    rest = F.coalesce(rest, F.lit(""))
    host = F.substring_index(rest, "/", 1)
    return (F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"),
            F.substr(rest, F.length(host) + 1))


def _expressions(labels: int, parts: int):
    """Of columns ``host`` and ``path``: every host suffix of at most so many labels with every path prefix of so many
    slashes, the first of which is the path's first character."""
    hosts = F.expr(f"transform(sequence(1, least({labels}, size(split(host, '[.]')))), "
                   "i -> substring_index(host, '.', -i))")
    slashes = f"least({parts}, size(split(path, '/')) - 1)"
    paths = F.expr(f"transform(sequence(1, {slashes}), i -> concat(substring_index(path, '/', i), '/'))")
    return F.when((F.length("host") > 0) & (F.instr("path", "/") == 1), F.flatten(F.transform(
        hosts, lambda h: F.transform(paths, lambda p: F.concat(h, p)))))


def judge(urls: DataFrame, rules: DataFrame, key: str, url: str = "url", default: str = "allow") -> DataFrame:
    """``key``, ``host``, ``path``, ``rule`` and ``verdict`` of every row of ``urls``.

    A rule is a host, a slash and a path that ends with a slash; it fits its host and all subdomains if the path starts
    with the rule's. The longest rule wins, then the one that sorts last; a rule given twice with different verdicts
    blocks. URLs that no rule fits, NULL and malformed ones get ``default`` and no rule. Repeated rows stay repeated.
    """
    if not rules.where(~F.col("rule").rlike(r"^[^/]+/(.*/)?$") | ~F.col("verdict").isin("allow", "block")
                       | F.col("rule").isNull() | F.col("verdict").isNull()).isEmpty():
        raise ValueError("a rule is host/ or host/path/, with the verdict allow or block")
    rules = rules.groupBy("rule").agg(F.max("verdict").alias("verdict"))  # "block" is the greater
    size = rules.agg(F.count(F.lit(1)).alias("n"), F.max(F.size(F.split("rule", "[.]"))).alias("labels"),
                     F.max(F.size(F.split("rule", "/")) - 1).alias("parts")).first()
    lookup = rules.select(F.sha2("rule", 256).alias("_rule_digest"), "rule", "verdict",
                          F.left(F.sha2("rule", 256), F.lit(PREFIX_HEX)).alias("_prefix"))
    if size["n"] <= BROADCAST_RULES:
        lookup = F.broadcast(lookup)
    host, path = split_url(F.col(f"`{url}`"))
    named = urls.select(F.col(f"`{key}`").alias("_key"), host.alias("host"), path.alias("path"))
    expanded = (named.select("*", F.posexplode_outer(_expressions(size["labels"] or 1, size["parts"] or 1))
                             .alias("_at", "_expression"))
                .withColumn("_digest", F.sha2("_expression", 256))
                .withColumn("_prefix", F.left("_digest", F.lit(PREFIX_HEX))))
    # every expression of a row is in its task, so the first half of the aggregate leaves a row of each
    fits = F.col("_rule_digest") == F.col("_digest")
    best = F.max(F.when(fits, F.struct(F.length("rule").alias("length"), "rule", "verdict")))
    return (expanded.join(lookup, "_prefix", "left").groupBy("_key", "host", "path")
            .agg(best.alias("_best"), F.count_if(F.coalesce("_at", F.lit(0)) == 0).alias("_rows"))
            .select("*", F.explode(F.sequence(F.lit(1).cast("long"), "_rows")).alias("_copy"))
            .select(F.col("_key").alias(key), "host", "path", F.col("_best.rule").alias("rule"),
                    F.coalesce("_best.verdict", F.lit(default)).alias("verdict")))


def op7_hash_prefix_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on every page's URL."""
    return judge(table(spark, sf_dir, "pages"), rule_table(spark, RULES), "page_id")


OP7_SQL = r"""
WITH rules(rule_host, rule_path, rule, verdict) AS (VALUES
        ('com', '/', 'com/', 'allow'), ('example.com', '/en/', 'example.com/en/', 'block'),
        ('www.example.com', '/en/', 'www.example.com/en/', 'allow'), ('net', '/es/', 'net/es/', 'block'),
        ('net', '/fr/', 'net/fr/', 'block')),
rests AS (
    SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
    FROM pages),
named AS (
    SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                              'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
    FROM rests),
judged AS (
    SELECT n.*, r.rule, r.verdict,
           row_number() OVER (PARTITION BY page_id ORDER BY length(r.rule) DESC NULLS LAST) AS place
    FROM named n LEFT JOIN rules r
      ON (n.host = r.rule_host OR ends_with(n.host, '.' || r.rule_host)) AND starts_with(n.path, r.rule_path))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM judged WHERE place = 1
"""
