"""Mixing to target weights with soft memberships.

A document may belong to several domains in part. A naive Bayes classifier, a table of word buckets by domains learned
from a labelled table, predicts how probable each domain is for a text. Every document gets a rate, the number of times it
should be used, so that the expected tokens of each domain meet a target: with t tokens, rate r and posterior p(k) a
document adds t r p(k) to domain k. The rates minimise sum over k of (tokens(k) - target(k))^2 / mass(k) with r >= 0, by
projected gradient steps from rate 1. Scaled by the domains' mass, a step of 1 always descends: no step size to choose.
A mix that keeps everything has rates of 1 at least and repeats the documents of scarce domains instead.

A step needs one sum per domain over all documents; the sums so far, a few numbers a step, are all the driver keeps, and
rates are recomputed from them. Everything is SQL functions.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from quayline.llm.common import free_name, keyed_rows, small_or_joined, table, whole_text, without, written

BUCKETS = 1 << 15
SAMPLE = 20_000  # labelled ids to learn from, 160 kB to broadcast
SMOOTHING = 0.5
TEMPERATURE = 0.25  # words of a text are not independent: their evidence counts as that of so many
STEPS, TOLERANCE = 40, 1e-6
TARGETS = {"de": 0.2, "en": 0.4, "es": 0.2, "fr": 0.2}


def word_rows(docs: DataFrame, text: str, *keep: str) -> DataFrame:
    """One row per word with its bucket; a text without words has a single row without a bucket."""
    word = F.explode_outer(F.split(F.col(text), r"[\x09-\x0D\x20]+")).alias("_word")
    return docs.select(*keep, word).select(
        *keep, F.when(F.length("_word") > 0, F.pmod(F.xxhash64(F.lower("_word")), F.lit(BUCKETS)).cast("int")).alias("_bucket"))


def word_table(labelled: DataFrame, domain: str, text: str, domains: list[str]) -> DataFrame:
    """The classifier: per bucket the log likelihood of each domain, ``w0``, ``w1`` and so on; ``BUCKETS`` rows."""
    rows = word_rows(labelled.where(F.col(f"`{domain}`").isin(domains)).select(
        F.col(f"`{domain}`").alias("_domain"), whole_text(f"`{text}`").alias("_text")), "_text", "_domain")
    seen = rows.where(F.col("_bucket").isNotNull()).groupBy("_bucket").agg(
        *[F.count_if(F.col("_domain") == d).alias(f"n{i}") for i, d in enumerate(domains)])
    every = labelled.sparkSession.range(BUCKETS).select(F.col("id").cast("int").alias("_bucket"))
    counts = written(every.join(seen, "_bucket", "left").na.fill(0), "words")
    total = counts.agg(*[F.sum(f"n{i}") for i in range(len(domains))]).first()
    return counts.select("_bucket", *[
        F.log((F.col(f"n{i}") + SMOOTHING) / (total[i] + SMOOTHING * BUCKETS)).alias(f"w{i}") for i in range(len(domains))])


def labelled_rows(labelled: DataFrame, domains: list[str], domain: str = "domain") -> dict[str, int]:
    """How many rows teach each domain; all of ``domains`` with 0 where none teaches any."""
    found = {r["d"]: r["count"] for r in labelled.where(F.col(f"`{domain}`").isin(domains))
             .groupBy(F.col(f"`{domain}`").alias("d")).count().collect()}
    return {d: found[d] for d in domains if d in found} or dict.fromkeys(domains, 0)


def memberships(docs: DataFrame, labelled: DataFrame, prior: Mapping[str, int], domain: str = "domain", key: str = "doc_id",
                text: str = "text") -> DataFrame:
    """Per row of ``docs`` its key, ``_row``, ``tokens`` and posterior probabilities ``p0``, ``p1`` and so on of the domains
    in ``prior``, which has their labelled rows."""
    domains, known = list(prior), sum(prior.values())
    start = [math.log((n + SMOOTHING) / (known + SMOOTHING * len(domains))) for n in prior.values()]
    rows = word_rows(docs.select(F.col(f"`{key}`").alias("_key"), F.monotonically_increasing_id().alias("_row"),
                                 whole_text(f"`{text}`").alias("_text")), "_text", "_key", "_row")
    table_of = F.broadcast(word_table(labelled, domain, text, domains))  # BUCKETS rows
    sums = (rows.join(table_of, "_bucket", "left").groupBy("_key", "_row")
            .agg(F.count("_bucket").alias("tokens"), *[F.coalesce(F.sum(f"w{i}"), F.lit(0.0)).alias(f"s{i}")
                                                       for i in range(len(domains))]))
    evidence = [F.lit(a) + F.col(f"s{i}") * TEMPERATURE for i, a in enumerate(start)]
    best = F.greatest(*evidence) if len(domains) > 1 else evidence[0]
    parts = [F.round(F.exp(e - best), 12) for e in evidence]
    return written(sums.select("_key", "_row", "tokens", *[
        (p / sum(parts)).alias(f"p{i}") for i, p in enumerate(parts)]), "memberships")


def _rate(steps: list[list[float]], least: float = 0.0) -> Column:
    """The rate after some steps, each a list of what a full member of a domain loses."""
    rate = F.lit(1.0)
    for step in steps:
        rate = F.greatest(F.lit(least), rate - sum(F.col(f"p{i}") * F.lit(e) for i, e in enumerate(step)))
    return rate


def whole_step(members: DataFrame, share: list[float]) -> list[float] | None:
    """A step to rates that meet the shares with as few tokens as linear rates of 1 at least allow; it tells how many.

    Rates that are linear in the memberships meet a target if the memberships' second moments, weighted by tokens, map the
    factors of the domains to it. None where that asks for a factor that is not positive.
    """
    k = range(len(share))
    pairs = members.agg(*[F.sum(F.col("tokens") * F.col(f"p{i}") * F.col(f"p{j}")) for i in k for j in k]).first()
    try:
        factors = np.linalg.solve(np.reshape([x or 0.0 for x in pairs], (len(share), -1)), share)
    except np.linalg.LinAlgError:
        return None
    return [1 - float(f"{x:.12g}") for x in factors / factors.min()] if factors.min() > 0 else None


def solve(members: DataFrame, weights: list[float], total: float | None = None,
          steps: int = STEPS, keep_all: bool = False) -> tuple[list[list[float]], list[float], list[float]]:
    """The steps that lead to the rates, the targets and the domains' tokens at the end.

    Without ``total`` the targets are the most tokens for which no domain has to be repeated or, with ``keep_all``, the
    fewest for which no document has to be left out. ``keep_all`` projects every rate to 1 or more, else to 0 or more.
    The descent begins at rates of 1 and ends when the domains miss their targets by ``TOLERANCE`` of the total together.
    """
    sums = lambda rate: [x or 0.0 for x in members.agg(*[
        F.sum(F.col("tokens") * rate * F.col(f"p{i}")) for i in range(len(weights))]).first()]
    mass = sums(F.lit(1.0))
    share = [w if m > 0 else 0.0 for w, m in zip(weights, mass)]  # what isn't there can't be mixed in
    if not sum(share):
        return [], [0.0] * len(weights), mass
    share = [w / sum(share) for w in share]
    least = 1.0 if keep_all else 0.0
    if keep_all and total is None and all(share) and (step := whole_step(members, share)):
        total = sum(sums(_rate([step], least)))
    if total is None:
        total = (max if keep_all else min)(m / w for w, m in zip(share, mass) if w)
    target, now, taken = [w * total for w in share], mass, []
    while len(taken) < steps and sum(abs(a - b) for a, b in zip(now, target)) > TOLERANCE * total:
        taken.append([float(f"{(a - b) / m:.12g}") if m > 0 else 0.0 for a, b, m in zip(now, target, mass)])
        now = sums(_rate(taken, least))
    return taken, target, now


def mixing_rates(docs: DataFrame, labelled: DataFrame, targets: Mapping[str, float], domain: str = "domain",
                 key: str = "doc_id", text: str = "text", total: float | None = None, keep_all: bool = False) -> DataFrame:
    """``key``, ``tokens``, a map of ``memberships``, ``rate`` and ``copies`` for every row of ``docs``.

    ``labelled`` has a text and a domain; rows whose domain is NULL or not in ``targets`` teach nothing. ``copies`` is the
    rate, rounded up or down by a hash of key and text in proportion to its fraction. A NULL text counts as empty; a text
    without words has the prior memberships and no tokens, so it moves no sum. A target that no labelled
    row teaches, or with no tokens at hand, is left out and the others keep their proportions; its memberships are 0. Where
    nothing is taught at all memberships are even, and without ``total`` every rate is 1. Repeated rows get equal rates and
    copies. An empty table gives no rows. With ``keep_all`` every row has a copy at least, and scarce domains have more;
    a target of 0 then counts its rows once.
    """
    domains = sorted(targets)
    if not domains or any(not targets[d] >= 0 for d in domains) or not sum(targets.values()) > 0:
        raise ValueError("targets need weights that are not negative and not all zero")
    prior = labelled_rows(labelled, domains, domain)
    there = list(prior)  # smoothing would lend a domain that nobody has seen a little of every text
    members = memberships(docs, labelled, prior, domain, key, text)
    learned = total is not None or sum(prior.values())
    steps = solve(members, [targets[d] for d in there], total, keep_all=keep_all)[0] if learned else []
    map_of = F.create_map(*[x for d in domains for x in (
        F.lit(d), F.col(f"p{there.index(d)}") if d in there else F.lit(0.0))])
    rated = members.select(F.col("_key").alias(key), "_row", "tokens", map_of.alias("memberships"),
                           F.round(_rate(steps, 1.0 if keep_all else 0.0), 9).alias("rate"))
    chance = F.pmod(F.xxhash64(key, "tokens"), F.lit(1 << 30)) / F.lit(1 << 30)
    return rated.withColumn("copies", (F.floor("rate") + F.when(chance < F.col("rate") - F.floor("rate"), 1)
                                       .otherwise(0)).cast("int"))


def language_labels(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The labelled table: the texts of about ``sample`` ids that ``labels`` lists, with their language as domain."""
    listed = labels.select(F.col("doc_id").alias("_listed")).where(F.col("doc_id").isNotNull()).distinct()
    share = sample / max(1, listed.count())
    listed = F.broadcast(listed.where(F.pmod(F.xxhash64("_listed"), F.lit(1 << 30)) < F.lit(share * (1 << 30))))
    return docs.join(listed, docs["doc_id"] == F.col("_listed"), "left_semi").select(
        "text", F.col("lang").alias("domain"))


def mix(docs: DataFrame, labels: DataFrame, targets: Mapping[str, float] = TARGETS, keep_all: bool = False) -> DataFrame:
    """The documents that a mix without repetition uses, with all their columns; with ``keep_all`` all documents, each as
    often as it has copies."""
    named, name = keyed_rows(docs)
    rates = mixing_rates(named, language_labels(docs, labels), targets, key=name, keep_all=keep_all)
    if not keep_all:
        return without(named, name, written(rates.where(F.col("copies") == 0).select(name).distinct(), "left_out"))
    other, times = free_name(named.columns, "_repeated"), free_name(named.columns, "_copies")
    repeated = small_or_joined(written(rates.where(F.col("copies") > 1).select(
        F.col(name).alias(other), F.col("copies").alias(times)).distinct(), "repeated"))
    every = F.explode(F.sequence(F.lit(1), F.coalesce(F.col(times), F.lit(1)))).alias(times)
    return named.join(repeated, F.col(name) == F.col(other), "left").select(
        *[F.col(f"`{c}`") for c in docs.columns], every).drop(times)


def op3_soft_membership_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mixing rate of every document, 1 at least."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    rates = mixing_rates(docs, language_labels(docs, labels), TARGETS, keep_all=True)
    posterior = [F.round(F.col("memberships")[d], 9).alias(f"p_{d}") for d in sorted(TARGETS)]
    return rates.select("doc_id", "tokens", *posterior, F.round("rate", 6).alias("rate"), "copies")
