"""Index and fragments on small texts."""

import math
import random

import pytest
from pyspark.sql import functions as F

from quayline.operators import search
from quayline.operators.index import SearchIndex

TEXTS = [None, "", " .,", "Alpha beta", "alpha ALPHA gamma", "beta-alpha; delta!", "gamma " * 900 + "beta", "épée naïve x1",
         "alphabet betas", "漢字 alpha"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i * 7, t) for i, t in enumerate(TEXTS)] + [(None, "alpha"), (10_000_000_000, "alpha beta beta")]
    return spark.createDataFrame(rows, "id long, text string").repartition(3)


@pytest.fixture(scope="module")
def index(spark, docs, tmp_path_factory):
    index = SearchIndex(spark, str(tmp_path_factory.mktemp("index")), parts=4, block=10)
    index.build(docs, "id", "text")
    return index


def test_scores_of_small_texts(index):
    lists = {3: ["alpha", "beta"], 4: ["alpha", "alpha", "gamma"], 5: ["beta", "alpha", "delta"], 6: ["gamma"] * 900 + ["beta"],
             7: ["épée", "naïve", "x1"], 8: ["alphabet", "betas"], 9: ["漢字", "alpha"]}
    lists = {i * 7: w for i, w in lists.items()} | {10_000_000_000: ["alpha", "beta", "beta"]}
    mean, out = sum(map(len, lists.values())) / len(lists), []
    weight = {}
    for term in ("alpha", "beta"):
        has = sum(term in w for w in lists.values())
        weight[term] = math.log(1 + (len(lists) - has + 0.5) / (has + 0.5))
    for i, words in lists.items():
        parts = [weight[t] * words.count(t) * 2.2 / (words.count(t) + 1.2 * (0.25 + 0.75 * len(words) / mean))
                 for t in weight if t in words]
        if parts:
            out.append((i, round(sum(parts), 6), len(parts)))
    expected = sorted(out, key=lambda r: (-r[1], r[0]))
    rows = [(r["id"], round(r["score"], 6), r["found"]) for r in index.ranked(["Beta", "alpha", "beta"], key="id").collect()]
    assert rows == expected
    assert [r["id"] for r in index.ranked(["alpha", "beta"], 3, key="id").collect()] == [r[0] for r in expected[:3]]
    assert index.count(["alpha", "beta", "nowhere"]).first()["total"] == len(expected)
    assert index.ranked(["nowhere"]).collect() == [] and index.count(["nowhere"]).first()["total"] == 0
    with pytest.raises(ValueError):
        index.ranked([])


def test_only_the_words_asked_for_are_read(index):
    plan = index.ranked(["alpha", "beta"])._jdf.queryExecution().executedPlan().toString()
    assert "In(term, [alpha,beta])" in plan and "text" not in plan
    folders = {f.split("part=")[1].split("/")[0] for f in index.postings(["alpha", "beta"]).inputFiles()}
    parts = {str(r["part"]) for r in index.postings(["alpha", "beta"]).select("part").distinct().collect()}
    assert parts <= folders and "PartitionFilters: [part" in plan
    scans = index.postings(["alpha"])
    rows = scans.collect()
    assert {r["term"] for r in rows} == {"alpha"} and {r["part"] for r in rows} == {rows[0]["part"]}


def test_a_frequent_word_fills_many_rows(spark, tmp_path):
    index = SearchIndex(spark, str(tmp_path / "x"), block=64)
    index.build(spark.range(1000).select("id", F.concat(F.lit("common w"), "id").alias("text")), "id", "text")
    rows = index.postings(["common"]).collect()
    assert sum(r["docs"] for r in rows) == 1000 and max(len(r["after"]) for r in rows) <= 64
    index.build(spark.range(3).select("id", F.lit("other").alias("text")), "id", "text")
    assert index.postings(["common"]).collect() == [] and index.count(["other"]).first()["total"] == 3


def test_an_empty_index(spark, docs, tmp_path):
    index = SearchIndex(spark, str(tmp_path / "x"))
    index.build(docs.limit(0), "id", "text")
    assert index.ranked(["alpha"]).collect() == []


def brute_fragment(text, terms, width):
    import re
    runs = re.findall(r"\w+|\W+", text.replace("_", " "))
    lead = 0 if runs and re.match(r"\w", runs[0]) else 1
    words = runs[lead::2]
    spots = [i for i, w in enumerate(words) if w.lower() in terms]
    best = max(((len({words[j].lower() for j in spots if i <= j < i + width}),
                 sum(i <= j < i + width for j in spots), -i) for i in spots), default=None)
    if best is None:
        return None
    first = max(0, min(-best[2], len(words) - width))
    last = min(len(words), first + width) - 1
    return "".join(f"<em>{r}</em>" if r.lower() in terms else r for r in runs[2 * first + lead:2 * last + lead + 1])


def test_best_fragments(spark):
    r, words = random.Random(2), ["red", "Blue", "green", "x", "y", "z", "Zoë"]
    texts = ["".join(w + r.choice([" ", ", ", ".\n", " - "]) for w in r.choices(words, [1, 1, 1, 6, 6, 6, 2], k=r.randint(1, 60)))
             for _ in range(150)]
    texts += [None, "", "red", " red", "(blue) ", "no match here", "red " * 500, "…red…green…"]
    df = spark.createDataFrame([(i, t, i) for i, t in enumerate(texts)], "id long, text string, fragment_ long")
    for width in (1, 5, 12):
        found = {x["id"]: x["fragment"] for x in search.best_fragments(df, "text", ["RED", "blue", "green"], width).collect()}
        expected = {i: brute_fragment(t, {"red", "blue", "green"}, width) for i, t in enumerate(texts) if t}
        assert found == {i: f for i, f in expected.items() if f is not None}
    assert search.best_fragments(df.limit(0), "text", ["red"]).columns == ["id", "text", "fragment_", "fragment"]


def test_rows_of_one_key_and_the_shuffle_of_an_index(spark, tmp_path):
    """Rows with the same key and length count as one document, in totals as two; what is shuffled is texts, not their words."""
    rows = [(1, "a b a"), (1, "a b a"), (1, "c"), (-3, "b b"), (700, "a")]
    index = SearchIndex(spark, str(tmp_path / "x"), block=10)
    index.build(spark.createDataFrame(rows, "id long, text string").repartition(4), "id", "text")
    found = sorted(tuple(r) for r in index.matches(["a", "b", "c"]).select("term", "doc", "times", "length").collect())
    assert found == [("a", 1, 4, 3), ("a", 700, 1, 1), ("b", -3, 2, 2), ("b", 1, 2, 3), ("c", 1, 1, 1)]
    assert tuple(spark.read.parquet(f"{index.path}/totals").select("docs", "words").first()) == (5, 10)
    build = SearchIndex.build.__code__.co_names
    assert "applyInArrow" in build and "collect_list" not in build
