"""The similarity join against all pairs."""

import random
import re

import numpy as np
import pytest

from quayline.llm import shingles, signatures


def brute(rows, words=5, percent=75):
    """Shingle sets, all links and the smallest key that each row reaches."""
    sets = []
    for _, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
        sets.append({tuple(w[i:i + words]) for i in range(len(w) - words + 1)} if len(w) >= words else {tuple(w)} if w else set())
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    where = {}
    for i, s in enumerate(sets):
        for t in s:
            where.setdefault(t, []).append(i)
    for i, s in enumerate(sets):
        for j in {j for t in s for j in where[t] if j < i}:
            common = len(s & sets[j])
            if 100 * common >= percent * (len(s) + len(sets[j]) - common):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    least = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            least[root(i)] = min(key, least.get(root(i), key))
    return [(key, len(s), least.get(root(i), key)) for i, ((key, _), s) in enumerate(zip(rows, sets))]


def result(df):
    return [tuple(r) for r in df.select("doc_id", "n_shingles", "component_id").collect()]


def same(a, b):
    assert sorted(a, key=repr) == sorted(b, key=repr)


def near(r, words, share):
    return [w if r.random() > share else f"new{r.randrange(10**9)}" for w in words]


def corpus():
    r = random.Random(11)
    vocabulary = [f"w{i}" for i in range(400)]
    rows, passage = [], " ".join(r.choices(vocabulary, k=60))
    for _ in range(60):
        rows.append(" ".join(r.choices(vocabulary, k=r.randint(1, 120))))
    for _ in range(12):  # chains and stars of near copies
        words = r.choices(vocabulary, k=r.randint(8, 400))
        for _ in range(r.randint(2, 25)):
            rows.append(" ".join(near(r, words, r.choice((0, 0.005, 0.01, 0.03, 0.05)))))
            if r.random() < 0.3:
                words = rows[-1].split()
    for n in (5, 20, 40):  # a passage that makes up more or less of a text
        rows += [passage + " " + " ".join(r.choices(vocabulary, k=r.randint(0, n))) for _ in range(15)]
    rows += ["one two", "ONE  two\n", "one two three four five", "one two three four five six", None, "", " \t", "x", "x", "Ä b", "ä b"]
    rows += ["a b c d e f g h i j k l m n o p"] * 40
    r.shuffle(rows)
    return [(i * 3, t) for i, t in enumerate(rows)] + [(None, "x"), (6, rows[2]), (6, "other words for an id that is taken")]


@pytest.mark.parametrize("leaf, chunk, piece, block", [(512, 256, 8192, 4 << 20), (4, 2, 7, 3000)])
def test_groups_equal_all_pairs(spark, monkeypatch, leaf, chunk, piece, block):
    for name, value in (("LEAF_SETS", leaf), ("CHUNK", chunk), ("PIECE", piece), ("BLOCK_BYTES", block)):
        monkeypatch.setattr(shingles, name, value)
    rows = corpus()
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, block int")
    same(result(shingles.similar_groups(docs.repartition(3))), brute(rows))


def test_without_the_first_rounds_nothing_is_lost(spark, monkeypatch):
    monkeypatch.setattr(shingles, "neighbour_links", lambda sets, *_: sets.sparkSession.createDataFrame([], "a long, b long"))
    monkeypatch.setattr(shingles, "CHUNK", 8)
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    same(result(shingles.similar_groups(docs.repartition(2))), brute(rows))


def test_documents_equal_all_pairs(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    same(result(shingles.similar_groups(docs)), brute(rows))


def test_no_rows(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert shingles.similar_groups(docs).collect() == []
    docs = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    same(result(shingles.similar_groups(docs)), [(1, 0, 1), (2, 0, 2)])


def test_traversal_loses_no_pair():
    r = np.random.default_rng(5)
    for n in (1, 2, 5, 40, 150):
        base = [r.integers(0, 1 << 63, r.integers(1, 60), np.uint64) for _ in range(max(1, n // 6))]
        sets = []
        for _ in range(n):
            own = base[r.integers(len(base))]
            own = own[r.random(len(own)) > r.choice([0, 0.1, 0.2])]
            sets.append(np.unique(np.r_[own, r.integers(0, 1 << 63, r.integers(0, 5), np.uint64)]))
        component = r.integers(0, n, n) if n % 2 else np.arange(n)
        groups = signatures.Groups(component)
        for i in range(n):
            for j in range(i):
                common = len(np.intersect1d(sets[i], sets[j]))
                if common and 100 * common >= 75 * (len(sets[i]) + len(sets[j]) - common):
                    groups.parent[groups.root(i)] = groups.root(j)
        found = signatures.Groups(component)
        for i, j in signatures.links(sets, component, 75):
            found.parent[found.root(i)] = found.root(j)
        of = lambda g: {frozenset(k for k in range(n) if g.root(k) == g.root(i)) for i in range(n)}
        assert of(found) == of(groups)
