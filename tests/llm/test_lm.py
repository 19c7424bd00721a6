"""The language model: proper probabilities, counts against brute force, better than single words."""

import itertools
import math
import random
import zlib
from collections import Counter

import numpy as np

from quayline.llm import bitmix, lm


def words_of(text):
    return [w for w in (text or "").encode().lower().split()] + [b""]


def check(rows, found, training):
    counts = Counter(w for (_, t), learn in zip(rows, training) if learn for w in words_of(t))
    n, v = sum(counts.values()), len(counts)
    got = {}
    for r in found:
        got.setdefault(r["doc_id"], []).append(r)
    for (key, text), learn in zip(rows, training):
        words = words_of(text)
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words)
        match = [r for r in got[key] if r["n_tokens"] == len(words) and abs(r["base_score"] - base) < 1e-6]
        assert match, (key, base, got[key])
        assert all(r["n_known"] == sum(counts[w] > 0 for w in words) and r["train_tokens"] == n and r["score"] < 0 for r in match)
        assert all(r["training"] == learn for r in match)


def test_counts_equal_brute_force_and_the_model_beats_single_words(spark, folder):
    folder = folder.replace("0.001", "0.01")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    found = lm.op4_context_mixing_lm(spark, folder).withColumn("training", ~lm.F.col("held_out")).collect()
    assert len(found) == len(rows)
    check(rows, found, [zlib.crc32(str(i).encode()) % 7 != 2 for i, _ in rows])
    held = [r for r in found if r["held_out"]]
    known = [r for r in held if r["n_known"] > 0.9 * r["n_tokens"]]
    assert sum(r["score"] for r in known) > sum(r["base_score"] for r in known)


def test_awkward_rows(spark, monkeypatch):
    monkeypatch.setattr(lm, "BLOCK_BYTES", 2000)
    r = random.Random(4)
    rows = [(i, " ".join(r.choices(["the", "THE", "der", "und", "of", "ä", "\x01x", "z" * r.randint(1, 90)], k=r.randint(0, 80)))) for i in range(60)]
    rows += [(100, None), (101, ""), (None, " \t\n"), (102, "y" * 3000), (103, "y" * 2999 + " q"), (7, "the der"), (7, "the der")]
    docs = spark.createDataFrame([(*x, 0) for x in rows], "doc_id long, text string, block int")
    learn = lm.F.coalesce(lm.F.col("doc_id") % 7 != 2, lm.F.lit(True))
    found = lm.score_texts(docs.repartition(3), learn).collect()
    assert len(found) == len(rows)
    check(rows, found, [k is None or k % 7 != 2 for k, _ in rows])
    assert lm.score_texts(docs.limit(0), learn).collect() == []
    nothing = lm.score_texts(docs, lm.F.lit(False)).collect()
    assert len(nothing) == len(rows) and all(x["n_known"] == 0 and x["score"] < 0 for x in nothing)


def pages_of(words, counts, sizes):
    pages, at = [], 0
    for n in sizes:
        pages.append(bitmix.Page(words[at:at + n], counts[at:at + n]))
        at += n
    between = [-1, *[bitmix.common_bits(a.last, b.first) for a, b in zip(pages, pages[1:])], -1]
    outside = {}
    for p, a, b in zip(pages, between, between[1:]):
        for k, x in p.edge_nodes(a, b).items():
            outside[k] = tuple(np.add(outside.get(k, (0, 0)), x))
    return pages, between, outside


def test_prefix_counts_across_pages_equal_brute_force():
    r = np.random.default_rng(3)
    words = sorted({bytes(r.choice(list(b"abcd\x01\xc3\xa9"), r.integers(0, 9))) for _ in range(150)} | {b"a" * 40, b"a" * 41},
                   key=lambda w: w + b" ")
    words = [b"\x01" + w for w in words]
    counts = r.integers(0, 5, len(words))
    bits = [np.unpackbits(np.frombuffer(w + b" ", np.uint8)) for w in words]
    for sizes in ([len(words)], [1, 2, 30, 1, len(words) - 34], [50, len(words) - 50]):
        pages, between, outside = pages_of(words, counts, sizes)
        first, seen = 0, 0
        for p, a, b in zip(pages, between, between[1:]):
            for at, j, _, bit_no, bit, total, ones in p.nodes(outside, a, b):
                for i, pos, x, n, n1 in zip(at + first, np.broadcast_to(j, len(at)), bit, total, ones):
                    d = 8 * pos + bit_no
                    alike = [k for k, y in enumerate(bits) if len(y) > d and (y[:d] == bits[i][:d]).all()]
                    assert x == bits[i][d]
                    assert n == counts[alike].sum() and n1 == sum(counts[k] for k in alike if bits[k][d])
                    seen += 1
            first += len(p.counts)
        assert seen == sum(map(len, bits))


def test_probabilities_of_all_words_sum_to_less_than_one():
    r = np.random.default_rng(8)
    words = sorted({b"\x01" + bytes(r.choice(list(b"abc"), r.integers(0, 5))) for _ in range(80)}, key=lambda w: w + b" ")
    every = sorted({b"\x01" + bytes(c) for n in range(6) for c in itertools.product(b"abc", repeat=n)}, key=lambda w: w + b" ")
    counts = np.array([r.integers(1, 50) if w in words else 0 for w in every])
    pages, between, outside = pages_of(every, counts, [len(every)])
    tables = np.zeros(2 * bitmix.SLOTS)
    bitmix.table_counts(pages[0], tables)
    learner = bitmix.Learner.start(tables[:bitmix.SLOTS], tables[bitmix.SLOTS:])
    for _ in range(20):
        learner.learn(pages[0], outside, -1, -1)
    model = bitmix.Model.finish(learner.zeros, learner.ones, learner.weights, learner.seen, learner.hits)
    p = 10 ** model.log10(pages[0], outside, -1, -1)
    assert 0.8 < p.sum() <= 1 + 1e-9 and p[counts > 0].sum() > 0.7


def test_mixing_with_the_text_itself_stays_a_probability():
    logs = np.log10(np.array([0.5, 0.3, 0.2]))
    for n in (1, 3, 5):  # over all texts of a closed vocabulary the probabilities sum to one
        texts = np.array(list(itertools.product(range(3), repeat=n)))
        got = lm.text_scores(np.full(len(texts), n), texts.ravel(), np.arange(3), logs)
        assert abs((10 ** got).sum() - 1) < 1e-9


def test_a_shuffled_text_scores_lower_than_its_original(spark):
    r = random.Random(6)
    words = [f"w{i}" for i in range(60)]
    after = {w: r.sample(words, 2) for w in words}

    def prose(n):
        out = [r.choice(words)]
        while len(out) < n:
            out.append(r.choice(after[out[-1]]))
        return out

    rows = [(i, " ".join(prose(80))) for i in range(300)]
    originals = [prose(80) for _ in range(20)]
    rows += [(1000 + i, " ".join(t)) for i, t in enumerate(originals)]
    rows += [(2000 + i, " ".join(r.sample(t, len(t)))) for i, t in enumerate(originals)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {x["doc_id"]: x["score"] for x in lm.score_texts(docs.repartition(4), lm.F.col("doc_id") < 1000).collect()}
    assert all(found[1000 + i] > found[2000 + i] + 20 for i in range(20))


def test_probabilities_after_a_word_sum_to_one():
    own = np.log10(np.array([0.5, 0.3, 0.2]))
    for log in lm.after_word(own, np.array([4, 0, 3]), np.full(3, 7)):
        assert abs((10 ** log).sum() - 1) < 1e-9
    numbers = np.array([0, 1, 2**40, 2**64 - 1], np.uint64)
    assert (lm.unpacked(lm.packed(numbers)) == numbers).all()


def test_states_are_learned_from_every_text(spark):
    """More texts than the old sample of 4000 had: every one counts, so two runs and any partitioning agree, and the counts of a
    frequent word add up to all its occurrences."""
    from pyspark.sql import functions as F
    from quayline.llm import lm
    docs = spark.range(9000).select(F.when(F.col("id") % 3 == 0, "Der und die").when(F.col("id") % 3 == 1, "the and of")
                                    .otherwise("le la\tles").alias("_text"))
    docs = docs.unionByName(spark.createDataFrame([("rare rare rare " * 5,), ("",), ("  ",)], "_text string"))
    assert sorted(lm.frequent_words(docs)) == sorted("der und die the and of le la les rare".split())
    blocks = lm.anchor_counts(docs, ["the", "rare"])
    assert blocks.agg(F.sum("n")).first()[0] == 3001
    evidence = lm.learn_states(docs)
    assert set(evidence) == {w.encode() for w in "der und die the and of le la les rare".split()}
    other = lm.learn_states(docs.repartition(5))
    best = {w: int(e.argmax()) for w, e in evidence.items()}
    assert best[b"the"] == best[b"and"] != best[b"der"] == best[b"und"] and best[b"rare"] not in (best[b"the"], best[b"le"])
    assert {w: e.max() for w, e in evidence.items()} == {w: e.max() for w, e in other.items()}
    assert lm.learn_states(docs.limit(0)) == {}


def test_commonest_words_are_exact_though_rare_ones_are_kept_back(spark, monkeypatch):
    """Parts of texts pass on few words; all three ways from these to the commonest give what counting every word gives."""
    r = random.Random(12)
    monkeypatch.setattr(lm, "ANCHORS", 8)
    common, rare = [f"c{i}" for i in range(12)], [f"r{i}" for i in range(3000)]
    texts = [" ".join(r.choices(common, range(12, 0, -1), k=30) + r.sample(rare, 20)) for _ in range(400)]
    sided = [t + " side" for t in texts[:20]] + texts[20:] + ["Side " * 255] * 3  # common in one part, rare in another
    flat = [" ".join(rare[i::40]) for i in range(40)]
    recounts = []
    counts = lm.word_counts
    monkeypatch.setattr(lm, "word_counts", lambda docs, share=0.0, wanted=None: recounts.append((share, wanted)) or counts(docs, share, wanted))
    for rows, share, ways in ((texts, 0.01, 1), (sided, 0.01, 2), (flat, 0.9, 2), ([], 0.01, 1), (["", " "], 0.01, 1)):
        docs = spark.createDataFrame(spark.sparkContext.parallelize([(t,) for t in rows], 9), "_text string")
        n = Counter(w for t in rows for w in t.lower().split())
        monkeypatch.setattr(lm, "RARE", share)
        recounts.clear()
        assert lm.frequent_words(docs) == sorted(sorted(n, key=lambda w: (-n[w], w))[:8])
        assert len(recounts) == ways
        if rows is texts:
            assert counts(docs, share).count() < 200 < len(n)
        if rows is sided:
            assert n["side"] == 785 > n["c7"]


def test_words_are_numbered_as_plain_python_does():
    texts = ["", "  ", " a\tB\x0b\x1c\x01 a ", "É é Ä x", "a", "a\x01 a\x01b a", "\x00", "the THE\r\nthe"]
    parts = lm.pa.array(["not this", *texts]).slice(1)
    code, length, known = lm.numbered_words(parts)
    words = [words_of(t) for t in texts]
    spelled = sorted({w + b" " for t in words for w in t})
    assert lm.spaced(known) == b"".join(spelled) and length.tolist() == [len(t) for t in words]
    assert [spelled[c][:-1] for c in code] == [w for t in words for w in t]


def test_words_have_hashes_of_their_own_wherever_they_stand():
    r = random.Random(5)
    words = sorted({bytes(r.choices(b"ab\x00\x01\xc3", k=r.randint(0, 20))) for _ in range(5000)} | {b"a" * n for n in range(100)})
    found = lm.word_digests(b"".join(w + b" " for w in words))
    assert len(set(found.tolist())) == len(words) and len(set((found >> np.uint64(32)).tolist())) > len(words) - 20
    mixed = r.sample(range(len(words)), 500)
    assert (lm.word_digests(b"".join(words[i] + b" " for i in mixed)) == found[mixed]).all()
    assert len(lm.word_digests(b"")) == 0
