"""Collocations against plain counting."""

import random
import re
from collections import Counter, defaultdict

import pytest

from quayline.llm import collocations


def brute(rows, at_least, top, longest=5):
    counts, totals = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", lower):
            words = [w for w in re.split("[ \t]+", piece) if w]
            totals[lang] += len(words)
            for k in range(1, longest + 1):
                counts[lang].update(tuple(words[i:i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, found in counts.items():
        often = {g: a for g, a in found.items() if a >= at_least}
        lines = []
        for g, a in often.items():
            if len(g) < 2 or any(b >= a and any(h[i:i + len(g)] == g for i in range(len(h) - len(g) + 1))
                                 for h, b in often.items() if len(h) > len(g)):
                continue
            score, k = min((1000 * a * totals[lang] // (found[g[:k]] * found[g[k:]]), k) for k in range(1, len(g)))
            lines.append((-score, -a, " ".join(g).encode(), found[g[:k]], found[g[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(lines)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


def texts(seed, number=120):
    r = random.Random(seed)
    words = ["the", "of", "a", "Blue", "sea", "é", "ÀB", "漢字", "x-y", "|", "«q»"]
    passages = [" ".join(r.choices(words, k=30)) for _ in range(3)]
    for _ in range(number):
        parts = r.choices([*words, "\t", " ", ".", ", ", "\n", "\r", "\x0b", "!?", *passages], [9] * len(words) + [3] * 11, k=r.randint(0, 40))
        yield r.choice(["en", "en", "de", None, "und"]), "".join(p + r.choice([" ", " ", "  ", "\t", ""]) for p in parts)


AWKWARD = [(None, None), ("en", None), ("en", ""), ("en", " \t "), ("en", ".,;"), ("de", "The the"), (None, "sea " * 9_000),
           ("en", "a" * 50_000 + " the of"), ("de", "one.two,three;four"), ("xx", "alone"), ("en", "of the sea a a a a a a a")]


@pytest.mark.parametrize("limit", [2_000_000, 0, 14])
@pytest.mark.parametrize("at_least, top", [(3, 50), (12, 7)])
def test_any_way_of_counting(spark, rows, limit, at_least, top):
    data = [*texts(1), *texts(1, 30), *AWKWARD]
    docs = spark.createDataFrame([(i, x, g, 0, "k") for i, (g, x) in enumerate(data)],
                                 "doc_id long, text string, lang string, _chunk int, phrase string").repartition(5)
    got = collocations.collocations(docs, at_least=at_least, top=top, every=3, limit=limit)
    assert rows(got) == sorted(brute(data, at_least, top), key=repr)


def test_borders_have_no_influence(spark, rows):
    data = [*texts(2), *AWKWARD]
    docs = spark.createDataFrame([(x, g) for g, x in data], "text string, lang string")
    results = [rows(collocations.collocations(docs, at_least=4, every=n, longest=4)) for n in (1, 2, 7, 10_000)]
    assert results[0] and all(r == results[0] for r in results)


def test_every_phrase_is_in_one_chunk():
    data = [(x or "").encode() for _, x in [*texts(3), *AWKWARD]]
    for every in (1, 4, 1 << 20):
        which, own, chunks, held = collocations.parse(data, every)
        assert (own >= 1).all() and (held >= own).all() and (held <= own + 4).all()
        assert [len(c.split(b" ")) for c in chunks] == held.tolist()
        assert sorted(set(which)) == [i for i, t in enumerate(data) if re.search(rb"[^ \t.,;:!?\n\x0b\x0c\r]", t)]


def test_copies_share_their_chunks(spark):
    passage = " ".join(random.Random(9).choices("abcdefghijklmnop", k=400))
    docs = spark.createDataFrame([(f"{'q r ' * i}{passage}", "en") for i in range(40)], "text string, lang string")
    found = collocations.dictionary(docs, every=8)
    assert found.agg({"_weight": "sum"}).first()[0] > 10 * found.where("_weight >= 40").count() > 100
    assert found.count() < 200


def test_scores_past_64_bits(spark):
    row = [("en", "a b", 2, 3_000_000_000), ("en", "a", 1, 3_000_000_001), ("en", "b", 1, 3_000_000_002)]
    phrases = spark.createDataFrame(row, "_group string, phrase string, _size int, a long")
    totals = spark.createDataFrame([("en", 9_000_000_000_000)], "_group string, n long")
    line = collocations.scored(phrases, totals).first()
    assert line["score"] == 1000 * row[0][3] * 9_000_000_000_000 // (row[1][3] * row[2][3])


def test_empty_tables_and_bounds(spark):
    docs = spark.createDataFrame([("a b", "en")], "text string, lang string")
    assert collocations.collocations(docs.limit(0)).collect() == collocations.collocations(docs).collect() == []
    with pytest.raises(ValueError):
        collocations.collocations(docs, longest=6)
