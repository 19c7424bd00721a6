"""Packing against the tokenizer itself, on awkward texts and lengths."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from quayline.llm import packing

TEXTS = [
    None, "", " ", "a", "plain words, as they come.", " leading and trailing ", "two  blanks   and more", "tab\tand\nlines\n\n  x",
    "it's we'll don't 's 'll", "naïve façade — ÄÖÜ ß 漢字 かな 한글 🙂🙂  nbsp   x y", "12345 6 7,890.12 a1b2",
    "x " * 3000, "long" * 2000, "\x00\x01 control", "a  b  c", "a\n b\r\n c", "<tag> </tag>", "a" * 1024 + " b",
]


def reference(text):
    return packing.Encoder(packing.tokenizer_files()[0], None).encode(text or "") + [packing.END]


def test_both_encoders_agree():
    plain, fast = packing.Encoder(packing.tokenizer_files()[0], None), packing.Encoder(*packing.tokenizer_files())
    frames = ("X", "aXb", " X ", "a X b", "aX Xb", "XX", "1X2", "  X\n", "X's", "'Xs", " XX a", "!X!")
    texts = [f.replace("X", chr(c)) for c in range(0x260) for f in frames]
    r = random.Random(3)
    texts += ["".join(r.choices("abcxyzABC '.,!-0123\n\t éß\xa0\x85", k=r.randint(0, 60))) for _ in range(3000)]
    texts += ["a" * 50_000, "!" * 20_000, " " * 20_000, "x<|endoftext|>y", "漢字 🙂 <|endoftext|>"]
    assert all(fast.fast.encode_ordinary(t) == plain.encode(t) for t in texts if not fast.UNLIKE.search(t))
    assert all(fast.encode(t) == plain.encode(t) for t in texts)


def test_pieces_are_the_tokens_of_the_text(spark):
    docs = spark.createDataFrame([(i, t, i) for i, t in enumerate(TEXTS)], "doc_id long, text string, _key int")
    rows = packing.pack(docs.repartition(3)).collect()
    got = defaultdict(dict)
    for r in rows:
        got[r["doc_id"]][r["piece"]] = r
    for i, text in enumerate(TEXTS):
        parts = [got[i][n] for n in range(len(got[i]))]
        ids = reference(text)
        assert [x for p in parts for x in p["ids"]] == ids, text
        assert [p["start"] for p in parts] == list(np.cumsum([0] + [p["length"] for p in parts])[:-1])
        assert all(p["length"] == 1024 for p in parts[1:]) and len(parts) == -(-len(ids) // 1024)
    check_places(rows)
    digest = {(r["doc_id"], r["piece"]): r["ids_crc32"] for r in packing.pack(docs, payload="ids_crc32").collect()}
    assert digest == {(r["doc_id"], r["piece"]): zlib.crc32(np.array(r["ids"], "<u4").tobytes()) for r in rows}
    whole = {r["sequence_id"]: r["ids"] for r in packing.sequences(packing.pack(docs)).collect()}
    assert Counter(x for ids in whole.values() for x in ids) == Counter(x for t in TEXTS for x in reference(t))


def check_places(rows, capacity=1024):
    sequences = defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= capacity
    return len(sequences)


def test_repeated_rows_null_keys_and_no_rows(spark):
    docs = spark.createDataFrame([(1, "same text")] * 5 + [(None, "no key")] * 2, "doc_id long, text string")
    rows = packing.pack(docs).collect()
    assert len(rows) == 7 and check_places(rows) == 1
    assert len({(r["sequence_id"], r["offset"]) for r in rows}) == 7
    assert packing.pack(docs.limit(0)).collect() == []


@pytest.mark.parametrize("draw, slack", [
    (lambda r: r.randint(1, 1023), 1.012), (lambda r: min(1024, int(r.lognormvariate(6, 1)) + 1), 1.005),
    (lambda r: 1024, 1.0), (lambda r: 5, 1.004), (lambda r: r.choice((1, 2, 3)), 1.001)])
def test_plan_places_all_in_few_sequences(draw, slack):
    r = random.Random(7)
    counts = Counter(draw(r) for _ in range(20_000))
    used, bins = set(), defaultdict(list)
    for length, rank, pieces, first, offset in packing.plan(counts):
        for i in range(pieces):
            assert (length, rank + i) not in used
            used.add((length, rank + i))
            bins[first + i].append((offset, length))
    assert Counter(n for n, _ in used) == counts and all(rank < counts[n] for n, rank in used)
    for parts in bins.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 1024
    assert len(bins) <= slack * -(-sum(n * c for n, c in counts.items()) // 1024) + 1


def test_large_counts_need_no_more_work():
    few, many = ({n: c * 10 ** 9 for n in range(1, 1024)} for c in (1, 7))
    assert len(packing.plan(many)) < 1.2 * len(packing.plan(few))
