"""Encoding and decoding against the SentencePiece library."""

import hashlib
import random
from array import array

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from quayline.llm import wordpieces

PATH = wordpieces.model_file()
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)
MODEL = wordpieces.Model(PATH)
TEXTS = [
    None, "", " ", "a", "  two  blanks ", "a\x00b\x01", "tab\tand\r\nlines\n\n", "▁x", "x▁▁y", "<s>a</s><unk>", "a<0x0A>b",
    "﻿mark", "naïve façade 漢字 かな 한글 🙂🙂 \U0010ffff", "x" * 120_000, "ab " * 30_000, " " * 5_000, "🙂" * 3_000,
    "zq" * 20_000 + "é" * 99, "퟿�", "'" * 77]


def ids_of(model, text):
    return list(array("i", model.encode(text)))


def test_awkward_texts_with_other_columns(spark):
    docs = spark.createDataFrame([(i, t, i) for i, t in enumerate(TEXTS)], "doc_id long, text string, ids int")
    rows = (docs.repartition(3).withColumn("found", wordpieces.encoded(F.col("text")))
            .withColumn("back", wordpieces.decoded(F.col("found"))).collect())
    assert len(rows) == len(TEXTS)
    for r in rows:
        assert r["ids"] == r["doc_id"] and r["found"] == LIBRARY.encode(r["text"] or "")
        assert r["back"] == LIBRARY.decode(r["found"])
    both = docs.select("doc_id", wordpieces.round_trip(F.col("text")).alias("x")).select("doc_id", "x.*").collect()
    assert {(r["doc_id"], tuple(r["ids"]), r["text"]) for r in both} == {(r["doc_id"], tuple(r["found"]), r["back"]) for r in rows}
    assert docs.limit(0).withColumn("found", wordpieces.encoded(F.col("text"))).collect() == []
    assert spark.sql("select cast(null as array<int>) ids").select(wordpieces.decoded(F.col("ids"))).first()[0] == ""


@settings(max_examples=400, deadline=None)
@given(st.one_of(st.text(max_size=60), st.text(alphabet="abeinrst  ▁\n", max_size=80),
                 st.lists(st.sampled_from(sorted(MODEL.ids)), max_size=8).map("".join)))
def test_any_text(text):
    text = text.encode("utf-8", "ignore").decode()
    ids = ids_of(MODEL, text)
    assert ids == LIBRARY.encode(text) and MODEL.decode(ids) == LIBRARY.decode(ids)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 31_999), st.integers(0, 300)), max_size=12))
def test_any_ids(ids):
    assert MODEL.decode(ids) == LIBRARY.decode(ids)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.one_of(st.integers(0, 31_999), st.integers(0, 300)), max_size=9), max_size=9))
def test_any_rows_of_ids(rows):
    flat, ends = np.array([i for r in rows for i in r], np.int32), np.cumsum([len(r) for r in rows], dtype=np.int64)
    assert MODEL.decode_all(flat, ends).to_pylist() == [LIBRARY.decode(r) for r in rows]


def test_pairs_replay_as_they_merge():
    r, names = random.Random(8), sorted(MODEL.ids)
    short = [p for p in names if len(p) <= 3 and p.isascii()]
    pairs = [r.choices(names, k=2) for _ in range(20_000)] + [r.choices(short, k=2) for _ in range(60_000)]
    fits = [MODEL._fits(MODEL.ids[a], MODEL.ids[b]) for a, b in pairs]
    assert fits == [MODEL.merged(a + b) == [a, b] for a, b in pairs] and 1_000 < sum(fits) < 79_000


def test_forgetting_changes_nothing(monkeypatch):
    monkeypatch.setattr(wordpieces, "REMEMBERED", 2)
    small, r = wordpieces.Model(PATH), random.Random(5)
    for _ in range(300):
        text = "".join(r.choices("abcdeinorst  -", k=r.randint(0, 50)))
        assert ids_of(small, text) == LIBRARY.encode(text)
    assert len(small.known_words) <= 2 and small.known_pairs.size <= 2


def test_a_search_that_has_to_step_back():
    """Words that do not begin with the longest piece that they could."""
    r, names = random.Random(6), sorted(p for p in MODEL.ids if wordpieces.BLANK not in p)
    words = ["".join(r.choices(names, k=3)) for _ in range(20_000)]
    longest = {t: max((t[:n] for n in range(1, 20) if t[:n] in MODEL.ids), key=len) for t in words}
    steps = [t for t in words if MODEL.merged(t)[0] != longest[t]]
    assert len(steps) > 500
    assert all(MODEL._search(t) == [MODEL.ids[p] for p in MODEL.merged(t)] for t in steps)


def test_other_models_raise(tmp_path):
    from sentencepiece import sentencepiece_model_pb2 as proto
    for change in ("unigram", "spaces", "charsmap", "own"):
        model = proto.ModelProto()
        with open(PATH, "rb") as file:
            model.ParseFromString(file.read())
        if change == "unigram":
            model.trainer_spec.model_type = proto.TrainerSpec.UNIGRAM
        elif change == "spaces":
            model.normalizer_spec.remove_extra_whitespaces = True
        elif change == "charsmap":
            model.normalizer_spec.precompiled_charsmap = b"x"
        else:
            model.pieces[400].type = proto.ModelProto.SentencePiece.USER_DEFINED
        (tmp_path / change).write_bytes(model.SerializeToString())
        with pytest.raises(ValueError):
            wordpieces.Model(str(tmp_path / change))


def test_the_query(spark, folder):
    def sha(text):
        return hashlib.sha256(text.encode()).hexdigest()

    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = wordpieces.op12_piece_backtracking(spark, folder).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = LIBRARY.encode(texts[r["doc_id"]])
        assert tuple(r) == (r["doc_id"], len(ids), sha(",".join(map(str, ids))), sha(LIBRARY.decode(ids)))
