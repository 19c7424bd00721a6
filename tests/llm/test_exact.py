"""Exact de-duplication against a dictionary."""

import hashlib
import re
from collections import defaultdict

import pytest

from quayline.llm import exact

ROWS = [(5, "a b"), (3, "a  b"), (9, "a\tb"), (2, "a b "), (7, None), (8, ""), (6, " "), (1, "A b"), (4, "x" * 5000),
        (None, "a b"), (None, "only one"), (3, "a\nb"), (3, "a\nb"), (12, "é b"), (11, "é\x0b\x0cb"), (10, "a b")]
ROWS += [(100 + i, "many copies of a text") for i in range(300)]


def brute(rows):
    groups = defaultdict(list)
    for key, text in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", text or "")].append(key)
    out = set()
    for key, text in rows:
        text = re.sub(r"[\x20\x09-\x0D]+", " ", text or "")
        known = [k for k in groups[text] if k is not None]
        out.add((key, min(known) if known else None, len(groups[text]), hashlib.sha256(text.encode()).hexdigest()))
    return out, {t: (min(k for k in ks if k is not None) if set(ks) != {None} else None) for t, ks in groups.items()}


@pytest.mark.parametrize("fan, rounds", [(None, None), (2, 3), (5, 1), (3, 2)])
def test_groups_equal_brute_force(spark, fan, rounds):
    docs = spark.createDataFrame([(*r, 1) for r in ROWS], "doc_id long, text string, _run int").repartition(5)
    found = exact.duplicates(docs, fan=fan, rounds=rounds).collect()
    expected, first = brute(ROWS)
    assert len(found) == len(ROWS)
    assert {(r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in found} == expected
    kept = [r for r in found if r["kept"]]
    assert len(kept) == len({r["text_sha256"] for r in kept}) == len(first)
    assert all(r["doc_id"] == r["keep_id"] for r in kept)


def test_deduplicate_keeps_one_row_with_all_columns(spark):
    docs = spark.createDataFrame([(*r, 1, "n") for r in ROWS], "doc_id long, text string, _digest int, _name string")
    found = exact.deduplicate(docs.repartition(4))
    assert found.columns == docs.columns
    normal = [re.sub(r"[\x20\x09-\x0D]+", " ", r["text"] or "") for r in found.collect()]
    assert len(normal) == len(set(normal)) == len(brute(ROWS)[1])
    unique = [r for r in ROWS if r[0] is not None and r[0] != 3]
    docs = spark.createDataFrame(unique, "doc_id long, text string")
    _, first = brute(unique)
    assert {r["doc_id"] for r in exact.deduplicate(docs).collect()} == set(first.values())


def test_no_rows(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert exact.duplicates(docs).collect() == exact.deduplicate(docs).collect() == []
