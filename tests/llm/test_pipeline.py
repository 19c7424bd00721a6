"""The pipeline's stages, each against the operator or a loop on its own input."""

import re
from collections import Counter

import pytest

import __spark_entry__ as contract
import corpus_pipeline
from quayline.llm import mixing, quality
from quayline.llm.registry import ORACLES, QUERIES
from test_packing import check_places, reference
from test_shingles import brute


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    folder = "/root/testdata/sf0.01"
    docs, found = spark.read.parquet(f"{folder}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("steps") / name)
        stage(spark, docs, folder).write.parquet(path)
        found[name] = (docs, spark.read.parquet(path))
        docs = found[name][1]
    return found


def ids(df):
    return {r["doc_id"] for r in df.select("doc_id").collect()}


def test_stages_are_in_order_and_return_documents(steps):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "exact_copies", "near_copies", "mixing", "packing"]
    for name, (before, after) in steps.items():
        if name != "packing":
            assert after.columns == before.columns and after.subtract(before).count() == 0
            if name == "mixing":  # nothing goes, some is repeated
                assert before.exceptAll(after).count() == 0 < after.exceptAll(before).count()
            else:
                assert after.exceptAll(before).count() == 0 < after.count() < before.count()


def test_quality(spark, steps):
    before, after = steps["quality"]
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    model = quality.labelled_model(before, labels)
    assert ids(after) == ids(quality.score(before, model, column="s").where(f"s >= {quality.THRESHOLD}"))


def test_exact_copies(steps):
    before, after = steps["exact_copies"]
    first = {}
    for r in sorted(before.collect(), key=lambda r: r["doc_id"]):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", r["text"]), r["doc_id"])
    assert ids(after) == set(first.values())


def test_near_copies(steps):
    before, after = steps["near_copies"]
    rows = [(r["doc_id"], r["text"]) for r in before.collect()]
    assert ids(after) == {c for _, _, c in brute(rows)}


def test_mixing(spark, steps):
    before, after = steps["mixing"]
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rates = mixing.mixing_rates(before, mixing.language_labels(before, labels), mixing.TARGETS, keep_all=True)
    copies = {r["doc_id"]: r["copies"] for r in rates.collect()}
    assert {r["doc_id"]: r["count"] for r in after.groupBy("doc_id").count().collect()} == copies
    tokens = {d: 0.0 for d in mixing.TARGETS}
    for r in rates.collect():
        for d, p in r["memberships"].items():
            tokens[d] += p * r["tokens"] * r["rate"]
    assert all(abs(t / sum(tokens.values()) - mixing.TARGETS[d]) < 1e-4 for d, t in tokens.items())


def test_packing(steps):
    before, after = steps["packing"]
    rows = after.collect()
    times = {r["doc_id"]: r["count"] for r in before.groupBy("doc_id").count().collect()}
    assert Counter(r["doc_id"] for r in rows if r["piece"] == 0) == times
    texts = {r["doc_id"]: r["text"] for r in before.collect()}
    for doc in sorted(texts)[:40]:
        parts = sorted((r["start"], r["ids"]) for r in rows if r["doc_id"] == doc)
        assert [x for _, p in parts[::times[doc]] for x in p] == reference(texts[doc])
    assert check_places(rows) <= 1.02 * -(-sum(r["length"] for r in rows) // 1024) + 2


def test_stages_take_awkward_documents(spark, tmp_path):
    rows = [(1, "same text here", "en", "s", 3), (1, "same text here", "en", "s", 3), (1, "other text", "de", None, None), (None, "same text here", None, "s", 0),
            (2, None, None, None, None), (3, "", "xx", "s", 0), (4, "w " * 40_000, "fr", "s", 1), (None, None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumn("_key", quality.F.lit("k"))
    spark.createDataFrame([(1, 1, 0), (4, 1, None), (None, None, None)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    for some in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            after = stage(spark, some, str(tmp_path))
            if name != "packing":
                assert after.columns == docs.columns
            after.collect()
    assert corpus_pipeline.exact_copies(spark, docs, "").count() == 4  # empty, "same text here", "other text" and the long one
    assert corpus_pipeline.near_copies(spark, docs, "").count() == 6  # each empty text is a group, but for repeated rows


def test_every_operator_is_registered():
    names = contract.queries()
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(names) and set(ORACLES) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, folder, name):
    from oracle import differences, duck
    connection = duck(folder)
    for t in ("documents", "pages"):
        connection.execute(f"CREATE OR REPLACE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    assert differences(QUERIES[name](spark, folder), connection, ORACLES[name]) is None
