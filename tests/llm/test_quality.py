"""The quality classifier: held-out labels, risk and awkward rows."""

import zlib

import numpy as np

from quayline.llm import quality


def test_held_out_labels(spark, folder):
    folder = folder.replace("0.001", "0.1")
    scored = quality.op6_positive_unlabelled_quality(spark, folder).toPandas()
    assert len(scored) == spark.read.parquet(f"{folder}/documents.parquet").count()
    assert scored["held_out"].tolist() == [zlib.crc32(str(i).encode()) % 5 == 0 for i in scored["doc_id"]]
    assert scored["score"].between(0, 1).all() and ((scored["score"] >= 0.3) == (scored["predicted"] == 1)).all()
    labels = spark.read.parquet(f"{folder}/labels.parquet").toPandas()
    held = scored[scored["held_out"]].merge(labels, on="doc_id")
    good, bad = held[held["quality"] == 1], held[held["quality"] == 0]
    assert good["predicted"].mean() > 0.98 and bad["predicted"].mean() < 0.1
    order = np.searchsorted(np.sort(bad["score"].to_numpy()), good["score"].to_numpy()) / len(bad)
    assert order.mean() > 0.99  # area under the curve


def test_prior_and_risk_on_separable_data():
    r = np.random.default_rng(0)
    k = len(quality.FEATURES)
    good = lambda n: r.normal(1, 0.4, (n, k))
    bad = lambda n: r.normal(-1, 0.4, (n, k))
    model = quality.fit(good(2000), np.vstack([good(1400), bad(600)]))
    assert 0.55 < model.prior < 0.75
    assert (model.score(good(500)) >= 0.3).mean() > 0.97 and (model.score(bad(500)) < 0.3).mean() > 0.97


def test_awkward_rows(spark):
    docs = spark.createDataFrame([(1, None, 0.5), (2, "", 0.5), (None, "some words", 0.5), (3, "w" * 200_000, 0.5), (3, "a b", 0.5),
                                  (3, "a b", 0.5)], "doc_id long, text string, score double")
    labels = spark.createDataFrame([(1, 1, 0), (3, 1, 0), (3, 1, 1), (None, 1, 0), (2, None, None)], "doc_id long, quality int, toxic int")
    found = quality.score(docs, quality.labelled_model(docs, labels))
    assert found.columns == ["doc_id", "text", "score", "_score"]
    assert all(0 <= r["_score"] <= 1 for r in found.collect()) and found.count() == 6
    assert quality.labelled_model(docs, labels.limit(0)) is None
    assert quality.keep_good(docs, labels.limit(0)).count() == 6 and quality.keep_good(docs, labels).columns == docs.columns
    assert quality.keep_good(docs.limit(0), labels).collect() == []
