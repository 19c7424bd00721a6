"""Mixing rates against the same least squares on one machine."""

import numpy as np

from quayline.llm import mixing


def test_rates_solve_the_least_squares(spark, folder):
    folder = folder.replace("0.001", "0.01")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    df = mixing.mixing_rates(docs, mixing.language_labels(docs, labels), mixing.TARGETS)
    assert "Python" not in df._jdf.queryExecution().executedPlan().toString()
    rows = df.toPandas()
    assert len(rows) == docs.count() and rows["tokens"].tolist() is not None
    domains = sorted(mixing.TARGETS)
    p = np.array([[m[d] for d in domains] for m in rows["memberships"]])
    tokens, rate = rows["tokens"].to_numpy(float), rows["rate"].to_numpy()
    assert np.allclose(p.sum(axis=1), 1) and (rate >= 0).all()
    mass = tokens @ p
    weights = np.array([mixing.TARGETS[d] for d in domains])
    target = weights * (mass / weights).min()
    assert np.allclose((tokens * rate) @ p, target, rtol=1e-4)
    r = np.ones(len(rows))
    for _ in range(500):  # the same descent, longer
        r = np.maximum(0, r - p @ (((tokens * r) @ p - target) / mass))
    assert np.allclose(r, rate, atol=1e-3)
    assert (np.abs(rows["copies"] - rate) < 1 + 1e-9).all()
    langs = dict(docs.select("doc_id", "lang").collect())
    best = [domains[i] for i in p.argmax(axis=1)]
    assert np.mean([langs[i] == b for i, b in zip(rows["doc_id"], best)]) > 0.97
    words = {r["doc_id"]: len(r["text"].split()) for r in docs.collect()}
    assert {i: t for i, t in zip(rows["doc_id"], rows["tokens"])} == words


def test_awkward_rows_and_targets(spark):
    rows = [(1, "aa aa bb", "x"), (2, "cc cc dd", "y"), (3, None, "x"), (4, "", None), (None, " \n", "y"), (5, "aa " * 5000, "z"), (5, "cc", "y"),
            (5, "cc", "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _domain string")
    labelled = docs.withColumnRenamed("_domain", "domain")
    found = mixing.mixing_rates(docs, labelled, {"x": 1, "y": 1, "not there": 2}, total=30.0).collect()
    assert len(found) == len(rows) and all(r["rate"] >= 0 and abs(sum(r["memberships"].values()) - 1) < 1e-9 for r in found)
    tokens = {r["doc_id"]: r["tokens"] for r in found if r["doc_id"] in (1, 2, 3, 4, None)}
    assert tokens == {1: 3, 2: 3, 3: 0, 4: 0, None: 0}
    assert mixing.mixing_rates(docs.limit(0), labelled, {"x": 1}).collect() == []
    assert all(r["rate"] == 1 for r in mixing.mixing_rates(docs.where("text = ''"), labelled, {"x": 1}).collect())
    nothing = mixing.mixing_rates(docs, labelled.limit(0), {"x": 1, "y": 3}, total=6.0).collect()
    assert len(nothing) == len(rows)


def test_mix_returns_documents(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    kept = mixing.mix(docs, labels)
    assert kept.columns == docs.columns and 0 < kept.count() < docs.count()
    rates = mixing.mixing_rates(docs, mixing.language_labels(docs, labels), mixing.TARGETS)
    assert {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in rates.where("copies > 0").collect()}
    double = docs.union(docs)
    assert mixing.mix(double, labels).count() % 2 == 0


def two_of_three(spark):
    """1,000 texts of two languages with words of their own, and a third language that no row has."""
    rows = [(i, " ".join(f"{'xy'[i % 2]}{(i * 7 + j) % 50}" for j in range(20)) + f" new{i}", "xy"[i % 2]) for i in range(1000)]
    return spark.createDataFrame(rows, "doc_id long, text string, domain string")


def test_domain_without_labelled_rows_is_left_out_of_the_default_total(spark):
    docs = two_of_three(spark)
    found = mixing.mixing_rates(docs, docs.where("doc_id < 200"), {"absent": 1, "x": 1, "y": 1}).toPandas()
    assert all(m["absent"] == 0 and abs(sum(m.values()) - 1) < 1e-9 for m in found["memberships"])
    assert (found["rate"] > 0.95).all() and found["copies"].mean() > 0.95  # x and y are there in equal parts
    untaught = mixing.mixing_rates(docs, docs.limit(0), {"x": 1, "y": 3}).toPandas()
    assert (untaught["copies"] == 1).all()


def test_every_document_stays_and_scarce_domains_are_repeated(spark, folder):
    folder = folder.replace("0.001", "0.01")
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    rates = mixing.op3_soft_membership_mixing(spark, folder)
    assert "Python" not in rates._jdf.queryExecution().executedPlan().toString()
    rows = rates.toPandas()
    assert len(rows) == docs.count() and (rows["copies"] >= 1).all() and rows["rate"].min() == 1
    p = rows[[f"p_{d}" for d in sorted(mixing.TARGETS)]].to_numpy()
    used = (rows["tokens"] * rows["rate"]).to_numpy() @ p
    assert np.allclose(used / used.sum(), [mixing.TARGETS[d] for d in sorted(mixing.TARGETS)], rtol=1e-4)
    for some in (docs, docs.union(docs)):
        kept = mixing.mix(some, labels, keep_all=True)
        assert kept.columns == docs.columns and some.exceptAll(kept).count() == 0
    copies = dict(zip(rows["doc_id"], rows["copies"]))
    found = mixing.mix(docs, labels, keep_all=True).groupBy("doc_id").count().collect()
    assert {r["doc_id"]: r["count"] for r in found} == copies


def test_a_domain_of_one_in_a_thousand_costs_no_documents(spark):
    docs = two_of_three(spark).union(spark.createDataFrame([(1000, " ".join(f"z{j}" for j in range(20)), "z")], "doc_id long, text string, domain string"))
    found = mixing.mixing_rates(docs, docs, {"absent": 1, "x": 2, "y": 2, "z": 1}, keep_all=True).toPandas()
    assert (found["copies"] >= 1).all()
    p = np.array([[m[d] for d in "xyz"] for m in found["memberships"]])
    used = (found["tokens"] * found["rate"]).to_numpy() @ p
    assert np.allclose(used / used.sum(), [0.4, 0.4, 0.2], rtol=1e-4)
    untaught = mixing.mixing_rates(docs, docs.limit(0), {"x": 1, "y": 3}, total=6.0, keep_all=True).toPandas()
    assert (untaught["copies"] >= 1).all() and len(mixing.mixing_rates(docs.limit(0), docs, {"x": 1}, keep_all=True).collect()) == 0


def test_the_query_follows_the_projected_gradient(spark, folder):
    """The rates of op3 are those of the same descent in NumPy, from rates of 1, projected to 1 at least."""
    folder = folder.replace("0.001", "0.01")
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    found = mixing.op3_soft_membership_mixing(spark, folder).toPandas()
    labelled, domains = mixing.language_labels(docs, labels), sorted(mixing.TARGETS)
    prior = mixing.labelled_rows(labelled, domains, "domain")
    assert list(prior) == domains
    members = mixing.memberships(docs, labelled, prior, "domain", "doc_id", "text")
    steps, target, now = mixing.solve(members, [mixing.TARGETS[d] for d in domains], keep_all=True)
    assert 1 <= len(steps) < mixing.STEPS
    assert sum(abs(a - b) for a, b in zip(now, target)) <= mixing.TOLERANCE * sum(target)
    rows = members.toPandas().set_index("_key").loc[found["doc_id"]]
    p, tokens = rows[[f"p{i}" for i in range(len(domains))]].to_numpy(), rows["tokens"].to_numpy(float)
    mass, rate = tokens @ p, np.ones(len(p))
    for _ in steps:
        rate = np.maximum(1, rate - p @ (((tokens * rate) @ p - target) / mass))
    assert np.allclose(found["rate"], rate, atol=2e-6) and rate.max() > 1.5
