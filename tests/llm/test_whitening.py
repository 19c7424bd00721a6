"""Whitening against NumPy."""

import numpy as np
import pytest

from quayline.llm import whitening


def brute(vectors, components=8):
    """Whole numbers, deviations, whitened rows and explained shares, by whole matrices."""
    x = np.floor(np.array(vectors, float) * 1024).astype(np.int64) + 100_000
    n, sums = len(x), x.sum(0)
    centred = (x * n - sums) / n
    values, parts = np.linalg.eigh(centred.T @ centred / n)
    values, parts = values[::-1], parts[:, ::-1]
    width = min(components, x.shape[1])
    return (((x * n - sums).astype(object) ** 2).sum(1), centred @ parts[:, :width] / np.sqrt(values[:width]),
            values[:width] / values.sum())


def result(df, key="vec_id"):
    out = {}
    for r in df.collect():
        out.setdefault(r[key], {})[r["component"]] = r
    return out


def test_the_query(spark, folder):
    rows = spark.read.parquet(f"{folder}/embeddings.parquet").collect()
    dev, white, share = brute([r["embedding"] for r in rows])
    got = result(whitening.op11_block_whitening(spark, folder))
    assert got.keys() == {r["vec_id"] for r in rows}
    ours = np.array([[got[r["vec_id"]][c + 1]["whitened"] for c in range(8)] for r in rows])
    assert np.abs(ours - white * np.sign((ours * white).sum(0))).max() < 1e-9
    for r, d in zip(rows, dev):
        for c, line in got[r["vec_id"]].items():
            assert (line["n"], line["deviation"], int(line["deviation_exact"])) == (len(rows), d, d)
            assert abs(line["explained"] - share[c - 1]) < 1e-12 and line["identity_error"] < 1e-9


def test_awkward_rows(spark, monkeypatch):
    monkeypatch.setattr(whitening, "BLOCK_ENTRIES", 12)  # blocks of four rows
    r = np.random.default_rng(4)
    good = [(i, r.standard_normal(3).tolist()) for i in range(40)]
    good += [(7, good[7][1]), (7, good[8][1]), (None, good[3][1])] + [(100 + i, good[0][1]) for i in range(20)]
    nan, inf = float("nan"), float("inf")
    bad = [(300, None), (301, []), (302, [1.0, None, 2.0]), (303, [nan, 0.0, 0.0]), (304, [0.0, inf, 0.0]), (305, [0.0, 0.0, -inf]),
           (306, [1.0, 2.0]), (307, [1.0] * 4)]
    rows = good[:20] + bad + good[20:]
    df = spark.createDataFrame([(*x, 1, 2.0) for x in rows], "vec_id long, embedding array<double>, n int, _index double")
    dev, white, share = brute([v for _, v in good])
    lines = whitening.whiten(df.repartition(5)).collect()
    assert len(lines) == 3 * len(good) and {x["n"] for x in lines} == {len(good)}
    assert {x["vec_id"] for x in lines} == {i for i, _ in good}
    ours = {}
    for x in lines:
        ours.setdefault((x["vec_id"], x["deviation"]), {}).setdefault(x["component"], []).append(x["whitened"])
    signs = [np.sign(white[20, c] * ours[20, dev[20]][c + 1][0]) for c in range(3)]
    for (i, _), d, w in zip(good, dev, white):
        for c in range(3):
            assert any(abs(signs[c] * y - w[c]) < 1e-9 for y in ours[i, d][c + 1])
    assert all(abs(x["explained"] - share[x["component"] - 1]) < 1e-12 and x["identity_error"] < 1e-9 for x in lines)


def test_tables_without_variance(spark):
    schema = "vec_id long, embedding array<float>"
    assert whitening.whiten(spark.createDataFrame([], schema)).collect() == []
    assert whitening.whiten(spark.createDataFrame([(1, None)], schema)).collect() == []
    empty, one = (whitening.whiten(spark.createDataFrame(rows, schema)) for rows in ([], [(1, [0.5, 0.25])]))
    assert empty.columns == one.columns and empty.dtypes == one.dtypes
    assert [(x["deviation"], x["whitened"], x["explained"], x["identity_error"]) for x in one.collect()] == [(0, 0, 0, 0)] * 2
    flat = whitening.whiten(spark.createDataFrame([(i, [float(i), 3.0]) for i in range(4)], schema)).collect()
    second = [x for x in flat if x["component"] == 2]
    assert all(x["whitened"] == 0 and x["explained"] == 0 and x["identity_error"] < 1e-9 for x in second)
    assert np.isclose(sum(x["whitened"] ** 2 for x in flat if x["component"] == 1), 4)


def test_deviations_beyond_64_bits(spark):
    rows = [(i, [s * float(1 << 32), 0.0]) for i, s in enumerate([1, -1, 1, -1])]
    lines = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert {x["deviation"] for x in lines} == {None} and {int(x["deviation_exact"]) for x in lines} == {(4 << 42) ** 2}


def test_names_that_clash(spark):
    df = spark.createDataFrame([(i, [float(i), float(i * i % 5)]) for i in range(9)], "component long, embedding array<double>")
    lines = whitening.whiten(df, key="component")
    assert lines.columns[:2] == ["component", "_component"] and lines.count() == 18


def test_splits_share_the_rows(spark, monkeypatch):
    """Products of blocks are summed in as many tasks as there are splits, none of which sees all rows."""
    monkeypatch.setattr(whitening, "BLOCK_ENTRIES", 64)
    df = spark.createDataFrame([(i, [float(i % 7), float(i % 11)]) for i in range(400)], "vec_id long, embedding array<double>")
    clean = whitening.whole_numbers(df, "vec_id", "embedding", 1024, 0)
    blocks = whitening.blocks_of(whitening.numbered(clean), whitening.F.transform("_x", lambda c: c.cast("double")), 2)
    assert blocks.numRows() == 400 and blocks.blocks.count() == 13
    x = np.array([[1024 * (i % 7), 1024 * (i % 11)] for i in range(400)], float)
    for splits in (1, 5):
        assert whitening.scatter(blocks, splits) == pytest.approx(x.T @ x)
    whitening.free(blocks)
