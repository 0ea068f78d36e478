"""Whitening against numpy on the whole table, and odd vectors."""
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tessera.llm import whitening


def brute(vectors, k=8):
    x = np.floor(np.array(vectors, float) * 1024) + 100000
    n, s = len(x), x.sum(axis=0)
    c = x - s / n
    e, v = np.linalg.eigh(c.T @ c / n)
    e, v = e[::-1], v[:, ::-1]
    return [sum((n * int(a) - int(t)) ** 2 for a, t in zip(r, s)) for r in x], c @ v[:, :k] / np.sqrt(e[:k]), e[:k] / e.sum()


def compare(out, vectors, ids, k=8):
    dev, white, share = brute(vectors, k)
    rows = {(r["vec_id"], r["component"]): r for r in out.collect()}
    assert len(rows) == len(ids) * min(k, len(vectors[0]))
    got = np.array([[rows[i, c + 1]["whitened"] for c in range(white.shape[1])] for i in ids])
    assert np.abs(got * np.sign((got * white).sum(axis=0)) - white).max() < 1e-6
    assert [rows[i, 1]["deviation"] for i in ids] == dev
    assert all(r["n"] == len(ids) and r["identity_error"] < 1e-6 for r in rows.values())
    assert np.allclose([rows[ids[0], c + 1]["explained"] for c in range(white.shape[1])], share, rtol=1e-9)


def test_table_against_numpy(spark):
    df = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    rows = df.collect()
    compare(whitening.whiten(df), [r["embedding"] for r in rows], [r["vec_id"] for r in rows])


def frame(spark, rows):
    return spark.createDataFrame([(*r, "c", 1) for r in rows], "vec_id long, embedding array<double>, component string, row int")


def test_several_blocks_and_more_columns_than_one_block(spark, monkeypatch):
    rng = np.random.default_rng(4)
    x = (rng.normal(size=(700, 12)) @ rng.normal(size=(12, 12))).tolist()
    monkeypatch.setattr(whitening, "COLUMNS", 5)
    monkeypatch.setattr(whitening, "BLOCK_ENTRIES", 500)
    monkeypatch.setattr(whitening, "SPLIT_BLOCKS", 2)
    compare(whitening.whiten(frame(spark, list(enumerate(x))).repartition(7)), x, list(range(700)))


def test_odd_vectors_are_left_out(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(30, 3)).tolist()
    odd = [(100, None), (101, []), (102, [1.0, None, 2.0]), (103, [math.nan, 0.0, 0.0]), (104, [math.inf, 0.0, 0.0]),
           (105, [1.0, 2.0]), (106, [1e300, 0.0, 0.0])]
    compare(whitening.whiten(frame(spark, list(enumerate(x)) + odd)), x, list(range(30)))


def test_repeated_null_and_equal_rows(spark):
    same = whitening.whiten(frame(spark, [(1, [0.5, 0.25]), (1, [0.5, 0.25]), (None, [0.5, 0.25])])).collect()
    assert sorted((r["vec_id"] or 0, r["component"]) for r in same) == [(0, 1), (0, 2), (1, 1), (1, 1), (1, 2), (1, 2)]
    assert all(r["whitened"] is None and r["explained"] is None and r["identity_error"] is None and r["deviation"] == 0 for r in same)
    line = whitening.whiten(frame(spark, [(i, [float(i), 2.0 * i]) for i in range(9)])).collect()  # one direction only
    assert all((r["whitened"] is None) == (r["component"] == 2) for r in line)
    assert all(abs(r["identity_error"]) < 1e-9 for r in line)


def test_empty(spark):
    for rows in ([], [(1, None)]):
        out = whitening.whiten(frame(spark, rows))
        assert out.count() == 0 and out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_numbers_have_no_gap(spark):
    rows = spark.range(0, 1000, 1, 7).select(F.monotonically_increasing_id().alias("row")).filter("id % 3 > 0")
    assert sorted(r["index"] for r in whitening.numbered(rows).collect()) == list(range(666))


@pytest.mark.parametrize("entry, x", [(0.0, 100000), (-0.0001, 99999), (0.5, 100512), (-1.0, 98976)])
def test_whole_numbers(spark, entry, x):
    assert frame(spark, [(1, [entry])]).select(whitening.whole_numbers("embedding").alias("x")).first()["x"] == [x]
