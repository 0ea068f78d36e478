"""Service transformers (errors by text, bounded requests, saved pipelines) and PCA by subspace iteration."""
import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tessera.operators import segment as S
from tessera.operators import transformers as T
from tessera.session import scratch_path


def shout(texts):
    if any("bad" in t for t in texts):
        raise RuntimeError("refused")
    return [None if t == "none" else t.upper() for t in texts]


def lengths(texts):
    return [[float(len(t)), 1.0] for t in texts]


NAME = "tests.test_segment_services"


@pytest.fixture(autouse=True)
def importable(spark, monkeypatch):
    """The services are looked up by name where they run; here workers inherit the function itself."""
    monkeypatch.setattr(T, "named_function", lambda n, known={"shout": shout, "lengths": lengths}: known[n.partition(":")[2]])


def test_requests_are_bounded():
    texts = ["x" * n for n in (5, 5, 5, 30, 1, 1, 1, 1, 10, 0, 0)]
    got = list(T.requests(texts, 3, 12))
    assert sum(got, []) == list(range(len(texts)))
    assert all(len(r) <= 3 and (len(r) == 1 or sum(len(texts[i]) for i in r) <= 12) for r in got)
    assert list(T.requests([], 3, 12)) == []


def test_only_failing_texts_keep_an_error():
    calls = []

    def service(texts):
        calls.append(len(texts))
        return shout(texts)
    out = T.ask(service, ["a", "b", "bad", "c", "none", "d", "e", "f"], 2, 0.0)
    assert out == [("A", None), ("B", None), (None, "RuntimeError: refused"), ("C", None), (None, "no answer for this text"), ("D", None),
                   ("E", None), ("F", None)]
    assert calls == [8, 8, 4, 4, 2, 2, 2, 1, 1, 1, 4] or sum(calls) < 8 * 6
    assert T.ask(lambda ts: ts[:-1], ["a"], 1, 0.0) == [(None, "ValueError: 0 answers for 1 texts")]


def test_saved_pipeline_gives_the_same_rows():
    """(In the registered query ``embed_service`` and here by class and parameters.)"""
    t = T.TextEmbedder(inputCol="t", outputCol="v", function="m:lengths", maxItems=7)
    assert t.getOrDefault(t.answerType) == "array<double>" and t.getOrDefault(t.maxItems) == 7 and t.getOrDefault(t.retries) == 3


def test_pipeline_round_trip(spark):
    from tessera.suite.registry import QUERIES
    from tessera.suite import all_queries  # noqa: F401
    docs = spark.createDataFrame([(1, "Ab\ncd"), (2, None), (3, "x" * 11), (4, "")], "doc_id long, text string").withColumn("__answered", F.lit(7))
    import tessera.suite.io_seg_q as q
    stages = [T.TextTranslator(inputCol="text", outputCol="heading", errorCol="e1", function="tessera.suite.io_seg_q:first_line"),
              T.TextEmbedder(inputCol="heading", outputCol="v", errorCol="e2", function="tessera.suite.io_seg_q:text_profile", retries=1)]
    model = Pipeline(stages=stages).fit(docs)
    path = scratch_path(spark, "services-pipeline")
    model.write().overwrite().save(path)
    loaded = PipelineModel.load(path)
    assert [type(s) for s in loaded.stages] == [T.TextTranslator, T.TextEmbedder]
    want = {1: ("# Ab", [4.0, 1.0, 0.0, 1.0]), 2: (None, None), 3: ("# " + "x" * 11, None), 4: ("# ", [2.0, 1.0, 0.0, 1.0])}
    import unittest.mock as mock
    with mock.patch.object(T, "named_function", lambda n: getattr(q, n.partition(":")[2])):
        for m in (model, loaded):
            rows = m.transform(docs).collect()
            assert {r["doc_id"]: (r["heading"], r["v"]) for r in rows} == want
            assert {r["doc_id"]: r["e2"] for r in rows} == {1: None, 2: None, 3: "RuntimeError: service unavailable", 4: None}
            assert rows[0]["__answered"] == 7 and "embed_service" in QUERIES


def spectrum_frame(spark, n, dim, kept, seed):
    rng = np.random.default_rng(seed)
    basis = np.linalg.qr(rng.normal(size=(dim, dim)))[0]
    scale = np.concatenate([np.linspace(10, 3, kept), np.full(dim - kept, 0.05)])
    x = rng.normal(size=(n, dim)) * scale @ basis.T + rng.normal(size=dim)
    return x, spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "id long, v array<double>").repartition(5)


@pytest.mark.parametrize("dim, kept, start", [(40, 5, 8), (60, 21, 4), (12, 12, 16), (30, 1, 2)])
def test_subspace_equals_numpy(spark, dim, kept, start):
    x, df = spectrum_frame(spark, 400, dim, kept, dim)
    out, k = S.pca_subspace(df, "v", 0.95, start=start)
    c = x - x.mean(axis=0)
    values, vectors = np.linalg.eigh(c.T @ c / len(x))
    share = np.cumsum(values[::-1]) / values.sum()
    assert k == int(np.searchsorted(share, 0.95) + 1)
    want = c @ vectors[:, ::-1][:, :k]
    got = np.array([r["pca"] for r in out.orderBy("id").collect()])
    assert np.abs(got @ got.T - want @ want.T).max() < 1e-3 * np.abs(want @ want.T).max()  # the same subspace


def test_subspace_equals_the_full_fit_on_the_table(spark):
    df = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    one, k1 = S.pca_by_variance(df, "embedding", 0.95)
    two, k2 = S.pca_subspace(df, "embedding", 0.95)
    assert k1 == k2
    a = np.array([r["p"] for r in one.select(vector_to_array("pca").alias("p"), "vec_id").orderBy("vec_id").collect()])
    b = np.array([r["pca"] for r in two.orderBy("vec_id").collect()])
    assert np.allclose(np.abs(a), np.abs(b), atol=1e-5)


def test_long_vectors_go_by_the_subspace(spark, monkeypatch):
    x, df = spectrum_frame(spark, 300, 30, 4, 1)
    full, k1 = S.pca_by_variance(df, "v", 0.95)
    monkeypatch.setattr(S, "FULL_FIT", 10)
    other, k2 = S.pca_by_variance(df, "v", 0.95)
    a, b = (np.abs([r["p"] for r in o.select("id", vector_to_array("pca").alias("p")).orderBy("id").collect()]) for o in (full, other))
    assert k1 == k2 and full.dtypes == other.dtypes and np.allclose(a, b, atol=1e-3)


def test_subspace_of_equal_vectors(spark):
    out, k = S.pca_subspace(spark.createDataFrame([(i, [1.0, 2.0]) for i in range(5)], "id long, v array<double>"), "v")
    assert k == 1 and all(r["pca"] == [0.0] for r in out.collect())
