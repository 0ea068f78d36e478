"""Every registered query against its DuckDB oracle on the smallest driver tables."""
import math

import duckdb
import numpy as np
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from tessera.sources.tables import TABLES

QUERIES = E.queries()
ORACLES = E.oracle_sql()


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if hasattr(v, "isoformat"):
        return str(v)[:26]
    return v


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [cols[i] for i in order], sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "ytd" in df.columns


def test_every_query_has_docs_or_oracle():
    assert len(QUERIES) >= 80
    missing = [k for k in ORACLES if k not in QUERIES]
    assert not missing


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_oracle(spark, con, key):
    df = QUERIES[key](spark, SF_SMALL)
    a = _canon(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(ORACLES[key])
    b = _canon([d[0] for d in cur.description], cur.fetchall())
    assert a[0] == b[0]
    assert len(a[1]) == len(b[1])
    assert a[1] == b[1]


def test_only_fits_lack_an_oracle():
    assert {k for k in set(QUERIES) - set(ORACLES) if not k.startswith("op") and k != "pipeline"} == {"pca_kmeans", "fc_select_every"}


def test_pca_kmeans_against_the_spectrum(spark):
    rows = QUERIES["pca_kmeans"](spark, SF_SMALL).collect()
    x = np.array([r[0] for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").select("embedding").collect()], float)
    x -= x.mean(0)
    spectrum = np.linalg.svd(x, compute_uv=False) ** 2
    share = np.cumsum(spectrum) / spectrum.sum()
    assert {r.components for r in rows} == {int(np.searchsorted(share, 0.95 - 1e-9)) + 1}
    assert len(rows) == len(x) and {r.cluster for r in rows} <= set(range(18)) and len({r.cluster for r in rows}) > 9
    by = {r.vec_id: r.cluster for r in rows}
    ids = [r[0] for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").select("vec_id").collect()]
    label = np.array([by[i] for i in ids])
    inside = sum(((x[label == c] - x[label == c].mean(0)) ** 2).sum() for c in set(label))
    assert inside < 0.98 * (x ** 2).sum()
