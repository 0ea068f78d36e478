"""ARIMA and tree candidates against plain versions, and stored models."""
import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import arima, trees
from tessera.operators import forecast as FC
from tessera.plans import forecasting as FP
from tessera.session import scratch_path
from tessera.sources.model_store import CLAIM, MARKER, ModelStore
from tessera.sources.sinks import append_run

START = dt.date(2020, 1, 5)


def frame(spark, series):
    return spark.createDataFrame([(k, START + dt.timedelta(days=7 * i), float(v)) for k, vs in series.items() for i, v in enumerate(vs)],
                                 "k string, ds date, y double")


def made(n, seed, ar=(0.6,), d=0):
    rng = np.random.default_rng(seed)
    z = [0.0] * 5
    for _ in range(n):
        z.append(sum(w * z[-k - 1] for k, w in enumerate(ar)) + rng.normal())
    z = np.array(z[5:])
    return 50 + (np.cumsum(z) if d else z)


# --- ARIMA --------------------------------------------------------------------------------

def plain_fit(y, p, d, q, start):
    """The same order on rows written out one by one, solved by a QR least squares."""
    z = list(y)
    for _ in range(d):
        z = [b - a for a, b in zip(z, z[1:])]
    e = [0.0] * len(z)
    if q:
        m = max(max(p, min(arima.LONG, len(z) // 4) + q) - q, 1) if p <= max(p, min(arima.LONG, len(z) // 4) + q) - q else max(min(arima.LONG, len(z) // 4), 1)
        rows = [[1.0] + [z[t - k] for k in range(1, m + 1)] for t in range(m, len(z))]
        w = np.linalg.lstsq(np.array(rows), np.array(z[m:]), rcond=None)[0]
        for t, r in zip(range(m, len(z)), rows):
            e[t] = z[t] - float(np.dot(w, r))
    rows = [[1.0] + [z[t - k] for k in range(1, p + 1)] + [e[t - k] for k in range(1, q + 1)] for t in range(start, len(z))]
    w = np.linalg.lstsq(np.array(rows), np.array(z[start:]), rcond=None)[0]
    sse = sum((z[t] - float(np.dot(w, r))) ** 2 for t, r in zip(range(start, len(z)), rows))
    n, k = len(rows), p + q + 1
    return w, n * math.log(sse / n) + 2 * (k + 1) + 2 * (k + 1) * (k + 2) / max(n - k - 2, 1)


def plain_forecast(y, w, p, d, q, h):
    z = np.diff(y, d).tolist()
    e = [0.0] * len(z)
    step = lambda t: w[0] + sum(w[k] * z[t - k] for k in range(1, p + 1)) + sum(
        w[p + k] * e[t - k] for k in range(1, q + 1) if t - k >= 0)
    for t in range(p, len(z)):
        e[t] = z[t] - step(t) if q else 0.0
    for _ in range(h):
        e.append(0.0)
        z.append(step(len(z)))
    out = z[-h:]
    return [y[-1] + sum(out[:i + 1]) for i in range(h)] if d else out


@pytest.mark.parametrize("seed, ar, d", [(1, (0.6,), 0), (2, (0.5, 0.3), 0), (3, (0.4,), 1), (4, (), 1), (5, (-0.7,), 0)])
def test_order_and_weights_equal_a_plain_version(seed, ar, d):
    y = made(90, seed, ar, d)
    got = arima.fit(y)
    tried = {}
    z = len(y) - got.d
    start = min(max(arima.MOST[0], min(arima.LONG, z // 4) + arima.MOST[2]), z // 2)
    for p in range(arima.MOST[0] + 1):
        for q in range(arima.MOST[2] + 1):
            tried[p, q] = plain_fit(y, p, got.d, q, start)
    inside = lambda w: not len(w) or max(abs(np.linalg.eigvals(np.vstack([w, np.eye(len(w))[:-1]])))) < 0.999
    tried = {(p, q): v for (p, q), v in tried.items() if inside(v[0][1:p + 1]) and inside(-v[0][p + 1:])}
    best = min(tried, key=lambda o: (round(tried[o][1], 9), sum(o), o[1]))
    assert got.d == int(np.std(np.diff(y)) < np.std(y)) and (len(got.ar), len(got.ma)) == best
    assert np.allclose([got.intercept, *got.ar, *got.ma], tried[best][0], atol=1e-6)
    assert np.allclose(arima.forecast(y, got, 5), plain_forecast(y, tried[best][0], *[best[0], got.d, best[1]], 5), atol=1e-5)


def test_large_values_do_not_lose_the_intercept():
    y = 1e6 * made(80, 6, (0.5, 0.2), 1)
    w, _ = plain_fit(y, 2, 1, 0, 2)
    got = arima.fit_order(y, 2, 1, 0)
    assert np.allclose([got.intercept, *got.ar], w, rtol=1e-6)


def test_arima_column_short_constant_and_null_series(spark):
    rows = {"a": made(60, 7), "const": [4.0] * 40, "short": [1.0, 2.0], None: made(60, 8)}
    g = FC.grouped(FC.index_series(frame(spark, rows), ["k"], 4), ["k"], 4, True)
    got = {r.k: r for r in g.withColumn("m", arima.fitted(F.col("_y"))).withColumn("p", arima.ahead(F.col("_y"), F.col("m"), 4)).collect()}
    assert got["short"].m is None and got["short"].p is None
    assert np.allclose(got["const"].p, [4.0] * 4)
    for k in ("a", None):
        assert np.allclose(got[k].p, arima.forecast(np.array(rows[k]), arima.fit(np.array(rows[k])), 4))


def test_arima_beats_the_mean_on_an_ar_series():
    y, errors = made(400, 9, (0.9,)), []
    for t in range(300, 396):
        errors.append((abs(arima.forecast(y[:t], arima.fit(y[:t]), 1)[0] - y[t]), abs(y[:t].mean() - y[t])))
    assert np.mean([a for a, _ in errors]) < 0.8 * np.mean([b for _, b in errors])


# --- boosted trees ------------------------------------------------------------------------

def test_compiled_trees_score_like_the_model(spark):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import GBTRegressor
    s = FC.index_series(frame(spark, {"a": 10 + 3 * np.sin(np.arange(80)), "b": 1000 + np.arange(80) % 7, None: made(80, 3)}), ["k"], 4)
    rows = trees.training_rows(s, ["k"], "W")
    rows = VectorAssembler(inputCols=rows.columns[:-1], outputCol="features").transform(rows)
    model = GBTRegressor(maxDepth=trees.DEPTH, maxIter=trees.TREES, stepSize=trees.RATE, seed=trees.SEED).fit(rows)
    own = trees.Trees.from_json(trees.of_model(model, "W").to_json())
    n = len(rows.columns) - 2
    got = model.transform(rows).withColumn("own", own.column([F.col(f"f{i}") for i in range(n)])).select("prediction", "own").collect()
    assert len(got) == 3 * (76 - trees.LAGS["W"]) and all(abs(r.prediction - r.own) < 1e-9 for r in got)


def plain_value(own, features):
    def node(n):
        while isinstance(n, dict):
            n = n["le"] if features[n["f"]] <= n["at"] else n["gt"]
        return n
    return sum(w * node(n) for w, n in own.trees)


@pytest.mark.parametrize("freq", ["W", "M", "D"])
def test_steps_ahead_feed_each_other(spark, freq):
    days = {"W": 7, "D": 1}.get(freq)
    dates = [START + dt.timedelta(days=days * i) for i in range(60)] if days else [
        (dt.date(2015 + (i + 1) // 12, (i + 1) % 12 + 1, 1) - dt.timedelta(days=1)) for i in range(60)]
    y = [20 + 5 * math.sin(i / 3) + i % 5 for i in range(60)]
    df = spark.createDataFrame([("a", d, v) for d, v in zip(dates, y)] + [("short", dates[0], 3.0), ("zero", dates[0], 0.0)], "k string, ds date, y double")
    s = FC.index_series(df, ["k"], 4)
    own = trees.fit(s, ["k"], freq)
    g = FC.grouped(s, ["k"], 5, True).withColumn("p", trees.ahead(F.col("_y"), F.lit(10.0), F.col("_fit_last"), own, 5))
    got = {r.k: r.p for r in g.collect()}
    assert got["short"] is None and got["zero"] is None
    history, now = [v / 10 for v in y], dates[-1]
    for i in range(5):
        now = now + dt.timedelta(days=days) if days else (now.replace(day=1) + dt.timedelta(days=63)).replace(day=1) - dt.timedelta(days=1)
        more = {"W": [now.isocalendar()[1]], "D": [now.isoweekday() % 7 + 1], "M": []}[freq]
        history.append(plain_value(own, [history[-k] for k in range(1, trees.LAGS[freq] + 1)] + [now.month, *more]))
    assert np.allclose(got["a"], [10 * v for v in history[-5:]])


def test_no_series_long_enough_for_trees(spark):
    s, err, best, fits = FC.fit_select(frame(spark, {"a": [1.0, 2.0, 3.0]}), ["k"], "W")
    assert fits["boosted_trees"] is None and [tuple(r) for r in best.collect()] == [("a", FC.FALLBACK, None)]


# --- stored models ------------------------------------------------------------------------

SERIES = {"line": 5 + 2.0 * np.arange(80), "wave": 40 + 9 * np.sin(np.arange(80) * 2 * math.pi / 52), "ar": made(80, 4, (0.8,)),
          "step": [3.0, 9.0] * 40, "zeros": [5.0] * 70 + [0.0] * 10, None: made(80, 5, (0.5,), 1)}


def test_stored_model_gives_the_forecast_of_its_fit(spark):
    """On the series it was trained on, a stored model forecasts what fitting now would."""
    df = frame(spark, SERIES)
    store = ModelStore(spark, scratch_path(spark, "store-a"))
    assert FP.train(store, "m", df, ["k"], "W") == 1
    s, _, best, fits = FC.fit_select(df, ["k"], "W")
    now = {(r.k, r.ds): (r.model, r.predicted_sales) for r in FC.forecast_next(s, best, ["k"], 4, 52, 8, "W", FC.MODELS, fits).collect()}
    got = {(r.k, r.ds): (r.model, r.predicted_sales) for r in FP.infer(store, "m", df).collect()}
    assert set(got) == set(now) and len(got) == 4 * len(SERIES)
    for k, (model, value) in got.items():
        assert model == now[k][0] and abs(value - now[k][1]) < 1e-6


def test_grown_shortened_and_unknown_series(spark):
    store = ModelStore(spark, scratch_path(spark, "store-b"))
    FP.train(store, "m", frame(spark, {"line": SERIES["line"]}), ["k"], "W", models=("linear_trend", "moving_average"))
    longer = 5 + 2.0 * np.arange(90)
    late = frame(spark, {"line": longer}).filter(F.col("ds") >= START + dt.timedelta(days=70)).unionByName(frame(spark, {"new": [7.0] * 9}))
    got = {(r.k, r.ds): (r.model, r.predicted_sales) for r in FP.infer(store, "m", late).collect()}
    for i in range(4):
        model, value = got["line", START + dt.timedelta(days=7 * (90 + i))]
        assert model == "linear_trend" and abs(value - (5 + 2.0 * (90 + i))) < 1e-6
        assert got["new", START + dt.timedelta(days=7 * (9 + i))] == (FC.FALLBACK, 7.0)


def test_unfinished_versions_are_never_read(spark):
    store = ModelStore(spark, scratch_path(spark, "store-c"))
    with pytest.raises(LookupError):
        store.load("m")
    one = spark.createDataFrame([(1,)], "x int")
    assert store.register("m", one, {"a": 1}) == 1
    assert store.claim("m") == 2                               # a writer that died before it wrote anything
    one.write.parquet(f"{store.folder('m', 3)}/parameters")    # one that died before the marker
    store._put(f"{store.folder('m', 3)}/document.json", "{}")
    assert store.versions("m") == [1] and store.load("m")[0] == 1
    assert store.register("m", one.selectExpr("x + 1 AS x"), {"a": 2}) == 4
    version, parameters, document = store.load("m")
    assert (version, parameters.first().x, document) == (4, 2, {"a": 2}) and store.load("m", 1)[2] == {"a": 1}
    with pytest.raises(LookupError):
        store.load("m", 3)
    assert MARKER != CLAIM and store.versions("other") == []


def test_a_number_is_claimed_once(spark):
    store = ModelStore(spark, scratch_path(spark, "store-d"))
    from concurrent.futures import ThreadPoolExecutor
    with ThreadPoolExecutor(8) as pool:
        got = list(pool.map(lambda _: store.claim("m"), range(16)))
    assert sorted(got) == list(range(1, 17))


def test_repeated_run_leaves_one_copy(spark):
    path = scratch_path(spark, "runs")
    df = spark.createDataFrame([(1, 2.0), (2, 3.0)], "k int, v double")
    for run in ("a", "a", "b", "a"):
        append_run(df, path, run)
    assert sorted((r.run_id, r.k) for r in spark.read.parquet(path).collect()) == [("a", 1), ("a", 2), ("b", 1), ("b", 2)]


def test_selection_among_all_candidates_of_the_query(spark):
    """fc_select_every: the candidates with an oracle as in fc_mape, ARIMA as worked out by numpy, the least error chosen."""
    import __spark_entry__ as E
    from conftest import SF_SMALL
    q = E.queries()
    rows = q["fc_select_every"](spark, SF_SMALL).collect()
    got = {(r["c_mktsegment"], r["model"]): r["mape"] for r in rows}
    assert {r["model"] for r in rows} == set(FC.MODELS)
    for r in q["fc_mape"](spark, SF_SMALL).collect():
        assert abs(got[r["c_mktsegment"], r["model"]] - r["mape"]) < 2e-4
    weeks = {}
    for r in q["holdout_split"](spark, SF_SMALL).orderBy("t").collect():
        weeks.setdefault(r["c_mktsegment"], []).append(r["y"])
    for k, y in weeks.items():
        train, test = np.array(y[:-4]), np.array(y[-4:])
        ahead = arima.forecast(train, arima.fit(train), 4)
        want = np.mean([abs((a - p) / a) for a, p in zip(test, ahead) if a != 0])
        assert abs(got[k, "arima"] - want) < 2e-3 * max(1, want)
    for k in weeks:
        best = min((v, m) for (s, m), v in got.items() if s == k)
        assert any(r["chosen"] and r["c_mktsegment"] == k and r["mape"] == best[0] for r in rows)
