"""Null keys, series that cannot be scored, and candidates on known series."""
import datetime as dt

from pyspark.sql import functions as F

from tessera.functions.text import length_profile
from tessera.operators import forecast as FC
from tessera.operators.series import resample


def _series(spark, values, key):
    return spark.createDataFrame([(key, dt.date(2020, 1, 5) + dt.timedelta(days=7 * i), float(v))
                                  for i, v in enumerate(values)], "k string, ds date, y double")


def test_null_key_is_a_series(spark):
    df = spark.createDataFrame([(None, dt.date(2020, 1, 1), 5.0), (None, dt.date(2020, 1, 3), 7.0), ("a", dt.date(2020, 1, 1), 1.0)],
                               "k string, d date, v double")
    got = {(r.k, r.ds.day): r.y for r in resample(df, "d", "v", "D", ["k"]).collect()}
    assert got == {(None, 1): 5.0, (None, 2): 0.0, (None, 3): 7.0, ("a", 1): 1.0}


def test_every_series_gets_a_forecast(spark):
    rows = _series(spark, range(1, 41), "line").unionByName(_series(spark, [5.0] * 30 + [0.0] * 4, "zeros")) \
        .unionByName(_series(spark, [3.0, 4.0], "short")).unionByName(_series(spark, range(2, 60), None)) \
        .unionByName(_series(spark, [9.0], "one"))
    s, err, best, fit = FC.fit_select(rows, ["k"], "W", window=4)
    chosen = {r.k: (r.model, r.mape) for r in best.collect()}
    assert set(chosen) == {"line", "zeros", "short", "one", None}
    assert chosen["zeros"] == chosen["short"] == (FC.FALLBACK, None)
    nxt = FC.forecast_next(s, best, ["k"], 4, 52, 4, "W", FC.MODELS, fit)
    got = {(r.k, r.ds): r.predicted_sales for r in nxt.collect()}
    assert len(got) == 5 * 4 and all(v is not None for v in got.values())
    assert abs(got[("line", dt.date(2020, 1, 5) + dt.timedelta(days=7 * 40))] - 41) < 1.5


def test_smoothing_equals_plain_loop(spark):
    values = [3.0, 5.0, 4.0, 8.0, 6.0, 7.0]
    row = spark.createDataFrame([(values,)], "y array<double>").select(FC.smoothed_level(F.col("y")).alias("s")).first().s
    best = None
    for a in FC.ALPHAS:
        level, sse = values[0], 0.0
        for v in values[1:]:
            sse += (v - level) ** 2
            level = a * v + (1 - a) * level
        if best is None or sse < best[0]:
            best = (sse, a, level)
    assert all(abs(x - y) < 1e-9 for x, y in zip(row, best))


def test_lagged_predictions_feed_each_other(spark):
    y = spark.createDataFrame([([1.0, 2.0, 3.0],), ([1.0],)], "y array<double>")
    got = [r.p for r in y.select(FC.lagged(F.col("y"), 3, 1.0, [0.5, 0.25]).alias("p")).collect()]
    a = 1 + 0.5 * 3 + 0.25 * 2
    b = 1 + 0.5 * a + 0.25 * 3
    assert got == [[a, b, 1 + 0.5 * b + 0.25 * a], None]


def test_profile_keeps_the_null_group(spark):
    df = spark.createDataFrame([(None, "ab"), (None, "abcd"), ("x", "a"), ("x", None)], "g string, t string")
    got = {r.g: (r.n, r["mean"], r["min"], r["max"], r.stddev) for r in length_profile(df, "t", ["g"]).collect()}
    assert got[None][:4] == (2, 3.0, 2, 4) and abs(got[None][4] - 2 ** 0.5) < 1e-9 and got["x"] == (1, 1.0, 1, 1, None)
