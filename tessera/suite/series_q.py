"""Registered queries: resampling, fills, hold-out, forecasters, selection,
forecast table, top-n windows."""
from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tessera.operators import arima
from tessera.operators import forecast as FC
from tessera.operators.series import bfill, drop_last, ffill, resample
from tessera.operators.windows import last_n, top_n_per
from tessera.plans import forecasting as FP
from tessera.plans.sales import orders_fact, sales_model
from tessera.session import materialize, scratch_path
from tessera.sources.model_store import ModelStore
from tessera.sources.tables import load
from tessera.suite.common import FACT_SQL, rounded
from tessera.suite.registry import query

KEYS = ["c_mktsegment"]
H, SEASON, WINDOW = FC.HORIZON["W"], FC.SEASON["W"], 8


def _segment_sales(spark, sf):
    f = orders_fact(load(spark, sf, "orders"), load(spark, sf, "lineitem"))
    c = load(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    return f.join(c, f["o_custkey"] == c["c_custkey"], "left").select("c_mktsegment", "o_orderdate", "l_extendedprice")


def _weekly(spark, sf):
    return resample(_segment_sales(spark, sf), "o_orderdate", "l_extendedprice", "W", KEYS)


def _indexed(spark, sf):
    # resampled series are small (series x periods) and feed every candidate: materialise once
    return materialize(FC.index_series(_weekly(spark, sf), KEYS, H))


SEG_SQL = """seg0 AS (SELECT c.c_mktsegment, CAST(o.o_orderdate AS DATE) AS d, l.l_extendedprice AS v
  FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey LEFT JOIN customer c ON o.o_custkey = c.c_custkey)"""


def _resample_sql(bucket: str, step: str, src: str = "seg0", key: str = "c_mktsegment", month: bool = False) -> str:
    if month:
        spine = ("SELECT r.k, last_day(CAST(r.lo + to_months(CAST(i AS INTEGER)) AS DATE)) AS ds FROM rng r, "
                 "LATERAL (SELECT unnest(generate_series(0, date_diff('month', r.lo, r.hi))) AS i)")
    else:
        spine = f"SELECT k, CAST(unnest(generate_series(lo, hi, {step})) AS DATE) AS ds FROM rng"
    return f"""
agg AS (SELECT {key} AS k, {bucket} AS ds, sum(v) AS y FROM {src} GROUP BY 1, 2),
rng AS (SELECT k, min(ds) AS lo, max(ds) AS hi FROM agg GROUP BY k),
sp AS ({spine}),
ser AS (SELECT sp.k, sp.ds, coalesce(agg.y, 0.0) AS y FROM sp LEFT JOIN agg ON agg.k IS NOT DISTINCT FROM sp.k AND agg.ds = sp.ds)"""


WEEK_BUCKET = "CAST(d + CAST((7 - dayofweek(d)) % 7 AS INTEGER) AS DATE)"
WEEKLY_SQL = f"WITH {SEG_SQL}, {_resample_sql(WEEK_BUCKET, 'INTERVAL 7 DAY')}"
IX_SQL = WEEKLY_SQL + f""",
ix AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY ds) AS t, count(*) OVER (PARTITION BY k) AS n FROM ser),
train AS (SELECT * FROM ix WHERE t <= n - {H}),
test AS (SELECT *, n - {H} AS nt FROM ix WHERE t > n - {H}),
snaive AS (SELECT test.k, test.ds, test.y, 'seasonal_naive' AS model,
  (SELECT tr.y FROM train tr WHERE tr.k = test.k AND tr.t = test.t - {SEASON} * ceil((test.t - test.nt) / {SEASON})) AS yhat
  FROM test),
ma AS (SELECT test.k, test.ds, test.y, 'moving_average' AS model,
  (SELECT avg(tr.y) FROM train tr WHERE tr.k = test.k AND tr.t > test.nt - {WINDOW}) AS yhat FROM test),
fit AS (SELECT k, regr_slope(y, t) AS b, regr_intercept(y, t) AS a FROM train GROUP BY k),
trend AS (SELECT test.k, test.ds, test.y, 'linear_trend' AS model, fit.a + fit.b * test.t AS yhat
  FROM test JOIN fit ON fit.k = test.k)"""


@query("resample_day", sql=f"""
WITH src AS (SELECT event_type, CAST(ts AS DATE) AS d, value AS v FROM events),
{_resample_sql('d', 'INTERVAL 1 DAY', 'src', 'event_type')}
SELECT k AS event_type, ds, round(y, 2) AS y FROM ser""")
def q_resample_day(spark, sf):
    return rounded(resample(load(spark, sf, "events"), "ts", "value", "D", ["event_type"]))


@query("resample_week", sql=WEEKLY_SQL + " SELECT k AS c_mktsegment, ds, round(y, 2) AS y FROM ser")
def q_resample_week(spark, sf):
    """Weekly (ending Sunday) sales per customer segment; empty weeks are 0."""
    return rounded(_weekly(spark, sf))


@query("resample_month", sql=f"WITH {SEG_SQL}, {_resample_sql('last_day(d)', '', month=True)}"
       " SELECT k AS c_mktsegment, ds, round(y, 2) AS y FROM ser")
def q_resample_month(spark, sf):
    return rounded(resample(_segment_sales(spark, sf), "o_orderdate", "l_extendedprice", "M", KEYS))


@query("fill_forward", sql=f"""
WITH {SEG_SQL},
agg AS (SELECT c_mktsegment AS k, d AS ds, sum(v) AS y FROM seg0 GROUP BY 1, 2),
rng AS (SELECT k, min(ds) AS lo, max(ds) AS hi FROM agg GROUP BY k),
sp AS (SELECT k, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS ds FROM rng),
ser AS (SELECT sp.k, sp.ds, agg.y FROM sp LEFT JOIN agg ON agg.k IS NOT DISTINCT FROM sp.k AND agg.ds = sp.ds),
f AS (SELECT k, ds, y,
  last_value(y IGNORE NULLS) OVER (PARTITION BY k ORDER BY ds ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS y_ffill,
  first_value(y IGNORE NULLS) OVER (PARTITION BY k ORDER BY ds ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS y_bfill,
  row_number() OVER (PARTITION BY k ORDER BY ds DESC) AS rn FROM ser)
SELECT k AS c_mktsegment, ds, round(y, 2) AS y, round(y_ffill, 2) AS y_ffill, round(y_bfill, 2) AS y_bfill FROM f WHERE rn > 1""")
def q_fill_forward(spark, sf):
    """Daily sales per segment with gaps left empty, forward- and backward-filled per series;
    the last (incomplete) day of each series is dropped."""
    s = _segment_sales(spark, sf)
    agg = s.groupBy("c_mktsegment", F.to_date("o_orderdate").alias("ds")).agg(F.sum("l_extendedprice").alias("y"))
    rng = agg.groupBy("c_mktsegment").agg(F.min("ds").alias("lo"), F.max("ds").alias("hi"))
    spine = rng.select("c_mktsegment", F.explode(F.sequence("lo", "hi")).alias("ds"))
    agg = agg.select(F.col("c_mktsegment").alias("_k"), F.col("ds").alias("_d"), "y")
    ser = spine.join(agg, spine["c_mktsegment"].eqNullSafe(agg["_k"]) & (spine["ds"] == agg["_d"]), "left").drop("_k", "_d")
    ser = ffill(ser, KEYS, "ds", "y", "y_ffill")
    ser = bfill(ser, KEYS, "ds", "y", "y_bfill")
    return rounded(drop_last(ser, KEYS, "ds"))


@query("holdout_split", sql=IX_SQL + """
SELECT k AS c_mktsegment, ds, round(y, 2) AS y, CAST(t AS INTEGER) AS t,
       CASE WHEN t > n - 4 THEN 'test' ELSE 'train' END AS split FROM ix""")
def q_holdout_split(spark, sf):
    return rounded(_indexed(spark, sf).select("c_mktsegment", "ds", "y", "t", "split"))


def _pred(spark, sf, model):
    p = FC.closed_form_candidates(_indexed(spark, sf), KEYS, H, SEASON, WINDOW)
    p = p.filter(F.col("model") == model).select("c_mktsegment", "ds", "y", "yhat", "model")
    return rounded(rounded(p, 0, ["yhat"]), 2, ["y"])


def _pred_sql(cte: str) -> str:
    return IX_SQL + f" SELECT k AS c_mktsegment, ds, round(y, 2) AS y, round(yhat, 0) AS yhat, model FROM {cte}"


@query("fc_seasonal_naive", sql=_pred_sql("snaive"))
def q_fc_snaive(spark, sf):
    return _pred(spark, sf, "seasonal_naive")


@query("fc_moving_average", sql=_pred_sql("ma"))
def q_fc_ma(spark, sf):
    return _pred(spark, sf, "moving_average")


@query("fc_linear_trend", sql=_pred_sql("trend"))
def q_fc_trend(spark, sf):
    return _pred(spark, sf, "linear_trend")


def _more_models_sql(h: int, season: int, future_lags: bool = False) -> str:
    """CTEs after `ser`: hold-out of h, the closed forms, smoothing step by step for every alpha, and the
    pooled regression on three lags by successive orthogonal projections."""
    return f""",
ix AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY ds) AS t, count(*) OVER (PARTITION BY k) AS n FROM ser),
train AS (SELECT * FROM ix WHERE t <= n - {h}), test AS (SELECT *, n - {h} AS nt FROM ix WHERE t > n - {h}),
al AS (SELECT CAST(i AS DOUBLE) / 20 AS a FROM range(1, 20) r(i)),
ses(k, a, t, level, sse) AS (
  SELECT k, a, 1, CAST(y AS DOUBLE), CAST(0 AS DOUBLE) FROM train, al WHERE t = 1
  UNION ALL SELECT s.k, s.a, s.t + 1, s.a * tr.y + (1 - s.a) * s.level, s.sse + (tr.y - s.level) * (tr.y - s.level)
    FROM ses s JOIN train tr ON tr.k = s.k AND tr.t = s.t + 1),
sm AS (SELECT s.k, arg_min(s.a, (sse, s.a)) AS alpha, arg_min(level, (sse, s.a)) AS level
         FROM ses s JOIN (SELECT k, max(t) AS t FROM train GROUP BY k) e ON e.k = s.k AND e.t = s.t GROUP BY s.k),
lg AS (SELECT *, lag(y, 1) OVER w AS l1, lag(y, 2) OVER w AS l2, lag(y, 3) OVER w AS l3 FROM ix WINDOW w AS (PARTITION BY k ORDER BY t)),
lt AS (SELECT * FROM lg WHERE t <= n - {h} AND l3 IS NOT NULL),
lm AS (SELECT avg(l1) AS m1, avg(l2) AS m2, avg(l3) AS m3, avg(y) AS my FROM lt),
c0 AS (SELECT l1 - m1 AS c1, l2 - m2 AS c2, l3 - m3 AS c3, y - my AS cy FROM lt, lm),
b1 AS (SELECT sum(c1 * c2) / sum(c1 * c1) AS b21, sum(c1 * c3) / sum(c1 * c1) AS b31, sum(c1 * cy) / sum(c1 * c1) AS g1 FROM c0),
c1 AS (SELECT c2 - b21 * c1 AS r2, c3 - b31 * c1 AS s3, cy FROM c0, b1),
b2 AS (SELECT sum(r2 * s3) / sum(r2 * r2) AS b32, sum(r2 * cy) / sum(r2 * r2) AS g2 FROM c1),
b3 AS (SELECT sum((s3 - b32 * r2) * cy) / sum((s3 - b32 * r2) * (s3 - b32 * r2)) AS g3 FROM c1, b2),
wt AS (SELECT g1 - g2 * b21 - g3 * (b31 - b32 * b21) AS w1, g2 - g3 * b32 AS w2, g3 AS w3 FROM b1, b2, b3),
cf AS (SELECT w1, w2, w3, my - w1 * m1 - w2 * m2 - w3 * m3 AS c FROM wt, lm)"""


WEEK_MORE_SQL = "WITH RECURSIVE " + WEEKLY_SQL.removeprefix("WITH") + _more_models_sql(H, SEASON)


@query("fc_exp_smoothing", sql=WEEK_MORE_SQL + """
SELECT test.k AS c_mktsegment, ds, round(y, 2) AS y, round(level, 0) AS yhat, round(alpha, 2) AS alpha, 'exp_smoothing' AS model
FROM test JOIN sm ON sm.k = test.k""")
def q_fc_ses(spark, sf):
    """Simple exponential smoothing per segment, the alpha found on a grid."""
    r = FC.exp_smoothing(_indexed(spark, sf), KEYS)
    return rounded(rounded(r, 0, ["yhat"]), 2, ["y", "alpha"])


@query("fc_lag_regression", sql=WEEK_MORE_SQL + f"""
SELECT k AS c_mktsegment, ds, round(y, 2) AS y, round(c + w1 * l1 + w2 * l2 + w3 * l3, 0) AS yhat, 'lag_regression' AS model
FROM lg, cf WHERE t > n - {H}""")
def q_fc_lag(spark, sf):
    """Regression on three lags fitted on all segments' training weeks, one step ahead."""
    _, pred = FC.lag_regression(_indexed(spark, sf), KEYS)
    return rounded(rounded(pred, 0, ["yhat"]), 2, ["y"])


def _errors_sql(series: str, freq: str) -> str:
    """CTEs up to `err` (MAPE of the five candidates) and `best` (a series without one: the moving average)."""
    h, season = FC.HORIZON[freq], FC.SEASON[freq]
    return "WITH RECURSIVE " + series.removeprefix("WITH") + _more_models_sql(h, season) + f""",
ahead(k, i, l1, l2, l3) AS (
  SELECT k, 0, max(y) FILTER (t = n - {h}), max(y) FILTER (t = n - {h} - 1), max(y) FILTER (t = n - {h} - 2) FROM ix GROUP BY k
  UNION ALL SELECT k, i + 1, c + w1 * l1 + w2 * l2 + w3 * l3, l1, l2 FROM ahead, cf WHERE i < {h}),
line AS (SELECT k, regr_slope(y, t) AS b, regr_intercept(y, t) AS a FROM train GROUP BY k),
mean AS (SELECT tr.k, avg(tr.y) AS v FROM train tr WHERE tr.t > tr.n - {h} - {WINDOW} GROUP BY tr.k),
pred AS (SELECT test.k, test.ds, test.y, 'seasonal_naive' AS model, tr.y AS yhat
           FROM test LEFT JOIN train tr ON tr.k = test.k AND tr.t = test.t - {season} * ceil((test.t - test.nt) / {season})
  UNION ALL SELECT test.k, test.ds, test.y, 'moving_average', v FROM test JOIN mean ON mean.k = test.k
  UNION ALL SELECT test.k, test.ds, test.y, 'linear_trend', a + b * test.t FROM test JOIN line ON line.k = test.k
  UNION ALL SELECT test.k, test.ds, test.y, 'exp_smoothing', level FROM test JOIN sm ON sm.k = test.k
  UNION ALL SELECT test.k, test.ds, test.y, 'lag_regression', l1 FROM test JOIN ahead ON ahead.k = test.k AND ahead.i = test.t - test.nt),
err AS (SELECT k, model, avg(abs((y - yhat) / y)) AS mape FROM pred WHERE y <> 0 AND yhat IS NOT NULL GROUP BY k, model),
best AS (SELECT s.k, coalesce(e.model, 'moving_average') AS model, e.mape FROM (SELECT DISTINCT k FROM ix) s
  LEFT JOIN (SELECT * FROM err QUALIFY row_number() OVER (PARTITION BY k ORDER BY mape, model) = 1) e ON e.k = s.k)"""


def _select_sql(series: str, freq: str) -> str:
    return _errors_sql(series, freq) + """
SELECT k AS c_mktsegment, model, round(mape, 4) AS mape,
       row_number() OVER (PARTITION BY k ORDER BY mape, model) = 1 AS chosen FROM err"""


WEEK_ERRORS_SQL = _errors_sql(WEEKLY_SQL, "W")


def _fitted(spark, sf, models=FC.LINEAR_FORMS):
    """Weekly series, MAPEs, chosen models and pooled fits of all candidates that SQL can restate."""
    return FC.fit_select(materialize(_weekly(spark, sf)), KEYS, "W", WINDOW, models)


@query("fc_mape", sql=WEEK_ERRORS_SQL + " SELECT k AS c_mktsegment, model, round(mape, 6) AS mape FROM err")
def q_fc_mape(spark, sf):
    """Hold-out error of every candidate and segment."""
    return rounded(_fitted(spark, sf)[1], 6)


@query("fc_best_model", sql=WEEK_ERRORS_SQL + " SELECT k AS c_mktsegment, model, round(mape, 6) AS mape FROM best")
def q_fc_best(spark, sf):
    """The candidate with the least hold-out error of each segment."""
    return rounded(_fitted(spark, sf)[2], 6)


@query("fc_arima", sql=IX_SQL.replace("WITH ", "WITH RECURSIVE ", 1) + f""",
z0 AS (SELECT k, t, y, y - lag(y) OVER w AS z FROM train WINDOW w AS (PARTITION BY k ORDER BY t)),
z1 AS (SELECT *, lag(z, 1) OVER w AS a, lag(z, 2) OVER w AS b FROM z0 WINDOW w AS (PARTITION BY k ORDER BY t)),
mo AS (SELECT k, avg(z) AS mz, avg(a) AS ma, avg(b) AS mb, covar_pop(a, a) AS saa, covar_pop(a, b) AS sab, covar_pop(b, b) AS sbb,
              covar_pop(a, z) AS saz, covar_pop(b, z) AS sbz FROM z1 WHERE b IS NOT NULL GROUP BY k),
co AS (SELECT *, (saz * sbb - sbz * sab) / (saa * sbb - sab * sab) AS u, (sbz * saa - saz * sab) / (saa * sbb - sab * sab) AS v FROM mo),
step(k, i, y, z, zb) AS (
  SELECT k, 0, arg_max(y, t), arg_max(z, t), arg_max(a, t) FROM z1 GROUP BY k
  UNION ALL SELECT s.k, i + 1, y + (mz - u * ma - v * mb + u * z + v * zb), mz - u * ma - v * mb + u * z + v * zb, z
    FROM step s JOIN co ON co.k = s.k WHERE i < {H})
SELECT test.k AS c_mktsegment, test.ds, round(test.y, 2) AS y, round(step.y, 0) AS yhat, round(co.u, 4) AS ar1, round(co.v, 4) AS ar2
FROM test JOIN step ON step.k = test.k AND step.i = test.t - test.nt JOIN co ON co.k = test.k""")
def q_fc_arima(spark, sf):
    """ARIMA(2, 1, 0) of each segment, fitted on the training weeks: its weights and the held-out weeks."""
    g = FC.grouped(_indexed(spark, sf), KEYS, H)
    g = g.withColumn("_m", arima.fitted(F.col("_y"), (2, 1, 0)))
    g = g.withColumn("_p", arima.ahead(F.col("_y"), F.col("_m"), H)).withColumn("_x", F.explode("_tgt"))
    out = g.select(*KEYS, "_x.ds", F.round("_x.y", 2).alias("y"), F.round(F.get("_p", F.col("_x.t") - F.col("nt") - 1), 0).alias("yhat"),
                   F.round(F.col("_m.ar")[0], 4).alias("ar1"), F.round(F.col("_m.ar")[1], 4).alias("ar2"))
    return out


@query("fc_select_every")
def q_fc_select_every(spark, sf):
    """Hold-out errors of all seven candidates on weekly series and the one chosen (ARIMA orders and boosted
    trees have no SQL; the tests hold them against plain versions)."""
    _, err, best, _ = _fitted(spark, sf, FC.MODELS)
    best = best.select(F.col("c_mktsegment").alias("_k"), F.col("model").alias("_m"))
    j = err.join(best, F.col("c_mktsegment").eqNullSafe(F.col("_k")), "left")
    return rounded(j.select("c_mktsegment", "model", "mape", (F.col("model") == F.col("_m")).alias("chosen")), 4, ["mape"])


def _select(spark, sf, freq):
    series = resample(_segment_sales(spark, sf), "o_orderdate", "l_extendedprice", freq, KEYS)
    _, err, best, _ = FC.fit_select(materialize(series), KEYS, freq, WINDOW, FC.LINEAR_FORMS)
    best = best.select(F.col("c_mktsegment").alias("_k"), F.col("model").alias("_m"))
    j = err.join(best, F.col("c_mktsegment").eqNullSafe(F.col("_k")), "left")
    return rounded(j.select("c_mktsegment", "model", "mape", (F.col("model") == F.col("_m")).alias("chosen")), 4, ["mape"])


@query("fc_select_all_day", sql=_select_sql(f"WITH {SEG_SQL}, {_resample_sql('d', 'INTERVAL 1 DAY')}", "D"))
def q_fc_select_day(spark, sf):
    """Hold-out errors of all five candidates on daily series (31 days ahead) and the one chosen."""
    return _select(spark, sf, "D")


@query("fc_select_all_month", sql=_select_sql(f"WITH {SEG_SQL}, {_resample_sql('last_day(d)', '', month=True)}", "M"))
def q_fc_select_month(spark, sf):
    """The same on monthly series (one month ahead)."""
    return _select(spark, sf, "M")


@query("resample_null_segment", sql=f"""
WITH src AS (SELECT c.c_mktsegment, CAST(o.o_orderdate AS DATE) AS d, l.l_extendedprice AS v
  FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey
  LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0) c ON o.o_custkey = c.c_custkey),
{_resample_sql(WEEK_BUCKET, 'INTERVAL 7 DAY', 'src')}
SELECT k AS c_mktsegment, ds, round(y, 2) AS y FROM ser""")
def q_resample_null_segment(spark, sf):
    """Weekly sales per segment where customers without a positive balance are unknown: their sales
    form a series of their own, with a null key."""
    f = orders_fact(load(spark, sf, "orders"), load(spark, sf, "lineitem"))
    c = load(spark, sf, "customer").filter("c_acctbal > 0").select("c_custkey", "c_mktsegment")
    j = f.join(c, f["o_custkey"] == c["c_custkey"], "left")
    return rounded(resample(j, "o_orderdate", "l_extendedprice", "W", KEYS))


def _next(spark, sf):
    s, _, best, fits = _fitted(spark, sf)
    return FC.forecast_next(s, best, KEYS, H, SEASON, WINDOW, "W", FC.LINEAR_FORMS, fits)


def _future_sql(history: str, alpha: str, line: str) -> str:
    """CTEs from `best` to `nxt`: the chosen model of each series carried H weeks beyond `history` (k, ds, y, t, n),
    with the smoothing alphas and trend lines of the given CTEs."""
    return f""",
lastw AS (SELECT k, max(t) AS nt, max(ds) AS lastd FROM {history} GROUP BY k),
fut AS (SELECT k, nt, lastd, i, nt + i AS t FROM lastw, range(1, {H} + 1) r(i)),
lev(k, t, level) AS (SELECT k, 1, CAST(y AS DOUBLE) FROM {history} WHERE t = 1
  UNION ALL SELECT l.k, l.t + 1, a.alpha * h.y + (1 - a.alpha) * l.level
    FROM lev l JOIN {history} h ON h.k = l.k AND h.t = l.t + 1 JOIN {alpha} a ON a.k = l.k),
fah(k, i, l1, l2, l3) AS (
  SELECT h.k, 0, max(y) FILTER (t = nt), max(y) FILTER (t = nt - 1), max(y) FILTER (t = nt - 2) FROM {history} h JOIN lastw ON lastw.k = h.k GROUP BY h.k
  UNION ALL SELECT k, i + 1, c + w1 * l1 + w2 * l2 + w3 * l3, l1, l2 FROM fah, cf WHERE i < {H}),
fall AS (
  SELECT f.*, 'seasonal_naive' AS model, h.y AS yhat FROM fut f LEFT JOIN {history} h ON h.k = f.k AND h.t = f.t - {SEASON} * ceil((f.t - f.nt) / {SEASON})
  UNION ALL SELECT f.*, 'moving_average', m.v FROM fut f JOIN (SELECT h.k, avg(y) AS v FROM {history} h JOIN lastw ON lastw.k = h.k WHERE t > nt - {WINDOW} GROUP BY h.k) m ON m.k = f.k
  UNION ALL SELECT f.*, 'linear_trend', a + b * f.t FROM fut f JOIN {line} li ON li.k = f.k
  UNION ALL SELECT f.*, 'exp_smoothing', level FROM fut f JOIN lev ON lev.k = f.k AND lev.t = f.nt
  UNION ALL SELECT f.*, 'lag_regression', l1 FROM fut f JOIN fah ON fah.k = f.k AND fah.i = f.i),
nxt AS (SELECT fall.k, CAST(fall.lastd + CAST(fall.i * 7 AS INTEGER) AS DATE) AS ds, fall.model, fall.yhat AS predicted_sales
        FROM fall JOIN best ON best.k = fall.k AND best.model = fall.model)"""


def _smoothing_sql(name: str, history: str) -> str:
    """CTE `name` (k, alpha): the alpha of least one-step error over the whole of `history`."""
    return f""",
{name}s(k, a, t, level, sse) AS (
  SELECT k, a, 1, CAST(y AS DOUBLE), CAST(0 AS DOUBLE) FROM {history}, al WHERE t = 1
  UNION ALL SELECT s.k, s.a, s.t + 1, s.a * h.y + (1 - s.a) * s.level, s.sse + (h.y - s.level) * (h.y - s.level)
    FROM {name}s s JOIN {history} h ON h.k = s.k AND h.t = s.t + 1),
{name} AS (SELECT s.k, arg_min(s.a, (sse, s.a)) AS alpha FROM {name}s s JOIN (SELECT k, max(t) AS t FROM {history} GROUP BY k) e
  ON e.k = s.k AND e.t = s.t GROUP BY s.k),
{name}l AS (SELECT k, regr_slope(y, t) AS b, regr_intercept(y, t) AS a FROM {history} GROUP BY k)"""


NEXT_SQL = WEEK_ERRORS_SQL + _smoothing_sql("whole", "ix") + _future_sql("ix", "whole", "wholel")


@query("forecast_next", sql=NEXT_SQL + " SELECT k AS c_mktsegment, ds, model, round(predicted_sales, 0) AS predicted_sales FROM nxt")
def q_forecast_next(spark, sf):
    """The selected model refitted on the whole series, next 4 weeks per segment."""
    return rounded(_next(spark, sf), 0)


@query("actual_vs_forecast", sql=WEEK_ERRORS_SQL + """,
bp AS (SELECT pred.* FROM pred JOIN best ON best.k = pred.k AND best.model = pred.model)
SELECT coalesce(test.k, bp.k) AS c_mktsegment, coalesce(test.ds, bp.ds) AS ds, round(test.y, 2) AS actual,
       round(bp.yhat, 0) AS predicted
FROM test FULL JOIN bp ON bp.k = test.k AND bp.ds = test.ds""")
def q_actual_vs_forecast(spark, sf):
    s, _, best, fits = _fitted(spark, sf)
    bp = FC._of_best(FC.holdout_predictions(s, KEYS, "W", WINDOW, FC.LINEAR_FORMS, fits), best, KEYS)
    j = FC.compare(s.filter(F.col("split") == "test"), bp, KEYS)
    return rounded(rounded(j, 0, ["predicted"]), 2, ["actual"])


OLD_SERIES_SQL = WEEKLY_SQL.replace("ser AS (", "ser0 AS (") + f""",
ser AS (SELECT k, ds, y FROM ser0 QUALIFY row_number() OVER (PARTITION BY k ORDER BY ds DESC) > {H})"""
STORE_SQL = _errors_sql(OLD_SERIES_SQL, "W") + _smoothing_sql("old", "ix") + """,
full0 AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY ds) AS t, count(*) OVER (PARTITION BY k) AS n FROM ser0)""" \
    + _future_sql("full0", "old", "oldl")


def _stored_model(spark, sf, models):
    """(store, all weeks): a model trained and registered when the last H weeks were not yet known."""
    store = ModelStore(spark, scratch_path(spark, f"models-{uuid.uuid4().hex}"))
    weeks = materialize(_weekly(spark, sf))
    FP.train(store, "weekly-sales", drop_last(weeks, KEYS, "ds", H), KEYS, "W", WINDOW, models)
    return store, weeks


@query("forecast_from_store", sql=STORE_SQL + """
SELECT k AS c_mktsegment, ds, model, round(predicted_sales, 0) AS predicted_sales, CAST(1 AS BIGINT) AS version FROM nxt""")
def q_forecast_from_store(spark, sf):
    """Train on all but the last 4 weeks, register, then load the newest version and score the series that has
    grown by 4 weeks: nothing is fitted again."""
    store, weeks = _stored_model(spark, sf, FC.LINEAR_FORMS)
    return rounded(FP.infer(store, "weekly-sales", weeks), 0, ["predicted_sales"])


@query("forecast_job_history", sql=STORE_SQL + """
SELECT k AS c_mktsegment, ds, model, round(predicted_sales, 0) AS predicted_sales, run_id
FROM nxt, (VALUES ('monday'), ('tuesday')) r(run_id)""")
def q_forecast_job_history(spark, sf):
    """Two scoring runs appended to a history, the first one repeated as after a failure: one copy of each run."""
    store, weeks = _stored_model(spark, sf, FC.LINEAR_FORMS)
    path = scratch_path(spark, f"history-{uuid.uuid4().hex}")
    for run in ("monday", "monday", "tuesday"):
        out = FP.score_and_append(spark, store, "weekly-sales", weeks, path, run)
    return rounded(out.select(*KEYS, "ds", "model", "predicted_sales", F.col("run_id").cast("string").alias("run_id")), 0, ["predicted_sales"])


@query("model_latest", sql=IX_SQL + """,
v1 AS (SELECT k, regr_slope(y, t) AS slope, regr_intercept(y, t) AS intercept, 1 AS version FROM train WHERE t <= n // 2 GROUP BY k),
v2 AS (SELECT k, regr_slope(y, t) AS slope, regr_intercept(y, t) AS intercept, 2 AS version FROM train GROUP BY k),
reg AS (SELECT * FROM v1 UNION ALL SELECT * FROM v2),
lat AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY version DESC) AS rn FROM reg) WHERE rn = 1)
SELECT 'sales_trend' AS name, k AS c_mktsegment, CAST(version AS BIGINT) AS version, round(slope, 4) AS slope,
       round(intercept, 2) AS intercept FROM lat""")
def q_model_latest(spark, sf):
    """Register two fits of the trend model (first half, then all of the training data) and read
    the newest integer version per segment."""
    s = _indexed(spark, sf).filter(F.col("split") == "train")

    def fit(df):
        return df.groupBy(*KEYS).agg(F.regr_slope("y", "t").alias("slope"), F.regr_intercept("y", "t").alias("intercept"))

    reg = FC.register(None, fit(s.filter(F.col("t") <= F.floor(F.col("n") / 2))), "sales_trend")
    reg = FC.register(reg, fit(s), "sales_trend")
    lat = FC.latest(reg, KEYS)
    return rounded(rounded(lat, 4, ["slope"]), 2, ["intercept"]).select("name", *KEYS, "version", "slope", "intercept")


@query("forecast_measure", sql=NEXT_SQL + f""",
fc AS (SELECT ds AS d, sum(predicted_sales) AS p FROM nxt GROUP BY ds),
sales AS (SELECT year(order_date) * 100 + month(order_date) AS ym, sum(l_extendedprice) AS s FROM {FACT_SQL} f GROUP BY 1),
fcm AS (SELECT year(d) * 100 + month(d) AS ym, sum(p) AS p FROM fc GROUP BY 1)
SELECT CAST(coalesce(sales.ym, fcm.ym) AS INTEGER) AS year_month, round(sales.s, 2) AS total_sales,
       round(fcm.p, 0) AS total_sales_forecast
FROM sales FULL JOIN fcm ON sales.ym = fcm.ym""")
def q_forecast_measure(spark, sf):
    """The forecast table as a second fact on Date: actual and forecast sales by month."""
    nxt = materialize(_next(spark, sf))
    fc = nxt.groupBy(F.col("ds").alias("date")).agg(F.sum("predicted_sales").alias("predicted_sales")) \
        .withColumns({"date_key": (F.year("date") * 10000 + F.month("date") * 100 + F.dayofmonth("date")).cast("int"),
                      "prediction_ts": F.current_timestamp()})
    m = sales_model(spark, sf, forecast=fc)
    m.tables["date"] = (lambda base: (lambda: base().withColumn(
        "year_month", (F.col("year_number") * 100 + F.col("month_number")).cast("int"))))(m.tables["date"])
    r = m.evaluate(["total_sales", "total_sales_forecast"], ["date.year_month"])
    return rounded(rounded(r, 0, ["total_sales_forecast"]), 2, ["total_sales"])


@query("top1_per_key", sql=f"""
WITH s AS (SELECT c.c_nationkey, c.c_custkey, c.c_name, sum(f.l_extendedprice) AS sales
           FROM {FACT_SQL} f JOIN customer c ON f.o_custkey = c.c_custkey GROUP BY 1, 2, 3),
r AS (SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY sales DESC, c_name) AS rn FROM s)
SELECT c_nationkey, c_custkey, c_name, round(sales, 2) AS sales FROM r WHERE rn = 1""")
def q_top1_per_key(spark, sf):
    """Best customer per nation by sales, ties broken by name."""
    f = orders_fact(load(spark, sf, "orders"), load(spark, sf, "lineitem"))
    c = load(spark, sf, "customer")
    s = f.join(c, f["o_custkey"] == c["c_custkey"]).groupBy("c_nationkey", "c_custkey", "c_name") \
        .agg(F.sum("l_extendedprice").alias("sales"))
    return rounded(top_n_per(s, ["c_nationkey"], [F.col("sales").desc(), F.col("c_name")], 1))


@query("last_n_dates", sql=f"""
SELECT order_date AS date, round(sum(l_extendedprice), 2) AS total_sales FROM {FACT_SQL} f
GROUP BY 1 ORDER BY 1 DESC LIMIT 31""")
def q_last_n_dates(spark, sf):
    """Sales of the 31 latest order dates, re-sorted ascending (input window of the forecaster)."""
    m = sales_model(spark, sf)
    daily = m.evaluate(["total_sales"], ["date.date"])
    return rounded(last_n(daily, "date", 31))


@query("forecast_history", sql=NEXT_SQL + " SELECT k AS c_mktsegment, ds, model, round(predicted_sales, 0) AS predicted_sales FROM nxt")
def q_forecast_history(spark, sf):
    """Two forecast runs appended to a history table with their run timestamps; the latest run
    per segment and date is read back (without its timestamp, which differs per run)."""
    import time

    from tessera.sources.sinks import append_table, latest_run
    path = scratch_path(spark, f"forecast-history-{uuid.uuid4().hex}")
    nxt = _next(spark, sf)
    append_table(nxt, path)
    time.sleep(0.01)
    append_table(nxt, path)
    hist = spark.read.parquet(path)
    return rounded(latest_run(hist, KEYS + ["ds"]).select(*KEYS, "ds", "model", "predicted_sales"), 0)
