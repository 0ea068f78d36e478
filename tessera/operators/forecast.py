"""Forecasting many series at once: hold-out split, candidate forecasters,
MAPE, per-series model selection, next-horizon forecast and a versioned
model table.

Input series are long frames (keys…, ds, y) after ``resample``.  A series is
reduced to one row (its history as an array, bounded by the number of periods,
and a trend line), and every candidate is an expression over that row: seasonal
naive, moving average, linear trend, simple exponential smoothing, a regression
on lags and boosted trees that Spark ML fits on all series together, and an ARIMA
model of each series.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators import arima, trees

# Per-frequency horizon and season length.
HORIZON = {"D": 31, "W": 4, "M": 1}
SEASON = {"D": 7, "W": 52, "M": 12}
CLOSED_FORMS = ("seasonal_naive", "moving_average", "linear_trend")
LINEAR_FORMS = CLOSED_FORMS + ("exp_smoothing", "lag_regression")  # what SQL can restate
MODELS = LINEAR_FORMS + ("arima", "boosted_trees")
FALLBACK = "moving_average"  # of a series that cannot be scored; it needs one value only
ALPHAS = tuple(k / 20 for k in range(1, 20))
STEP_DAYS = {"D": 1, "W": 7}


def index_series(series: DataFrame, keys: list[str], h: int) -> DataFrame:
    """Add t (1-based position), n (series length) and split ('train' / 'test' = last h)."""
    w = Window.partitionBy(*keys).orderBy("ds")
    wn = Window.partitionBy(*keys)
    s = series.withColumn("t", F.row_number().over(w)).withColumn("n", F.count(F.lit(1)).over(wn))
    return s.withColumn("split", F.when(F.col("t") > F.col("n") - h, "test").otherwise("train"))


def grouped(s: DataFrame, keys: list[str], h: int, future: bool = False) -> DataFrame:
    """One row per series: its history (array by t), trend line, length nt, and its targets (the
    held-out part, or the next h positions).  Every candidate is derived from that row; it is as
    long as the series has periods."""
    fit = F.lit(True) if future else F.col("split") == "train"
    point = lambda c, *f: F.sort_array(F.collect_list(F.when(c, F.struct(*f))))
    g = s.groupBy(*keys).agg(
        point(fit, "t", "y").alias("_h"), point(~fit, "t", "ds", "y").alias("_test"), F.max("ds").alias("_last"),
        F.min("ds").alias("_first"), F.max(F.when(fit, F.col("ds"))).alias("_fit_last"),
        F.regr_slope(F.when(fit, F.col("y")), F.col("t")).alias("_b"),
        F.regr_intercept(F.when(fit, F.col("y")), F.col("t")).alias("_a"))
    g = g.withColumn("_y", F.transform("_h", lambda x: x["y"])).withColumn("nt", F.size("_y"))
    nxt = F.transform(F.sequence(F.lit(1), F.lit(h)), lambda i: F.struct(
        (F.col("nt") + i).cast("int").alias("t"), F.lit(None).cast("date").alias("ds"), F.lit(None).cast("double").alias("y")))
    return g.withColumn("_tgt", nxt if future else F.col("_test"))


def smoothed_level(y: Column) -> Column:
    """struct(sse, alpha, level) of simple exponential smoothing: the least one-step squared error
    over the grid of ALPHAS (ties: the smaller alpha), and the level after the last value."""
    def run(alpha: Column) -> Column:
        start = F.struct(F.lit(0.0).alias("sse"), F.get(y, F.lit(0)).cast("double").alias("level"))
        end = F.aggregate(F.slice(y, 2, F.greatest(F.size(y) - 1, F.lit(0))), start, lambda acc, v: F.struct(
            (acc["sse"] + (v - acc["level"]) * (v - acc["level"])).alias("sse"),
            (alpha * v + (F.lit(1.0) - alpha) * acc["level"]).alias("level")))
        return F.struct(end["sse"].alias("sse"), alpha.alias("alpha"), end["level"].alias("level"))
    return F.array_min(F.transform(F.array(*map(F.lit, ALPHAS)), run))


def level_by(y: Column, alpha: Column) -> Column:
    """Level after the last value by a known alpha."""
    rest = F.slice(y, 2, F.greatest(F.size(y) - 1, F.lit(0)))
    return F.aggregate(rest, F.get(y, F.lit(0)).cast("double"), lambda level, v: alpha * v + (F.lit(1.0) - alpha) * level)


def lagged(y: Column, h: int, intercept: float, weights: list[float]) -> Column:
    """The next h values of a regression on the last len(weights) ones, each prediction feeding the
    next; null without enough history."""
    n = len(weights)

    def step(acc: Column, _: Column) -> Column:
        value = F.lit(float(intercept))
        for k, w in enumerate(weights):
            value = value + F.lit(float(w)) * F.element_at(acc, -(k + 1))
        return F.concat(acc, F.array(value))
    return F.when(F.size(y) >= n, F.slice(F.aggregate(F.sequence(F.lit(1), F.lit(h)), F.slice(y, -n, n), step), n + 1, h))


def candidates(g: DataFrame, keys: list[str], h: int, season: int, window: int, models: tuple = (), fits: dict | None = None,
               known: str | None = None) -> DataFrame:
    """Predictions of the wanted models (default: the closed forms) for the targets of `grouped`:
    keys, ds, t, nt, y, yhat, model, _last.  `fits` holds the models of all series together (see
    `pooled_fits`); `known` is a struct column with the parameters of each series' own models, where
    they are not to be fitted again (see `series_parameters`)."""
    models, fits = models or CLOSED_FORMS, fits or {}
    y, tail = F.col("_y"), F.slice(F.col("_y"), F.greatest(F.col("nt") - window + 1, F.lit(1)), window)
    mean = F.try_divide(F.aggregate(tail, F.lit(0.0), lambda a, v: a + v), F.size(tail))
    if known:
        g = g.withColumn("_b", F.col(f"{known}.slope")).withColumn(  # positions count from the first period of the fit
            "_a", F.col(f"{known}.intercept") + F.col("_b") * F.col("_shift"))
    if "exp_smoothing" in models:
        level = level_by(y, F.col(f"{known}.alpha")) if known else smoothed_level(y)["level"]
        g = g.withColumn("_level", F.when(F.size(y) > 0, level))
    if "lag_regression" in models:
        intercept, weights = fits["lag_regression"]
        g = g.withColumn("_lagged", lagged(y, h, intercept, weights))
    if "arima" in models:
        g = g.withColumn("_arima", arima.ahead(y, F.col(f"{known}.arima") if known else arima.fitted(y), h))
    if fits.get("boosted_trees"):
        scale = F.try_divide(F.aggregate(y, F.lit(0.0), lambda a, v: a + v), F.size(y))
        g = g.withColumn("_boosted", trees.ahead(y, scale, F.col("_fit_last"), fits["boosted_trees"], h))
    out = g.withColumn("_x", F.explode("_tgt")).select(
        *keys, "nt", "_last", "_y", "_a", "_b", mean.alias("_mean"), F.col("_x.ds").alias("ds"), F.col("_x.t").alias("t"),
        F.col("_x.y").alias("y"), *[c for c in ("_level", "_lagged", "_arima", "_boosted") if c in g.columns])
    ahead = F.col("t") - F.col("nt")
    source = (F.col("t") - season * F.ceil(ahead / season)).cast("int")
    forms = {"seasonal_naive": F.when(source >= 1, F.get("_y", source - 1)), "moving_average": F.col("_mean"),
             "linear_trend": F.col("_a") + F.col("_b") * F.col("t")}
    if "_level" in out.columns:
        forms["exp_smoothing"] = F.col("_level")
    if "_lagged" in out.columns:
        forms["lag_regression"] = F.get("_lagged", ahead.cast("int") - 1)
    if "_arima" in out.columns:
        forms["arima"] = F.get("_arima", ahead.cast("int") - 1)
    if "_boosted" in out.columns:
        forms["boosted_trees"] = F.get("_boosted", ahead.cast("int") - 1)
    each = F.array(*[F.struct(F.lit(m).alias("model"), forms[m].cast("double").alias("yhat")) for m in models if m in forms])
    return out.withColumn("_m", F.explode(each)).select(*keys, "ds", "t", "nt", "y", "_m.yhat", "_m.model", "_last")


def closed_form_candidates(s: DataFrame, keys: list[str], h: int, season: int, window: int,
                           future: bool = False) -> DataFrame:
    """Predictions of the three closed-form candidates for the test part (or the next h periods)."""
    return candidates(grouped(s, keys, h, future), keys, h, season, window)


def mape(pred: DataFrame, keys: list[str]) -> DataFrame:
    """Mean absolute percentage error per (keys, model); zero actuals are excluded."""
    ok = pred.filter((F.col("y") != 0) & F.col("yhat").isNotNull())
    return ok.groupBy(*keys, "model").agg(F.avg(F.abs((F.col("y") - F.col("yhat")) / F.col("y"))).alias("mape"))


def best_model(errors: DataFrame, keys: list[str], series: DataFrame | None = None) -> DataFrame:
    """Lowest MAPE per series; ties go to the model name.  With `series`, those that no MAPE could be
    computed for (a hold-out of zeros only, or no more points than the horizon) take FALLBACK,
    with a null mape."""
    best = errors.groupBy(*keys).agg(F.min(F.struct("mape", "model")).alias("_e")).select(*keys, "_e.model", "_e.mape")
    if series is None:
        return best
    every = series.select(*keys).distinct()
    got = best.select(*[F.col(k).alias(f"_k_{k}") for k in keys], "model", "mape")
    same = [every[k].eqNullSafe(got[f"_k_{k}"]) for k in keys]
    return every.join(got, same, "left").select(*keys, F.coalesce("model", F.lit(FALLBACK)).alias("model"), "mape")


def _of_best(pred: DataFrame, best: DataFrame, keys: list[str]) -> DataFrame:
    chosen = best.select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col("model").alias("_best"))
    same = [pred[k].eqNullSafe(chosen[f"_k_{k}"]) for k in keys] + [pred["model"] == chosen["_best"]]
    return pred.join(chosen, same, "left_semi")


def next_periods(pred: DataFrame, keys: list[str], freq: str) -> DataFrame:
    """(keys, ds, model, predicted_sales): predictions of `candidates` at their future dates."""
    ahead = (F.col("t") - F.col("nt")).cast("int")
    return pred.select(*keys, trees.later(F.col("_last"), ahead, freq).alias("ds"), "model", F.col("yhat").alias("predicted_sales"))


def forecast_next(s: DataFrame, best: DataFrame, keys: list[str], h: int, season: int, window: int,
                  freq: str, models: tuple = (), fits: dict | None = None) -> DataFrame:
    """Refit the selected model on the whole series and predict the next h periods."""
    pred = _of_best(candidates(grouped(s, keys, h, True), keys, h, season, window, models, fits), best, keys)
    return next_periods(pred, keys, freq)


def compare(actual: DataFrame, pred: DataFrame, keys: list[str]) -> DataFrame:
    """Actual vs predicted aligned on (keys, ds) with a full outer join: periods only one side
    has keep a NULL on the other."""
    both = keys + ["ds"]
    a = actual.select(*both, F.col("y").alias("actual"))
    p = pred.select(*[F.col(k).alias(f"_r_{k}") for k in both], F.col("yhat").alias("predicted"))
    j = a.join(p, [a[k].eqNullSafe(p[f"_r_{k}"]) for k in both], "full")
    # keys may be null on purpose: take the side that has the date
    return j.select(*[F.when(F.col("ds").isNotNull(), F.col(k)).otherwise(F.col(f"_r_{k}")).alias(k) for k in both],
                    "actual", "predicted")


# --- exponential smoothing ----------------------------------------------------------------

def exp_smoothing(s: DataFrame, keys: list[str]) -> DataFrame:
    """Simple exponential smoothing per series, fitted on 'train', flat over 'test'."""
    g = grouped(s, keys, 1).filter(F.size("_y") > 0).withColumn("_s", smoothed_level(F.col("_y")))
    return g.withColumn("_x", F.explode("_tgt")).select(
        *keys, "_x.ds", "_x.y", F.col("_s.level").alias("yhat"), "_s.alpha", F.lit("exp_smoothing").alias("model"))


# --- lag-feature regression (Spark ML) --------------------------------------------------------

def lag_regression(s: DataFrame, keys: list[str], lags=(1, 2, 3)):
    """Spark ML pipeline (assembler + linear regression) on lagged values of each series;
    fitted on 'train' rows, applied to 'test' rows.  Returns (model, predictions)."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression

    w = Window.partitionBy(*keys).orderBy("t")
    f = s
    for lag in lags:
        f = f.withColumn(f"lag{lag}", F.lag("y", lag).over(w))
    f = f.dropna(subset=[f"lag{lag}" for lag in lags])
    pipe = Pipeline(stages=[VectorAssembler(inputCols=[f"lag{lag}" for lag in lags], outputCol="features"),
                            LinearRegression(featuresCol="features", labelCol="y", predictionCol="yhat")])
    train = f.filter(F.col("split") == "train")
    if train.isEmpty():
        return None, f.limit(0).select(*keys, "ds", "y", F.lit(None).cast("double").alias("yhat"), F.lit("lag_regression").alias("model"))
    model = pipe.fit(train)
    pred = score(f.filter(F.col("split") == "test"), model)
    return model, pred.select(*keys, "ds", "y", "yhat").withColumn("model", F.lit("lag_regression"))


def score(df: DataFrame, model) -> DataFrame:
    """Batch scoring with a fitted pipeline: column-in / column-out."""
    return model.transform(df)


# --- versioned model table --------------------------------------------------------------------

def register(registry: DataFrame | None, fitted: DataFrame, name: str) -> DataFrame:
    """Append `fitted` (one row per series) to the registry as the next integer version of `name`."""
    if registry is None:
        return fitted.withColumns({"name": F.lit(name), "version": F.lit(1).cast("bigint")})
    nxt = registry.filter(F.col("name") == name).agg(
        (F.coalesce(F.max("version"), F.lit(0)) + 1).cast("bigint").alias("version"))
    new = fitted.withColumns({"name": F.lit(name), "_one": F.lit(1)}) \
        .join(nxt.withColumn("_one", F.lit(1)), "_one").drop("_one")
    return registry.unionByName(new)


def latest(registry: DataFrame, keys: list[str]) -> DataFrame:
    """Newest version per (name, keys): compares integer versions."""
    w = Window.partitionBy("name", *keys).orderBy(F.col("version").desc())
    return registry.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def lag_weights(s: DataFrame, keys: list[str], lags=(1, 2, 3)) -> tuple[float, list[float]]:
    """(intercept, weights of the lags) of the pooled regression on all series' training points; a
    flat forecast of the last value where there is nothing to fit."""
    model, _ = lag_regression(s, keys, lags)
    if model is None:
        return 0.0, [1.0] + [0.0] * (len(lags) - 1)
    return float(model.stages[-1].intercept), [float(w) for w in model.stages[-1].coefficients]


def pooled_fits(s: DataFrame, keys: list[str], freq: str, models: tuple = MODELS) -> dict:
    """The models that all series share, from their training points: lag regression (intercept, weights)
    and boosted trees (None if no series is long enough)."""
    out = {}
    if "lag_regression" in models:
        out["lag_regression"] = lag_weights(s, keys)
    if "boosted_trees" in models:
        out["boosted_trees"] = trees.fit(s, keys, freq)
    return out


def holdout_predictions(s: DataFrame, keys: list[str], freq: str, window: int, models: tuple, fits: dict) -> DataFrame:
    """Predictions of every candidate for the held-out part."""
    return candidates(grouped(s, keys, HORIZON[freq]), keys, HORIZON[freq], SEASON[freq], window, models, fits)


def fit_select(series: DataFrame, keys: list[str], freq: str, window: int = 8, models: tuple = MODELS):
    """Hold-out selection among all candidates in one call: (indexed series, MAPE per series and
    model, best model per series, pooled fits) for the frequency's horizon and season."""
    s = index_series(series, keys, HORIZON[freq])
    fits = pooled_fits(s, keys, freq, models)
    err = mape(holdout_predictions(s, keys, freq, window, models, fits), keys)
    return s, err, best_model(err, keys, s), fits


def series_parameters(s: DataFrame, best: DataFrame, keys: list[str]) -> DataFrame:
    """One row a series: its chosen model, and the parameters of its own models fitted on the whole series
    (first period, trend line, smoothing alpha, ARIMA), for `forecast_known`."""
    g = grouped(s, keys, 1, True)
    own = g.select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col("_first").alias("first"), F.struct(
        F.col("_b").alias("slope"), F.col("_a").alias("intercept"), smoothed_level(F.col("_y"))["alpha"].alias("alpha"),
        arima.fitted(F.col("_y")).alias("arima")).alias("fitted"))
    same = [best[k].eqNullSafe(own[f"_k_{k}"]) for k in keys]
    return best.join(own, same).select(*keys, "model", "mape", "first", "fitted")


def forecast_known(series: DataFrame, parameters: DataFrame, keys: list[str], freq: str, window: int, fits: dict,
                   models: tuple = MODELS) -> DataFrame:
    """The next periods of (keys, ds, y) by stored parameters: nothing is fitted.  The series may have grown
    since the fit; one that the parameters do not know takes FALLBACK."""
    h = HORIZON[freq]
    g = grouped(index_series(series, keys, 0), keys, h, True)
    p = parameters.select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col("model").alias("_chosen"), F.col("first").alias("_p_first"),
                          F.col("fitted").alias("_fitted"))
    g = g.join(p, [g[k].eqNullSafe(p[f"_k_{k}"]) for k in keys], "left")
    apart = F.months_between(F.last_day("_first"), F.last_day("_p_first")).cast("int") if freq == "M" else \
        (F.datediff("_first", "_p_first") / STEP_DAYS[freq]).cast("int")
    g = g.withColumn("_shift", F.coalesce(apart, F.lit(0)))
    chosen = g.select(*keys, F.coalesce("_chosen", F.lit(FALLBACK)).alias("model"))
    pred = candidates(g.drop(*[f"_k_{k}" for k in keys]), keys, h, SEASON[freq], window, models, fits, "_fitted")
    return next_periods(_of_best(pred, chosen, keys), keys, freq)
