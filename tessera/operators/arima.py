"""ARIMA candidates: order and coefficients of each series from its own lags.

A series is one row (its history as an array), so a fit is an Arrow function of that column: the
number of differences is the one with the least spread, autoregressive weights are the linear
solve of the lag moments, moving-average weights that of the lags and of the residuals of a long
autoregression (Hannan and Rissanen), and the order has the least AICc over a common sample.
"""
from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

MOST = (3, 1, 2)  # p, d and q tried, at most
LONG = 10         # lags of the long autoregression, at most
FIT = "struct<p:int,d:int,q:int,intercept:double,ar:array<double>,ma:array<double>,aicc:double>"


@dataclass(frozen=True)
class Arima:
    d: int
    intercept: float
    ar: tuple[float, ...] = ()
    ma: tuple[float, ...] = ()
    aicc: float | None = None


def lagged(z: np.ndarray, lags: int, start: int) -> np.ndarray:
    """Row i: z[start + i - 1], ..., z[start + i - lags]."""
    return np.column_stack([z[start - k:len(z) - k] for k in range(1, lags + 1)]) if lags else np.zeros((len(z) - start, 0))


def solve(columns: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Intercept and weights by least squares, from the centred and scaled moments; a dependent column weighs
    as little as possible."""
    mean, spread = columns.mean(axis=0), columns.std(axis=0)
    spread = np.where(spread > 0, spread, 1.0)
    c = (columns - mean) / spread
    w = np.linalg.lstsq(c.T @ c, c.T @ (target - target.mean()), rcond=1e-12)[0] / spread
    return np.concatenate([[target.mean() - mean @ w], w])


def fit_order(y: np.ndarray, p: int, d: int, q: int, start: int | None = None) -> Arima | None:
    """Coefficients of a fixed order; None if the series is too short for it.  `start`: first position of
    the differenced series that is fitted (for one sample common to several orders)."""
    z = np.diff(y, d)
    lead = max(p, min(LONG, len(z) // 4) + q if q else 0)
    start = lead if start is None else start
    n, k = len(z) - start, p + q + 1
    if start < lead or n < k + 2:
        return None
    columns = lagged(z, p, start)
    if q:
        m = lead - q if p <= lead - q else min(LONG, len(z) // 4)
        m = max(m, 1)
        if start < m + q or len(z) - m < m + 2:
            return None
        first = solve(lagged(z, m, m), z[m:])
        e = np.concatenate([np.zeros(m), z[m:] - first[0] - lagged(z, m, m) @ first[1:]])
        columns = np.column_stack([columns, lagged(e, q, start)])
    w = solve(columns, z[start:])
    sse = float(((z[start:] - w[0] - columns @ w[1:]) ** 2).sum())
    scale = float((z[start:] ** 2).sum()) or 1.0
    aicc = n * np.log(max(sse, 1e-12 * scale) / n) + 2 * (k + 1) + 2 * (k + 1) * (k + 2) / max(n - k - 2, 1)
    return Arima(d, float(w[0]), tuple(map(float, w[1:p + 1])), tuple(map(float, w[p + 1:])), float(aicc))


def stable(m: Arima) -> bool:
    """True if neither forecasts nor residuals grow without bound: all roots lie inside the unit circle."""
    return all(np.abs(np.roots([1.0, *w])).max(initial=0) < 0.999 for w in ([-a for a in m.ar], m.ma))


def fit(y: np.ndarray) -> Arima | None:
    """The stable order with the least AICc (ties: the smaller order); None for fewer than 8 values."""
    if len(y) < 8:
        return None
    d = int(np.argmin([np.std(np.diff(y, k)) for k in range(MOST[1] + 1)]))
    z = len(y) - d
    start = min(max(MOST[0], min(LONG, z // 4) + MOST[2]), z // 2)
    found = [m for p in range(MOST[0] + 1) for q in range(MOST[2] + 1) if (m := fit_order(y, p, d, q, start)) and stable(m)]
    return min(found, key=lambda m: (round(m.aicc, 9), len(m.ar) + len(m.ma), len(m.ma)), default=None)


def forecast(y: np.ndarray, m: Arima, h: int) -> np.ndarray:
    """The next h values: residuals are followed through the history (0 before it), future ones are 0."""
    z, p, q = list(np.diff(y, m.d)), len(m.ar), len(m.ma)
    if len(y) < m.d + max(p, 1):
        return np.full(h, np.nan)

    def value(t: int) -> float:
        return m.intercept + sum(w * z[t - k - 1] for k, w in enumerate(m.ar)) + sum(
            w * e[t - k - 1] for k, w in enumerate(m.ma) if t - k - 1 >= 0)

    e = [0.0] * len(z)
    if q:
        for t in range(p, len(z)):
            e[t] = z[t] - value(t)
    for t in range(len(z), len(z) + h):
        e.append(0.0)
        z.append(value(t))
    out = np.array(z[-h:])
    for k in range(m.d - 1, -1, -1):  # back from differences
        out = np.diff(y, k)[-1] + np.cumsum(out)
    return out


def _rows(fits: list[Arima | None]) -> pa.Array:
    kind = pa.struct([("p", pa.int32()), ("d", pa.int32()), ("q", pa.int32()), ("intercept", pa.float64()),
                      ("ar", pa.list_(pa.float64())), ("ma", pa.list_(pa.float64())), ("aicc", pa.float64())])
    return pa.array([m and {"p": len(m.ar), "d": m.d, "q": len(m.ma), "intercept": m.intercept, "ar": m.ar, "ma": m.ma,
                            "aicc": m.aicc} for m in fits], kind)


def fitted(y: Column, order: tuple[int, int, int] | None = None) -> Column:
    """Struct column FIT of each history (array of values): the order with the least AICc, or a fixed one;
    null where the history is too short."""
    def run(values: pa.Array) -> pa.Array:
        ys = [np.array(v if v is not None else [], float) for v in values.to_pylist()]
        return _rows([fit(v) if order is None else fit_order(v, *order) for v in ys])
    return F.arrow_udf(run, FIT)(y)


def ahead(y: Column, model: Column, h: int) -> Column:
    """The next h values by fitted models; null where there is no model."""
    def run(values: pa.Array, models: pa.Array) -> pa.Array:
        out = []
        for v, m in zip(values.to_pylist(), models.to_pylist()):
            x = forecast(np.array(v, float), Arima(m["d"], m["intercept"], tuple(m["ar"]), tuple(m["ma"])), h) if m else None
            out.append(x.tolist() if x is not None and np.isfinite(x).all() else None)
        return pa.array(out, pa.list_(pa.float64()))
    return F.arrow_udf(run, "array<double>")(y, model)
