"""Forecast jobs: train and register, then score from the store and append the history."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import forecast as FC
from tessera.operators.trees import Trees
from tessera.sources.model_store import ModelStore
from tessera.sources.sinks import append_run


def train(store: ModelStore, name: str, series: DataFrame, keys: list[str], freq: str, window: int = 8,
          models: tuple = FC.MODELS) -> int:
    """Choose a model for each series by hold-out, fit it on the whole series and register all parameters as
    the next version of `name`."""
    s, _, best, fits = FC.fit_select(series, keys, freq, window, models)
    boosted = fits.get("boosted_trees")
    document = {"keys": keys, "freq": freq, "window": window, "models": list(models),
                "lag_regression": fits.get("lag_regression"), "boosted_trees": boosted and boosted.to_json()}
    return store.register(name, FC.series_parameters(s, best, keys), document)


def infer(store: ModelStore, name: str, series: DataFrame, version: int | None = None) -> DataFrame:
    """The next periods of `series` (keys, ds, y) by a stored version (the newest), without fitting anything:
    keys, ds, model, predicted_sales, version."""
    version, parameters, d = store.load(name, version)
    fits = {"lag_regression": d["lag_regression"], "boosted_trees": d["boosted_trees"] and Trees.from_json(d["boosted_trees"])}
    out = FC.forecast_known(series, parameters, d["keys"], d["freq"], d["window"], fits, tuple(d["models"]))
    return out.withColumn("version", F.lit(version).cast("long"))


def score_and_append(spark: SparkSession, store: ModelStore, name: str, series: DataFrame, history: str, run_id: str) -> DataFrame:
    """Score with the newest version and append the forecast to the history table under `run_id` (a repeated
    run replaces its own rows); returns the history."""
    append_run(infer(store, name, series), history, run_id)
    return spark.read.parquet(history)
