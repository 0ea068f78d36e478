"""Service calls as Spark ML transformers: text in, answer and error out, usable and saved in a Pipeline.

The service is a Python function of a list of texts, named as "module:function" so that a saved
pipeline finds it again on every executor.  Texts stream through it in requests of bounded size;
a request that fails is tried again, then halved, so that only the texts that cannot be answered
keep an error.
"""
from __future__ import annotations

import importlib
import time
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def named_function(name: str) -> Callable:
    module, _, function = name.partition(":")
    return getattr(importlib.import_module(module), function)


def requests(texts: list[str], max_items: int, max_chars: int) -> Iterator[list[int]]:
    """Positions of the texts of each request: at most `max_items`, and `max_chars` characters unless one text
    alone is longer."""
    now, chars = [], 0
    for i, t in enumerate(texts):
        if now and (len(now) == max_items or chars + len(t) > max_chars):
            yield now
            now, chars = [], 0
        now.append(i)
        chars += len(t)
    if now:
        yield now


def ask(fn: Callable, texts: list[str], retries: int, wait: float) -> list[tuple[object, str | None]]:
    """(answer, error) of each text of one request."""
    error = None
    for n in range(retries):
        try:
            answers = list(fn(texts))
            if len(answers) != len(texts):
                raise ValueError(f"{len(answers)} answers for {len(texts)} texts")
            return [(a, None if a is not None else "no answer for this text") for a in answers]
        except Exception as e:  # noqa: BLE001 - any failure of the service is reported by text
            error = f"{type(e).__name__}: {e}"
            if wait and n + 1 < retries:
                time.sleep(wait * 2 ** n)
    if len(texts) == 1:
        return [(None, error)]
    half = len(texts) // 2
    return ask(fn, texts[:half], retries, wait) + ask(fn, texts[half:], retries, wait)


class TextService(Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Adds ``outputCol`` (the answer, null without one) and ``errorCol`` (null where all is well) to each row; a
    null text has neither.  Rows stay in their partitions: no shuffle, nothing gathered on the driver.
    A row that Spark computes again is asked for again; keep answers (a written table, or
    ``operators.ledger``) where that matters."""

    function = Param(Params._dummy(), "function", "the service as module:function", TypeConverters.toString)
    errorCol = Param(Params._dummy(), "errorCol", "error column", TypeConverters.toString)
    answerType = Param(Params._dummy(), "answerType", "string or array<double>", TypeConverters.toString)
    maxItems = Param(Params._dummy(), "maxItems", "texts of a request at most", TypeConverters.toInt)
    maxChars = Param(Params._dummy(), "maxChars", "characters of a request at most", TypeConverters.toInt)
    retries = Param(Params._dummy(), "retries", "times a request is tried", TypeConverters.toInt)
    waitSeconds = Param(Params._dummy(), "waitSeconds", "first wait between tries, doubled each time", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, inputCol=None, outputCol=None, errorCol=None, function=None, answerType=None, maxItems=None, maxChars=None,
                 retries=None, waitSeconds=None):
        super().__init__()
        self._setDefault(errorCol="error", answerType="string", maxItems=100, maxChars=45000, retries=3, waitSeconds=0.0)
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, dataset: DataFrame) -> DataFrame:
        get = lambda p: self.getOrDefault(p)
        name, items, chars, tries, wait = (get(p) for p in (self.function, self.maxItems, self.maxChars, self.retries, self.waitSeconds))
        kind = {"string": pa.string(), "array<double>": pa.list_(pa.float64())}[get(self.answerType)]

        def call(texts: pa.Array) -> pa.Array:
            fn, values = named_function(name), texts.to_pylist()
            at = [i for i, t in enumerate(values) if t is not None]
            answers, errors = [None] * len(values), [None] * len(values)
            for request in requests([values[i] for i in at], items, chars):
                for k, (answer, error) in zip(request, ask(fn, [values[at[k]] for k in request], tries, wait)):
                    answers[at[k]], errors[at[k]] = answer, error
            return pa.StructArray.from_arrays([pa.array(answers, kind), pa.array(errors, pa.string())], names=["answer", "error"])

        udf = F.arrow_udf(call, f"struct<answer:{get(self.answerType)},error:string>").asNondeterministic()
        both = "__answered"
        while both in dataset.columns:
            both += "_"
        out = dataset.withColumn(both, udf(F.col(self.getInputCol()).cast("string")))
        return out.withColumns({self.getOutputCol(): F.col(f"{both}.answer"), get(self.errorCol): F.col(f"{both}.error")}).drop(both)


class TextTranslator(TextService):
    """A service that gives a string for each text."""


class TextEmbedder(TextService):
    """A service that gives a vector (list of numbers) for each text."""

    @keyword_only
    def __init__(self, *, inputCol=None, outputCol=None, errorCol=None, function=None, answerType=None, maxItems=None, maxChars=None,
                 retries=None, waitSeconds=None):
        super().__init__(**self._input_kwargs)
        self._setDefault(answerType="array<double>")
