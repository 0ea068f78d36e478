"""Boosted trees as a forecast candidate: one model for all series, on lags and the calendar.

Values are divided by their series' mean, so that series of all sizes teach one model (Spark ML's
gradient-boosted trees).  The fitted trees are compiled into one Spark column expression; each
step ahead feeds the next inside the row, without Python.
"""
from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LAGS = {"D": 7, "W": 8, "M": 6}
DEPTH, TREES, RATE, SEED = 3, 20, 0.2, 7
Node = dict | float  # {"f": feature, "at": threshold, "le": node, "gt": node}, or the value of a leaf


@dataclass(frozen=True)
class Trees:
    freq: str
    trees: tuple[tuple[float, Node], ...]  # (weight, root)

    def to_json(self) -> str:
        return json.dumps({"freq": self.freq, "trees": self.trees})

    @staticmethod
    def from_json(text: str) -> "Trees":
        d = json.loads(text)
        return Trees(d["freq"], tuple((w, n) for w, n in d["trees"]))

    def column(self, features: list[Column]) -> Column:
        """The ensemble as one expression over its features."""
        def node(n: Node) -> Column:
            if not isinstance(n, dict):
                return F.lit(float(n))
            return F.when(features[n["f"]] <= n["at"], node(n["le"])).otherwise(node(n["gt"]))
        out = F.lit(0.0)
        for w, root in self.trees:
            out = out + F.lit(float(w)) * node(root)
        return out


def calendar(ds: Column, freq: str) -> list[Column]:
    """Calendar features of a period: month, and the weekday or the week of the year."""
    more = {"D": [F.dayofweek(ds)], "W": [F.weekofyear(ds)], "M": []}[freq]
    return [c.cast("double") for c in [F.month(ds), *more]]


def later(ds: Column, steps: Column, freq: str) -> Column:
    return F.last_day(F.add_months(ds, steps)) if freq == "M" else F.date_add(ds, steps * {"D": 1, "W": 7}[freq])


def training_rows(s: DataFrame, keys: list[str], freq: str) -> DataFrame:
    """(f0, f1, ..., label) of all series' training points that have every lag, relative to the mean of
    their series' training values; series with a mean of 0 teach nothing."""
    train = s.filter(F.col("split") == "train")
    w, whole = Window.partitionBy(*keys).orderBy("t"), Window.partitionBy(*keys)
    train = train.withColumn("_scale", F.avg("y").over(whole)).filter(F.col("_scale") != 0).withColumn("_v", F.col("y") / F.col("_scale"))
    features = [F.lag("_v", k).over(w) for k in range(1, LAGS[freq] + 1)] + calendar(F.col("ds"), freq)
    return train.select(*[c.alias(f"f{i}") for i, c in enumerate(features)], F.col("_v").alias("label")).dropna()


def fit(s: DataFrame, keys: list[str], freq: str) -> Trees | None:
    """Trees from an indexed series table (keys, ds, y, t, split); None if no series has enough points."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import GBTRegressor
    rows = training_rows(s, keys, freq)
    if rows.isEmpty():
        return None
    rows = VectorAssembler(inputCols=rows.columns[:-1], outputCol="features").transform(rows)
    model = GBTRegressor(maxDepth=DEPTH, maxIter=TREES, stepSize=RATE, seed=SEED).fit(rows)
    return of_model(model, freq)


def of_model(model, freq: str) -> Trees:
    """The nodes of a fitted Spark ML ensemble."""
    def node(n) -> Node:
        if n.getClass().getSimpleName() == "LeafNode":
            return n.prediction()
        return {"f": n.split().featureIndex(), "at": n.split().threshold(), "le": node(n.leftChild()), "gt": node(n.rightChild())}
    return Trees(freq, tuple((float(w), node(t._call_java("rootNode"))) for w, t in zip(model.treeWeights, model.trees)))


def ahead(y: Column, scale: Column, last: Column, trees: Trees, h: int) -> Column:
    """The next h values of a history `y` whose last period is `last`; each prediction feeds the next.
    Null for a history shorter than the lags or with a scale of 0."""
    lags = LAGS[trees.freq]

    def step(acc: Column, i: Column) -> Column:
        features = [F.element_at(acc, -k) for k in range(1, lags + 1)] + calendar(later(last, i, trees.freq), trees.freq)
        return F.concat(acc, F.array(trees.column(features)))

    start = F.transform(F.slice(y, -lags, lags), lambda v: v / scale)
    end = F.aggregate(F.sequence(F.lit(1), F.lit(h)), start, step)
    return F.when((F.size(y) >= lags) & (scale != 0), F.transform(F.slice(end, lags + 1, h), lambda v: v * scale))
