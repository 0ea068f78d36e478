"""Quality classifier: a sparse rule ensemble.

Shallow trees are grown on a bounded labelled sample, every root-to-node path becomes a rule (a
conjunction of thresholds over text statistics), an L1-penalised logistic regression picks a few
rules and their weights, and the model is compiled into one Spark column expression.  Scoring is
therefore a projection: no join, no shuffle, whatever the number of documents.  The statistics of
the sample are computed by Spark; its fit (a few thousand short rows, a fixed bound) takes a
second of numpy on the driver.
"""
from __future__ import annotations

import math
import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import free_name, held_out, stored
from tessera.llm.measures import measures

SAMPLE = 6000        # labelled documents learned from at most (those with the smallest hashes)
TREES, DEPTH, LEAF = 12, 3, 5  # trees, their depth, rows in a leaf at least
STEPS = 400          # of the descent for the L1 penalty
PENALTY = 0.001
THRESHOLD = 0.7

#: Statistics of a text, as SQL over the measurements `m` (all defined for an empty text).
STATISTICS = {
    "words": "ln(1D + m.n_words)",
    "word_length": "m.word_chars / greatest(m.n_words, 1)",
    "symbols": "m.n_symbols / greatest(m.n_words, 1)",
    "exclamations": "m.n_exclaim / greatest(m.n_words, 1)",
    "punctuation": "m.n_punct / greatest(m.n_words, 1)",
    "upper": "m.n_upper / greatest(m.word_chars, 1)",
    "digits": "m.n_digits / greatest(m.word_chars, 1)",
    "duplicate_lines": "m.n_dup_lines / greatest(m.n_lines, 1)",
    "words_a_line": "m.n_words / greatest(m.n_lines, 1)",
    "repeated_windows": "m.n_repeat_words / greatest(m.n_words, 1)",
    "distinct_words": "m.n_distinct_words / greatest(m.n_words, 1)",
    "run": "m.longest_run / greatest(m.n_words, 1)",
    "longest_word": "ln(1D + m.longest_word)",
}


@dataclass(frozen=True)
class Rule:
    conditions: tuple[tuple[str, str, float], ...]  # (statistic, "<=" or ">", threshold), all must hold
    weight: float = 0.0

    def column(self, stats: str) -> Column:
        out = F.lit(True)
        for name, op, x in self.conditions:
            c = F.col(f"{stats}.{name}")
            out = out & ((c <= x) if op == "<=" else (c > x))
        return out

    def holds(self, stats: dict[str, float]) -> bool:
        return all(stats[n] <= x if op == "<=" else stats[n] > x for n, op, x in self.conditions)


@dataclass(frozen=True)
class RuleModel:
    intercept: float
    rules: tuple[Rule, ...]

    def score(self, stats: str) -> Column:
        """The model compiled into a Spark column over a struct of statistics."""
        z = F.lit(self.intercept)
        for r in self.rules:
            z = z + F.when(r.column(stats), F.lit(r.weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))

    def score_row(self, stats: dict[str, float]) -> float:
        return 1 / (1 + math.exp(-(self.intercept + sum(r.weight for r in self.rules if r.holds(stats)))))


def statistics(measured: str) -> Column:
    """Struct of the statistics, from the column that holds the measurements."""
    return F.struct(*[F.expr(re.sub(r"\bm\.", f"{measured}.", sql)).cast("double").alias(name)
                      for name, sql in STATISTICS.items()])


Path = tuple[tuple[str, str, float], ...]


def best_split(x: np.ndarray, y: np.ndarray) -> tuple[float, float] | None:
    """(impurity, threshold) of the best cut of one statistic: the least weighted Gini impurity with
    LEAF rows on either side; None if there is no cut."""
    order = np.argsort(x, kind="stable")
    xs, ones = x[order], np.cumsum(y[order])
    left = np.arange(1, len(xs))
    n, good = len(xs), (xs[:-1] < xs[1:]) & (left >= LEAF) & (len(xs) - left >= LEAF)
    if not good.any():
        return None
    a, b = ones[:-1], ones[-1] - ones[:-1]
    impurity = np.where(good, a * (left - a) / left + b * (n - left - b) / (n - left), np.inf)
    i = int(impurity.argmin())
    middle = (xs[i] + xs[i + 1]) / 2
    return float(impurity[i]), float(middle if middle < xs[i + 1] else xs[i])


def tree_paths(x: np.ndarray, y: np.ndarray, names: list[str], depth: int, rng: np.random.Generator,
               way: Path = ()) -> list[Path]:
    """Conditions on the way to every node below the root of one greedy tree, each split chosen among
    half of the statistics."""
    if depth == 0 or y.min(initial=1) == y.max(initial=0):
        return []
    tried = [(s, int(f)) for f in rng.permutation(len(names))[:(len(names) + 1) // 2] if (s := best_split(x[:, f], y))]
    if not tried:
        return []
    (_, cut), f = min(tried)
    out = []
    for op, part in (("<=", x[:, f] <= cut), (">", x[:, f] > cut)):
        here = way + ((names[f], op, cut),)
        out += [here, *tree_paths(x[part], y[part], names, depth - 1, rng, here)]
    return out


def lasso_logistic(x: np.ndarray, y: np.ndarray, penalty: float, steps: int = STEPS) -> tuple[float, np.ndarray]:
    """(intercept, weights) of logistic regression with an L1 penalty on the weights, by accelerated
    proximal gradient steps."""
    n = len(y)
    a = np.column_stack([np.ones(n), x])
    rate = 4 * n / np.linalg.norm(a, 2) ** 2
    w = ahead = np.zeros(a.shape[1])
    t = 1.0
    for _ in range(steps):
        step = ahead - rate * (a.T @ (1 / (1 + np.exp(-np.clip(a @ ahead, -35, 35))) - y)) / n
        new = np.sign(step) * np.maximum(np.abs(step) - rate * penalty, 0)
        new[0] = step[0]
        t_new = (1 + math.sqrt(1 + 4 * t * t)) / 2
        ahead, w, t = new + (t - 1) / t_new * (new - w), new, t_new
    return float(w[0]), w[1:]


def labelled_sample(docs: DataFrame, labels: DataFrame, size: int = SAMPLE) -> DataFrame:
    """(label, s): statistics of at most `size` labelled documents outside the held-out fold.

    Labels that are null or contradict each other are left out; the sample is the same on every
    run.  It has a fixed bound, so it is broadcast to the documents."""
    one = labels.filter(F.col("quality").isin(0, 1) & ~held_out()).groupBy("doc_id").agg(
        F.min("quality").alias("lo"), F.max("quality").alias("hi"))
    chosen = (one.filter("lo = hi").select(F.col("doc_id").alias("__id"), F.col("lo").cast("double").alias("label"))
              .orderBy(F.md5(F.col("__id").cast("string")), "__id").limit(size))
    texts = docs.select(F.col("doc_id").alias("__doc"), "text")
    got = texts.join(F.broadcast(chosen), F.col("__doc") == F.col("__id")).select("__id", "label",
                                                                               measures().alias("m"))
    rows = got.select("__id", "label", statistics("m").alias("s"))
    # one row for each id however often it is repeated: the sample stays bounded, and the same
    return stored(rows.groupBy("__id", "label").agg(F.min("s").alias("s")), "quality-sample")


def fit(sample: DataFrame, trees: int = TREES, depth: int = DEPTH, penalty: float = PENALTY) -> RuleModel:
    """Rule ensemble from (label, s).  Without labels every score is 0.5, with one class alone it
    is that class.  The same sample gives the same model on every run."""
    names = list(STATISTICS)
    rows = sorted(tuple(r) for r in sample.select("__id", "label", *[F.col(f"s.{n}") for n in names]).collect())
    if not rows:
        return RuleModel(0.0, ())
    y, x = np.array([r[1] for r in rows]), np.array([r[2:] for r in rows])
    if y.min() == y.max():
        return RuleModel(4.0 if y[0] else -4.0, ())
    rng, paths = np.random.default_rng(7), set()
    for _ in range(trees):
        drawn = rng.integers(0, len(y), len(y))
        paths |= set(tree_paths(x[drawn], y[drawn], names, depth, rng))
    if not paths:
        return RuleModel(math.log(y.sum() / (1 - y).sum()), ())
    paths = sorted(paths, key=lambda p: (len(p), p))
    column = {n: x[:, k] for k, n in enumerate(names)}
    fires = np.column_stack([np.all([column[n] <= c if op == "<=" else column[n] > c for n, op, c in p], axis=0)
                             for p in paths]).astype(float)
    intercept, weights = lasso_logistic(fires, y, penalty)
    return RuleModel(intercept, tuple(Rule(p, float(w)) for p, w in zip(paths, weights) if w))


def learn(docs: DataFrame, labels: DataFrame) -> RuleModel:
    return fit(labelled_sample(docs, labels))


def scored(docs: DataFrame, model: RuleModel, score: str = "score") -> DataFrame:
    """`docs` with a score column (replaced if there).  Row by row: null ids, repeated rows and
    extra columns stay; a null text scores like an empty one."""
    own = free_name(docs, "__measured")
    m = docs.withColumn(own, measures())
    s = m.withColumn(own, statistics(own))
    return s.withColumn(score, model.score(own)).drop(own)


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Learn from the labelled documents of three folds, score all: doc_id, held_out, score (0 to
    1), predicted (1 from THRESHOLD on)."""
    out = scored(docs.select("doc_id", "text"), learn(docs, labels))
    return out.select("doc_id", held_out().alias("held_out"), "score",
                      (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
