"""Toxicity: a linear classifier over character n-grams whose features are scaled by naive Bayes
log-count ratios.

A text's features are the n-grams of code points it holds (present or not), hashed into a fixed
table.  On a bounded labelled sample Spark counts in how many texts of either class a feature
stands; the log ratio of the smoothed counts scales the feature, and a logistic regression of
Spark ML weighs the scaled features.  Ratio times weight is one number a feature, so scoring is
one Arrow pass: the sum of the numbers of a text's distinct features.
"""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import free_name, stored

LENGTHS = (3, 4, 5)       # of the n-grams, in code points
BITS = 20                 # of a feature's number: the table has 2**20 entries
SAMPLE = 4000             # labelled documents of either class learned from at most (smallest hashes)
FEATURES = 1 << 14        # weighed at most: those that tell the classes apart best
LEAST = 3                 # texts of the sample that hold a weighed feature, at least
SMOOTH = 1.0              # added to each count
PENALTY = 0.001           # L2, on the weights of the scaled features
THRESHOLD = 0.5
PIECE = 1 << 20           # code points hashed at a time, whatever the length of the text


def held_out(col: str = "doc_id") -> Column:
    """True in the fold that is never learned from; a null id is never learned from either."""
    return F.coalesce(F.crc32(F.col(col).cast("string").cast("binary")) % 5 == 0, F.lit(True))


def numbers(text: str) -> Iterator[np.ndarray]:
    """Numbers of the n-grams of a text (with repeats): lower case, runs of white space as one blank, a
    blank at both ends."""
    codes = np.frombuffer(f" {' '.join(text.lower().split())} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    for start in range(0, len(codes), PIECE):
        piece = codes[start:start + PIECE + LENGTHS[-1] - 1]
        value = np.zeros(len(piece) + 1, np.uint32)
        for n in range(1, min(LENGTHS[-1], len(piece)) + 1):
            value = value[:len(piece) - n + 1] * np.uint32(0x9E3779B1) + piece[n - 1:] + np.uint32(n)
            if n in LENGTHS:
                yield ((value ^ (value >> np.uint32(15))) * np.uint32(0x85EBCA6B)) >> np.uint32(32 - BITS)


def features(text: str, wanted: np.ndarray) -> np.ndarray:
    """The distinct features of a text among the wanted ones (a mask of 2**BITS)."""
    return np.unique(np.concatenate([np.zeros(0, np.uint32), *[x[wanted[x]] for x in numbers(text)]]))


def class_counts(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(f, p, q) from (label, text): in how many toxic and clean texts of one task a feature stands."""
    counts = np.zeros((2, 1 << BITS), np.int64)
    for part in parts:
        for label, text in zip(part.column(0).to_pylist(), part.column(1)):
            held = np.concatenate([np.zeros(0, np.uint32), *numbers(text.as_py())])
            counts[int(label), held] += 1  # once for each text, however often the index is repeated
    held = np.flatnonzero(counts.any(axis=0))
    for k in range(0, len(held), 1 << 16):
        f = held[k:k + (1 << 16)]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (f, counts[1, f], counts[0, f])], names=["f", "p", "q"])


def labelled_sample(docs: DataFrame, labels: DataFrame, size: int = SAMPLE) -> DataFrame:
    """(label, text): at most `size` labelled documents of either class outside the held-out fold.

    Labels that are null or contradict each other are left out.  An id that is repeated counts once,
    with its least text.  The chosen ids have a fixed bound, so they are broadcast."""
    one = labels.filter(F.col("toxic").isin(0, 1) & ~held_out()).groupBy("doc_id").agg(
        F.min("toxic").alias("lo"), F.max("toxic").alias("hi")).filter("lo = hi")
    some = [one.filter(F.col("lo") == c).orderBy(F.md5(F.col("doc_id").cast("string")), "doc_id").limit(size) for c in (0, 1)]
    chosen = some[0].union(some[1]).select(F.col("doc_id").alias("__id"), F.col("lo").cast("double").alias("label"))
    texts = docs.select(F.col("doc_id").alias("__doc"), "text")
    got = texts.join(F.broadcast(chosen), F.col("__doc") == F.col("__id")).groupBy("__id", "label").agg(
        F.min("text").alias("text"))
    return stored(got.select("label", F.coalesce("text", F.lit("")).alias("text")), "toxicity-sample")


@dataclass(frozen=True)
class ToxicityModel:
    intercept: float
    table: np.ndarray     # 2**BITS numbers, 0 for features that are not weighed

    def margin(self, text: str) -> float:
        return self.intercept + float(self.table[features(text, self.table != 0)].sum())


def log_count_ratios(sample: DataFrame, size: int = FEATURES) -> list[tuple[int, float]]:
    """(feature, ratio) of the features whose counts in the two classes differ by more than chance would
    make one of all counted features differ (log-likelihood ratio above 2 ln of their number), the
    `size` furthest apart at most.  ratio = ln of (count + SMOOTH) / sum of these, toxic over clean."""
    counts = stored(sample.mapInArrow(class_counts, "f long, p long, q long").groupBy("f").agg(
        F.sum("p").alias("p"), F.sum("q").alias("q")), "toxicity-counts")
    n = sample.agg(F.sum("label").alias("p"), F.sum(1 - F.col("label")).alias("q")).first()
    total = counts.agg(F.sum(F.col("p") + SMOOTH).alias("p"), F.sum(F.col("q") + SMOOTH).alias("q"),
                       F.count_if(F.col("p") + F.col("q") >= LEAST).alias("n")).first()
    part = {c: n[c] / (n["p"] + n["q"]) for c in "pq"}
    gain = lambda c: F.when(F.col(c) > 0, F.col(c) * F.log(F.col(c) / (part[c] * (F.col("p") + F.col("q"))))).otherwise(0.0)
    apart = 2 * (gain("p") + gain("q"))
    ratio = F.log((F.col("p") + SMOOTH) / total["p"]) - F.log((F.col("q") + SMOOTH) / total["q"])
    good = counts.withColumn("apart", apart).filter((F.col("p") + F.col("q") >= LEAST) & (
        F.col("apart") >= 2 * float(np.log(max(total["n"], 1)))))
    return [(r["f"], r["r"]) for r in good.orderBy(F.desc("apart"), "f").limit(size).select("f", ratio.alias("r")).collect()]


def fit(sample: DataFrame, penalty: float = PENALTY) -> ToxicityModel:
    """Without labels every document scores as clean, with one class alone as that class; if no feature
    tells the classes apart, every score is the share of toxic documents."""
    table = np.zeros(1 << BITS)
    shares = sample.agg(F.count(F.lit(1)).alias("n"), F.avg("label").alias("p")).first()
    if not shares["n"] or shares["p"] in (0, 1):
        return ToxicityModel(4.0 if shares["p"] == 1 else -4.0, table)
    ratios = log_count_ratios(sample)
    if not ratios:
        return ToxicityModel(float(np.log(shares["p"] / (1 - shares["p"]))), table)
    ids, r = np.array([f for f, _ in ratios]), np.array([x for _, x in ratios])
    weighed = np.zeros(1 << BITS, bool)
    weighed[ids] = True

    def words(texts: pa.Array) -> pa.Array:
        return pa.array([[str(x) for x in features(t.as_py(), weighed)] for t in texts], pa.list_(pa.string()))

    present = CountVectorizerModel.from_vocabulary([str(f) for f in ids], "words", "present").setBinary(True)
    scaled = ElementwiseProduct(scalingVec=Vectors.dense(r), inputCol="present", outputCol="scaled")
    rows = sample.select("label", F.arrow_udf(words, "array<string>")("text").alias("words"))
    rows = stored(scaled.transform(present.transform(rows)).select("label", "scaled"), "toxicity-rows")
    lr = LogisticRegression(featuresCol="scaled", regParam=penalty, standardization=False, maxIter=100, tol=1e-5)
    model = lr.fit(rows)
    table[ids] = np.round(model.coefficients.toArray() * r, 6)
    return ToxicityModel(round(model.intercept, 6), table)


def learn(docs: DataFrame, labels: DataFrame) -> ToxicityModel:
    return fit(labelled_sample(docs, labels))


def scored(docs: DataFrame, model: ToxicityModel, score: str = "score") -> DataFrame:
    """`docs` with a score column (replaced if there), 0 to 1.  Row by row over whole texts: null ids,
    repeated rows and extra columns stay; a null text scores like an empty one.  The table that is
    broadcast has a fixed size (8 MB)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def margins(texts: pa.Array) -> pa.Array:
        own = shared.value
        wanted = own.table != 0
        sums = (own.table[features(t.as_py() or "", wanted)].sum() for t in texts)
        return pa.array([own.intercept + float(x) for x in sums], pa.float64())

    z = free_name(docs, "__margin")
    return docs.withColumn(z, F.arrow_udf(margins, "double")("text")).withColumn(
        score, F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col(z)))).drop(z)


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Learn from the labelled documents of four folds, score all: doc_id, held_out, score, predicted
    (1 from THRESHOLD on).  An empty table gives no row."""
    out = scored(docs.select("doc_id", "text"), learn(docs, labels))
    return out.select("doc_id", held_out().alias("held_out"), "score",
                      (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
