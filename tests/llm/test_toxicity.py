"""Toxicity: held-out accuracy, what is learned from, and the score against a plain version."""
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tessera.llm import toxicity

SF = SF_SMALL.replace("sf0.001", "sf0.1")
RUDE = ["idiot", "moron", "pathetic", "scum"]


def is_held_out(d):
    return d is None or zlib.crc32(str(d).encode()) % 5 == 0


def corpus(n=600, seed=1, cyrillic=False):
    rng = random.Random(seed)
    sound = ["ba", "ko", "ти", "да"] if cyrillic else ["ba", "ko", "ti", "da", "re", "lu"]
    docs, labels = [], []
    for i in range(n):
        ws = ["".join(rng.choices(sound, k=rng.randrange(1, 5))) for _ in range(rng.choice([5, 40, 300]))]
        toxic = i % 5 == 0
        if toxic:
            for _ in range(2):
                ws[rng.randrange(len(ws))] = rng.choice(RUDE)
        docs.append((i, " ".join(ws)))
        labels.append((i, int(toxic)))
    return docs, labels


def frames(spark, docs, labels):
    d = spark.createDataFrame([(*r, "s", 1.0) for r in docs], "doc_id long, text string, label string, score double")
    return d, spark.createDataFrame([(*r, 1) for r in labels], "doc_id long, toxic int, quality int")


def plain_features(text):
    """The distinct n-grams as strings."""
    s = f" {' '.join((text or '').lower().split())} "
    return {s[i:i + n] for n in toxicity.LENGTHS for i in range(len(s) - n + 1)}


def number(gram):
    value = 0
    for k, c in enumerate(gram):
        value = (value * 0x9E3779B1 + ord(c) + k + 1) & 0xFFFFFFFF
    return (((value ^ (value >> 15)) * 0x85EBCA6B) & 0xFFFFFFFF) >> (32 - toxicity.BITS)


@pytest.mark.parametrize("text", ["", "a", "An IDIOT  of\na Mörön 漢字 😀", "x" * 50, " \t "])
def test_features_of_a_text(text, monkeypatch):
    every = np.ones(1 << toxicity.BITS, bool)
    wanted = sorted({number(g) for g in plain_features(text)})
    assert toxicity.features(text, every).tolist() == wanted
    monkeypatch.setattr(toxicity, "PIECE", 3)  # pieces lose no n-gram and make none up
    assert toxicity.features(text, every).tolist() == wanted


def test_planted_words(spark):
    docs, labels = corpus()
    out = toxicity.classify(*frames(spark, docs, labels)).collect()
    truth = dict(labels)
    held = [r for r in out if r["held_out"]]
    assert len(out) == 600 and all(r["held_out"] == is_held_out(r["doc_id"]) for r in out)
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in out)


def test_table_held_out(spark):
    """The labels of the tables mark about a sixth of their toxic documents by chance."""
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    out = toxicity.classify(docs, labels).filter("held_out").join(labels.select("doc_id", "toxic"), "doc_id")
    got = {(r["toxic"], r["predicted"]): r["count"] for r in out.groupBy("toxic", "predicted").count().collect()}
    assert got[1, 1] >= 0.75 * (got[1, 1] + got[1, 0])
    assert got.get((0, 1), 0) <= 0.02 * got[0, 0]


def test_ratios_and_score_against_plain_version(spark):
    docs, labels = corpus(250, 2, cyrillic=True)
    d, lab = frames(spark, docs, labels)
    learned = [(t, y) for (i, t), (_, y) in zip(docs, labels) if not is_held_out(i)]
    ratios = dict(toxicity.log_count_ratios(toxicity.labelled_sample(d, lab)))
    counts = {}
    for t, y in learned:
        for f in {number(g) for g in plain_features(t)}:
            counts.setdefault(f, [0, 0])[y] += 1
    p, q = (sum(c[k] + 1 for c in counts.values()) for k in (1, 0))
    assert ratios and all(abs(r - (math.log((counts[f][1] + 1) / p) - math.log((counts[f][0] + 1) / q))) < 1e-9 for f, r in ratios.items())
    model = toxicity.learn(d, lab)
    assert {f for f in np.flatnonzero(model.table)} <= set(ratios)
    for r in toxicity.scored(d, model).select("doc_id", "text", "score").collect():
        z = model.intercept + sum(model.table[f] for f in {number(g) for g in plain_features(r["text"])})
        assert abs(r["score"] - 1 / (1 + math.exp(-z))) < 1e-9


def test_learns_nothing_from_the_held_out_fold_or_odd_labels(spark):
    docs, labels = corpus(300, 3)
    d, lab = frames(spark, docs, labels)
    turned = [(i, 1 - y if is_held_out(i) else y) for i, y in labels]
    turned += [(None, 1), (5000, 1), (1, None)]
    base, other = toxicity.learn(d, lab), toxicity.learn(*frames(spark, docs, turned))
    assert base.intercept == other.intercept and (base.table == other.table).all()
    first = next(i for i, y in labels if y == 1 and not is_held_out(i))
    sample = toxicity.labelled_sample(*frames(spark, docs, labels + [(first, 0)]))  # contradicts itself
    assert sample.count() == sum(not is_held_out(i) for i, _ in labels) - 1


def test_repeated_ids_count_once(spark):
    docs, labels = corpus(200, 4)
    d, lab = frames(spark, docs + [docs[6]] * 400, labels + [labels[6]] * 5)
    assert toxicity.labelled_sample(d, lab).count() == sum(not is_held_out(i) for i, _ in labels)
    assert toxicity.labelled_sample(d, lab, size=7).count() == 14


def test_odd_rows(spark):
    docs, labels = corpus(300, 5)
    odd = [(None, "an idiot"), (900, None), (901, ""), (902, "idiot scum moron pathetic " * 30_000), (903, "idiot"), (903, "idiot")]
    out = toxicity.classify(*frames(spark, docs + odd, labels)).collect()
    assert len(out) == 306
    by = {r["doc_id"]: r for r in out}
    assert by[None]["held_out"] and by[900]["score"] == by[901]["score"] and by[900]["predicted"] == 0 and by[902]["predicted"] == 1


@pytest.mark.parametrize("labels, predicted", [([], 0), ([(i, 0) for i in range(50)], 0), ([(i, 1) for i in range(50)], 1),
                                               ([(i, i % 2) for i in range(4)], None)])
def test_few_labels(spark, labels, predicted):
    docs, _ = corpus(50, 6)
    got = {r["predicted"] for r in toxicity.classify(*frames(spark, docs, labels)).collect()}
    assert predicted is None or got == {predicted}


def test_empty_documents(spark):
    d, lab = frames(spark, [], [(1, 1)])
    assert toxicity.classify(d, lab).count() == 0
