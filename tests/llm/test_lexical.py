"""Ranked lexical search against a plain scan of all documents, and odd rows."""
import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tessera.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return TERM.findall((text or "").translate(LOW))


def brute(docs, items, top=10):
    bags = [(d, Counter(words(t))) for d, t in docs]
    bags = [(d, c, sum(c.values())) for d, c in bags if c]
    total, n_docs = sum(n for _, _, n in bags), len(bags)
    df = Counter(w for _, c, _ in bags for w in c)
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(words(t))
    out = []
    for i, ts in asked.items():
        scored = []
        for d, c, n in bags:
            m = 10 + 90 * n * n_docs // total
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * (10 ** 9 * c[w] // (1000 * c[w] + 8 * m))
                    for w in ts if w in c)
            if s > 0:
                scored.append((-s, d is None, d if d is not None else 0, d))
        out += [(i, k + 1, r[3], -r[0]) for k, r in enumerate(sorted(scored, key=lambda r: r[:3])[:top])]
    return sorted(out, key=str)


def got(spark, docs, items, **more):
    d = spark.createDataFrame([(*r, "x", 0.5) for r in docs], "doc_id long, text string, rank string, score double")
    b = spark.createDataFrame([(*r, "x") for r in items], "item_id long, text string, term string")
    return sorted((tuple(r) for r in lexical.rank_documents(d, b).collect()), key=str)


def corpus(n=400):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(300)]
    weights = [1 / (i + 1) for i in range(300)]
    docs = [(i, " ".join(rng.choices(vocabulary, weights, k=rng.choice([3, 20, 60, 400])))) for i in range(n)]
    docs += [(1000 + i, docs[7][1]) for i in range(40)]                    # a group of copies: ties by id
    items = [(i, " ".join(rng.choices(vocabulary, weights, k=rng.choice([1, 5, 30])))) for i in range(25)]
    items += [(100 + i, docs[50 + i][1]) for i in range(5)] + [(200, docs[7][1])]
    return docs, items


def test_equals_a_plain_scan(spark):
    docs, items = corpus()
    assert got(spark, docs, items) == brute(docs, items)


def test_several_blocks_and_small_buckets(spark, monkeypatch):
    docs, items = corpus(150)
    monkeypatch.setattr(lexical, "BLOCK_PAIRS", 120)
    monkeypatch.setattr(lexical, "PART_ENTRIES", 300)
    assert len(list(lexical.item_blocks(spark.createDataFrame(items, "item_id long, text string")))) > 2
    assert got(spark, docs, items) == brute(docs, items)


def test_odd_rows(spark):
    docs = [(1, "Äpfel ÄPFEL apfel"), (2, None), (3, ""), (4, " .,;"), (None, "apfel kuchen"), (None, "apfel kuchen"),
            (5, "APFEL"), (5, "APFEL"), (6, "kuchen " * 5000), (7, "naïve\x00apfel_kuchen"), (8, "漢字 apfel")]
    items = [(1, "Apfel kuchen"), (1, "漢字"), (2, None), (3, "!!"), (None, "ÄPFEL apfel"), (4, "unknown"), (5, "kuchen kuchen kuchen")]
    assert got(spark, docs, items) == brute(docs, items)


def test_empty_tables(spark):
    docs, items = [(1, "a b")], [(1, "a")]
    assert got(spark, [], items) == got(spark, docs, []) == got(spark, [(1, None)], items) == []
    assert lexical.rank_documents(spark.createDataFrame([], "doc_id string, text string"),
                                  spark.createDataFrame([], "item_id string, text string")).dtypes == [
        ("item_id", "string"), ("rank", "int"), ("doc_id", "string"), ("score", "bigint")]


def test_pieces_do_not_cut_terms(monkeypatch):
    rng = random.Random(1)
    text = "".join(rng.choice("ab Ä.Z9\n") for _ in range(5000)) + "q" * 700
    whole = [w.encode() for w in words(text)]
    for piece in (1, 7, 64, 1000):
        monkeypatch.setattr(lexical, "PIECE", piece)
        assert [w for p in lexical.terms(text.encode()) for w in p] == whole


def test_bounds_skip_work_but_no_result():
    """With thresholds of a first pass most (bucket, item) pairs and vectors are never scored."""
    rng = np.random.default_rng(2)
    n, t = 3000, 200
    rows = [np.unique(rng.integers(0, t, rng.integers(1, 12))) for _ in range(n)]
    impacts = [rng.integers(1, 1000, len(r)) for r in rows]
    length = np.array([math.sqrt((x.astype(float) ** 2).sum()) for x in impacts])
    order = np.argsort(-length)
    part = pa.RecordBatch.from_arrays(
        [pa.array(order.tolist()), pa.array(length[order]), pa.array([rows[i].tolist() for i in order], pa.list_(pa.int32())),
         pa.array([impacts[i].tolist() for i in order], pa.list_(pa.int32()))], names=["doc_id", "length", "ids", "impacts"])
    lists = [np.unique(rng.integers(0, t, 6)) for _ in range(20)]
    items = lexical.Items(tuple(range(20)), {}, np.cumsum([0] + [len(x) for x in lists]), np.concatenate(lists))
    weights = rng.integers(1, 9000, t)
    weighed = items.pairs(weights)
    exact = [sorted(((-int(sum(weights[c] * x for c, x in zip(rows[d], impacts[d]) if c in set(q))), d) for d in range(n)))[:10] for q in lists]
    seen = []
    true = lexical.Bucket.survivors
    try:
        lexical.Bucket.survivors = lambda self, *a: (seen.append(true(self, *a)[0]), true(self, *a))[1]
        lexical.BUCKET_ROWS, before = 100, lexical.BUCKET_ROWS
        found = lexical.search_task(iter([part]), weighed, np.zeros(20, np.int64), t)
    finally:
        lexical.Bucket.survivors, lexical.BUCKET_ROWS = true, before
    assert [[(-s, d) for s, d in found[i].rows] for i in range(20)] == exact
    assert sum(map(len, seen)) < 0.1 * n * 20


@pytest.mark.parametrize("least", [0, 10 ** 6, 10 ** 12])
def test_survivors_hold_all_that_reach_the_threshold(least):
    rng = np.random.default_rng(3)
    rows = [np.unique(rng.integers(0, 40, 8)) for _ in range(500)]
    impacts = [rng.integers(1, 10 ** 6, len(r)) for r in rows]
    ends = np.cumsum([0] + [len(r) for r in rows])
    bucket = lexical.Bucket(np.array([math.sqrt((x.astype(float) ** 2).sum()) for x in impacts]), ends, np.concatenate(rows),
                            np.concatenate(impacts), 40)
    terms, weights = np.arange(0, 40, 3), rng.integers(0, 20000, 14)
    exact = np.array([sum(int(weights[list(terms).index(c)]) * int(x) for c, x in zip(r, xs) if c in terms) for r, xs in zip(rows, impacts)])
    got_rows, scores = bucket.survivors(terms, weights, least)
    wanted = np.flatnonzero((exact >= least) & (exact > 0))
    assert got_rows.tolist() == wanted.tolist() and scores.tolist() == exact[wanted].tolist()
