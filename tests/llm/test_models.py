"""Learned operators: language identification and quality classification."""
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tessera.llm import langid, quality_model
from tessera.llm.measures import NAMES, measure

SF = SF_SMALL.replace("sf0.001", "sf0.01")


def test_fold_is_crc32_modulo_4(spark, frame):
    from tessera.llm.common import held_out
    rows = frame([(i, "x") for i in range(200)] + [(None, "x")]).select("doc_id", held_out().alias("h")).collect()
    for r in rows:
        assert r["h"] == (True if r["doc_id"] is None else zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)


# --- language ------------------------------------------------------------------------------------

def brute_grams(text, alphabet):
    s = langid.codes(text, alphabet).tolist()
    return {tuple(s[i:i + n]) for n in (1, 2, 3) for i in range(len(s) - n + 1)}


@pytest.mark.parametrize("text", ["Hello, World! hello", "a", "é1è ßx", "日本 x", "... a ...b"])
def test_ngrams_are_the_distinct_grams(text):
    table = langid.letter_table([ord(c) for c in "helowrd"])
    seen = np.zeros(langid._SPACE, bool)
    assert len(langid.ngrams(text, table, seen)) == len(brute_grams(text, table))
    assert not seen.any()


def test_scores_equal_the_kernel_formula():
    """The folded matrix gives what kernel ridge regression on Nyström features gives."""
    rng = np.random.default_rng(3)
    words = {"aa": ["the", "and", "this", "that", "with"], "bb": ["der", "und", "nicht", "ein", "mit"]}
    texts = [(lang, " ".join(rng.choice(words[lang], 12))) for lang in ("aa", "bb") for _ in range(15)]
    table = langid.letter_table([ord(c) for c in "abcdefghijklmnopqrstuvwxyz"])
    seen = np.zeros(langid._SPACE, bool)
    grams = [langid.ngrams(t, table, seen) for _, t in texts]
    langs = [lang for lang, _ in texts]
    model = langid.fit(grams, langs, table, landmarks=4, ridge=0.5)
    k = lambda a, b: len(set(a) & set(b)) / np.sqrt(len(a) * len(b))
    marks = [grams[i] for i in (0, 1, 2, 3, 15, 16, 17, 18)]
    kmm = np.array([[k(a, b) for b in marks] for a in marks])
    knm = np.array([[k(a, b) for b in marks] for a in grams])
    value, vector = np.linalg.eigh(kmm)
    good = value > 1e-8 * value.max()
    root = vector[:, good] / np.sqrt(value[good])
    x = knm @ root
    y = np.array([[1.0 if lang == c else -1.0 for c in ("aa", "bb")] for lang in langs])
    w = np.linalg.solve(x.T @ x + 0.5 * np.eye(x.shape[1]), x.T @ y)
    assert np.allclose(model.score([t for _, t in texts]), x @ w)


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = langid.identify_languages(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").agg(
        F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.min("score"), F.max("score")).first()
    assert out[0] > 0.98 and out[1] >= 0 and out[2] <= 1


def test_language_odd_rows(spark, frame):
    en = "the quick brown fox jumps over the lazy dog and then that was it with this "
    de = "der schnelle braune Fuchs springt nicht über den faulen Hund und dann war es das "
    rows = [(i, en * 2 + f"number {i}", "en") for i in range(12)] + [(i, de * 2 + f"zahl {i}", "de") for i in range(12, 24)]
    odd = [(100, None, "en"), (101, "", "de"), (102, "123 ... 456", None), (None, en, None), (103, "x", None),
           (104, de * 3000, None), (0, rows[0][1], "en"), (0, rows[0][1], "en")]
    df = frame(rows + odd, extra=True)
    out = langid.identify(df, langid.learn(df)).collect()
    assert len(out) == len(rows) + len(odd)
    got = {(r["doc_id"], r["text"]): r for r in out}
    assert [got[k]["lang_pred"] for k in ((100, None), (101, ""), (102, "123 ... 456"))] == ["und"] * 3
    assert got[(None, en)]["lang_pred"] == "en" and got[(104, de * 3000)]["lang_pred"] == "de"
    assert langid.identify_languages(frame([])).count() == 0
    unlabelled = langid.identify_languages(frame([(1, "abc", None)])).first()
    assert (unlabelled["lang_pred"], unlabelled["score"]) == ("und", 0.0)


# --- quality -------------------------------------------------------------------------------------

def test_best_split_equals_trying_all_cuts():
    rng = np.random.default_rng(1)
    for _ in range(20):
        x, y = rng.integers(0, 12, 60).astype(float), rng.integers(0, 2, 60).astype(float)
        gini = lambda v: len(v) * v.mean() * (1 - v.mean())
        cuts = [c for c in np.unique(x)[:-1] if min((x <= c).sum(), (x > c).sum()) >= quality_model.LEAF]
        impurity, cut = quality_model.best_split(x, y)
        assert abs(impurity - min(gini(y[x <= c]) + gini(y[x > c]) for c in cuts)) < 1e-9
        assert abs(impurity - gini(y[x <= cut]) - gini(y[x > cut])) < 1e-9


def test_tree_paths_are_conjunctions_from_the_root():
    rng = np.random.default_rng(0)
    x = rng.random((400, 2))
    y = ((x[:, 0] > 0.5) & (x[:, 1] <= 0.3)).astype(float)
    paths = quality_model.tree_paths(x, y, ["p", "q"], 3, rng)
    assert paths and all(1 <= len(p) <= 3 for p in paths)
    assert all(p[:-1] == () or p[:-1] in paths for p in paths)


def test_lasso_meets_its_optimality_conditions():
    rng = np.random.default_rng(2)
    x = (rng.random((300, 8)) < 0.4).astype(float)
    y = (rng.random(300) < 1 / (1 + np.exp(-(2 * x[:, 0] - 1.5 * x[:, 1])))).astype(float)
    b, w = quality_model.lasso_logistic(x, y, 0.02, 5000)
    slope = x.T @ (1 / (1 + np.exp(-(b + x @ w))) - y) / 300
    assert abs((1 / (1 + np.exp(-(b + x @ w))) - y).mean()) < 1e-6
    assert all(abs(s + 0.02 * np.sign(v)) < 1e-5 if v else abs(s) <= 0.02 + 1e-6 for s, v in zip(slope, w))
    assert (w == 0).any() and w[0] > 0 > w[1]


def test_quality_held_out_accuracy_and_compiled_scores(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    model = quality_model.learn(docs, labels)
    assert 0 < len(model.rules) < 200
    assert model == quality_model.learn(docs, labels)  # the same rules on every run
    out = quality_model.scored(docs.select("doc_id", "text"), model)
    known = out.join(labels, "doc_id").withColumn("p", (F.col("score") >= 0.7).cast("int"))
    held = known.filter(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2)
    assert held.agg(F.avg((F.col("p") == F.col("quality")).cast("int"))).first()[0] > 0.97
    for r in out.limit(60).collect():  # the column expression against the rules applied one by one
        m = dict(zip(NAMES, measure(r["text"].encode())))
        assert abs(model.score_row(stats(m)) - r["score"]) < 1e-9


def stats(m):
    n, chars, lines = max(m["n_words"], 1), max(m["word_chars"], 1), max(m["n_lines"], 1)
    return {"words": np.log1p(m["n_words"]), "word_length": m["word_chars"] / n, "symbols": m["n_symbols"] / n,
            "exclamations": m["n_exclaim"] / n, "punctuation": m["n_punct"] / n, "upper": m["n_upper"] / chars,
            "digits": m["n_digits"] / chars, "duplicate_lines": m["n_dup_lines"] / lines, "words_a_line": m["n_words"] / lines,
            "repeated_windows": m["n_repeat_words"] / n, "distinct_words": m["n_distinct_words"] / n,
            "run": m["longest_run"] / n, "longest_word": np.log1p(m["longest_word"])}


def test_quality_odd_rows(spark, frame):
    docs = frame([(1, None), (2, ""), (None, "x y"), (3, "w " * 30000), (3, "w " * 30000)], extra=True)
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, None), (None, 1)], "doc_id long, quality int")
    out = quality_model.classify(docs, labels).collect()
    assert len(out) == 5 and all(r["score"] == 0.5 and r["predicted"] == 0 for r in out)  # nothing to learn from
    assert quality_model.classify(frame([]), labels).count() == 0
    one = spark.createDataFrame([(3, 1)], "doc_id long, quality int")
    assert all(r["predicted"] == 1 for r in quality_model.classify(docs, one).collect())
    kept = quality_model.scored(docs, quality_model.RuleModel(0.0, ()), "other")
    assert kept.columns == docs.columns + ["other"]
