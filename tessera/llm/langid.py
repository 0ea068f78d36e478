"""Language identification with a string kernel.

The kernel of two texts is the normalised number of character n-grams (1 to 3 letters, blended)
that both contain.  A Nyström map through landmark texts turns kernel ridge regression, one
language against the rest, into a linear problem as large as the number of landmarks.  Since the
kernel is linear in n-gram presence, landmarks and weights fold into one matrix (n-grams x
languages), and a batch of texts is scored by one sparse-times-dense product.  Every letter of
every script is told apart; the n-grams of the landmarks are the vocabulary.
"""
from __future__ import annotations

import functools
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import free_name, held_out, stored

SAMPLE = 300       # documents learned from for each language at most (those with the smallest hashes)
LANDMARKS = 40     # landmark texts for each language, out of the sample
RIDGE = 1.0
_OTHER = 1         # letters that an alphabet of the caller's does not have
_POINTS, _BITS = 0x110000, 21
_SPACE = 1 << 18   # size of the scratch array that callers may hand to ngrams
_BLOCK = 32        # texts in one matrix product


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def codes(text: str, alphabet: np.ndarray) -> np.ndarray:
    """Letters by the alphabet; runs of anything else as one 0, also at both ends."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
    out = np.zeros(len(points) + 2, np.int64)
    out[1:-1] = alphabet[points]
    keep = np.ones(len(out), bool)
    keep[1:] = (out[1:] != 0) | (out[:-1] != 0)
    return out[keep]


def letter_table(letters: list[int] | None = None) -> np.ndarray:
    """Look-up from all code points to letter codes: every letter by its own code point, or with
    `letters` only those, all others as one."""
    alpha = np.fromiter((chr(i).isalpha() for i in range(_POINTS)), bool, _POINTS)
    points = np.arange(_POINTS, dtype=np.int32)
    if letters is None:
        return np.where(alpha, points, 0).astype(np.int32)
    return np.where(np.isin(points, letters), points, np.where(alpha, _OTHER, 0)).astype(np.int32)


@functools.cache
def every_letter() -> np.ndarray:
    return letter_table()


def ngrams(text: str, alphabet: np.ndarray, seen: np.ndarray | None = None) -> np.ndarray:
    """Sorted numbers (letter codes of 21 bits, side by side) of the distinct 1-, 2- and 3-grams of a
    whole text.  `seen` is not needed any more and stays as it is."""
    s = codes(text, alphabet) + 1  # so that a 0 in front is not lost
    two = (s[:-1] << _BITS) + s[1:]
    return np.unique(np.concatenate((s, two, (two[:-1] << _BITS) + s[2:])))


def _places(vocabulary: np.ndarray, grams: np.ndarray) -> np.ndarray:
    """Rows of the vocabulary that a text's n-grams have."""
    at = np.searchsorted(vocabulary, grams)
    inside = at < len(vocabulary)
    at, grams = at[inside], grams[inside]
    return at[vocabulary[at] == grams]


@dataclass(frozen=True)
class KernelModel:
    languages: tuple[str, ...]
    alphabet: np.ndarray | None  # None: every letter
    vocabulary: np.ndarray       # the n-grams of the landmarks, sorted
    weights: np.ndarray          # n-grams x languages

    def score(self, texts: list[str]) -> np.ndarray:
        """One value per text and language, about 1 for its own and -1 for the others."""
        alphabet = every_letter() if self.alphabet is None else self.alphabet
        out = np.zeros((len(texts), len(self.languages)))
        for at in range(0, len(texts), _BLOCK):
            grams = [ngrams(t, alphabet) for t in texts[at:at + _BLOCK]]
            # sparse presence rows (texts x n-grams, all entries 1) times the dense weights, for the whole block
            columns = [_places(self.vocabulary, g) for g in grams]
            owner = np.repeat(np.arange(len(grams)), [len(c) for c in columns])
            entries = self.weights[np.concatenate(columns)]
            product = np.column_stack([np.bincount(owner, w, len(grams)) for w in entries.T])
            out[at:at + _BLOCK] = product / np.sqrt([max(1, len(g)) for g in grams])[:, None]
        return out


def fit(grams: list[np.ndarray], langs: list[str], alphabet: np.ndarray | None = None, landmarks: int = LANDMARKS,
        ridge: float = RIDGE) -> KernelModel:
    """Kernel ridge regression on Nyström features; `grams` and `langs`: the bounded sample."""
    languages = tuple(sorted(set(langs)))
    chosen = [i for lang in languages for i in [j for j, x in enumerate(langs) if x == lang][:landmarks]]
    vocabulary = np.unique(np.concatenate([grams[i] for i in chosen])) if chosen else np.zeros(0, np.int64)
    rows = [_places(vocabulary, grams[i]) for i in chosen]
    norms = np.array([1 / np.sqrt(max(1, len(grams[i]))) for i in chosen])
    # the landmarks that have an n-gram, n-gram after n-gram (no table of n-grams x landmarks)
    flat = np.concatenate(rows) if rows else np.zeros(0, np.int64)
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])[np.argsort(flat, kind="stable")]
    sizes = np.bincount(flat, minlength=len(vocabulary))
    starts = np.cumsum(sizes) - sizes

    def common(g: np.ndarray) -> np.ndarray:
        r = _places(vocabulary, g)
        n = sizes[r]
        at = np.repeat(starts[r] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        return np.bincount(owner[at], minlength=len(chosen))

    kernel = np.array([common(g) * norms / np.sqrt(max(1, len(g))) for g in grams]).reshape(len(grams), len(chosen))
    values, vectors = np.linalg.eigh(kernel[chosen])
    good = values > 1e-8 * max(values.max(initial=0), 1e-300)
    root = vectors[:, good] / np.sqrt(values[good])  # kernel of the landmarks to the power -1/2
    features = kernel @ root
    target = np.where(np.array(langs)[:, None] == np.array(languages)[None, :], 1.0, -1.0)
    inner = features.T @ features + ridge * np.eye(features.shape[1])
    folded = norms[:, None] * (root @ np.linalg.solve(inner, features.T @ target))
    weights = np.zeros((len(vocabulary), len(languages)))
    for r, w in zip(rows, folded):
        weights[r] += w
    return KernelModel(languages, alphabet, vocabulary, weights)


def learn(docs: DataFrame, sample: int = SAMPLE) -> KernelModel | None:
    """Model from at most `sample` documents of each language outside the held-out fold (null
    without any).  Texts without a letter teach nothing.  The driver sees the n-gram
    numbers of the sample only, at most `sample` x languages short lists."""
    per_lang = Window.partitionBy("lang").orderBy("h", "doc_id")
    ids = (docs.select("doc_id", "lang").filter(F.col("lang").isNotNull() & ~held_out()).distinct()
           .withColumn("h", F.md5(F.concat_ws(" ", F.lit("langid"), "doc_id")))
           .withColumn("n", F.row_number().over(per_lang)).filter(F.col("n") <= sample)
           .select(F.col("doc_id").alias("__id"), F.col("lang").alias("__lang"), "h"))
    picked = docs.select("doc_id", "lang", "text").join(
        F.broadcast(ids), (F.col("doc_id") == F.col("__id")) & (F.col("lang") == F.col("__lang")))
    # one text for each id however often it is repeated: the sample stays bounded, and the same
    rows = stored(picked.filter(F.col("text").isNotNull()).groupBy("doc_id", "lang", "h").agg(F.min("text").alias("text"))
                  .select("lang", "h", "text"), "langid-sample")

    @F.arrow_udf("array<bigint>")
    def grams(texts: pa.Array) -> pa.Array:
        return pa.array([ngrams(t, every_letter()) if has_letter(t) else None for t in texts.to_pylist()],
                        pa.list_(pa.int64()))

    known = rows.select("lang", "h", grams("text").alias("g")).filter("g IS NOT NULL").orderBy("lang", "h", "g").collect()
    if not known:
        return None
    return fit([np.array(r["g"], np.int64) for r in known], [r["lang"] for r in known])


def identify(docs: DataFrame, model: KernelModel | None) -> DataFrame:
    """`docs` with lang_pred and score in place of columns so named: the language with the
    highest value (ties: the first by name) and that value brought into 0..1; `und` and 0.0 for
    a text that is null or has no letter, and without a model."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def predict(texts: pa.Array) -> pa.Array:
        values, m = texts.to_pylist(), sent.value
        langs, scores = ["und"] * len(values), [0.0] * len(values)
        at = [i for i, t in enumerate(values) if t is not None and has_letter(t)] if m is not None else []
        if at:
            s = m.score([values[i] for i in at])
            best = s.argmax(1)
            for i, k, v in zip(at, best, s[np.arange(len(at)), best]):
                langs[i], scores[i] = m.languages[k], float(min(1.0, max(0.0, (v + 1) / 2)))
        return pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                                          names=["lang_pred", "score"])

    udf = F.arrow_udf(predict, "struct<lang_pred:string,score:double>")
    at = free_name(docs, "__p")
    out = docs.withColumn(at, udf(F.col("text")))
    return out.withColumns({"lang_pred": F.col(f"{at}.lang_pred"), "score": F.col(f"{at}.score")}).drop(at)


def identify_languages(docs: DataFrame) -> DataFrame:
    """Learn from three folds, predict all: doc_id, held_out, lang_pred, score.  Repeated rows and
    null ids stay (a null id counts as held out)."""
    model = learn(docs.select("doc_id", "lang", "text"))
    return identify(docs.select("doc_id", "text"), model).select("doc_id", held_out().alias("held_out"), "lang_pred",
                                                                 "score")
