"""Token counts by the whole-token shortcut.

A byte-level BPE splits a text into pre-tokens and merges each of them on its own, so the number
of tokens of a text is a sum over its pre-tokens.  Before the job starts, every string of the
vocabulary is put to the proof: it must be one pre-token, and merging it must give exactly one
token.  The proven strings count 1 without any merging; only the other pre-tokens are merged
(by the library's own model), with a bounded memo for those that come again.
"""
from __future__ import annotations

import json
import re
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer, pre_tokenizers

#: The split of the byte-level pre-tokenizer (fixed value, it must equal the library's).
PRE_TOKEN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
MEMO = 300_000       # remembered pre-tokens per Python worker
MEMO_CHARS = 40      # longer pre-tokens are merged each time
LONG_TEXT = 1 << 20  # from here on pre-tokens are iterated, not listed


@lru_cache(maxsize=4)
def prove_whole_tokens(spec: str) -> tuple[str, ...]:
    """The vocabulary strings of a byte-level BPE (its JSON) that encode alone as one token."""
    info = json.loads(spec)
    pre = info.get("pre_tokenizer") or {}
    if info["model"]["type"] != "BPE" or pre.get("type") != "ByteLevel" or not pre.get("use_regex", True) \
            or pre.get("add_prefix_space") or info.get("normalizer"):
        raise ValueError("a byte-level BPE without normalizer and prefix space is needed")
    if any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in info["added_tokens"]):
        raise ValueError("added tokens that strip, need word ends or normalise are not supported")
    tok, split = Tokenizer.from_str(spec), regex.compile(PRE_TOKEN)
    added = {t["id"] for t in info["added_tokens"]}
    ids = [i for i in tok.get_vocab().values() if i not in added]
    texts = tok.decode_batch([[i] for i in ids], skip_special_tokens=False)
    whole = []
    for i, s in zip(ids, texts):
        if s and "�" not in s and split.fullmatch(s) and split.findall(s) == [s]:
            if [t.id for t in tok.model.tokenize(_bytes_as_letters(s))] == [i]:
                whole.append(s)
    return tuple(sorted(whole))


_LETTERS = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)


def _bytes_as_letters(s: str) -> str:
    return "".join(p for p, _ in _LETTERS.pre_tokenize_str(s))


class TokenCounter:
    """Counts the tokens of texts for one tokenizer file (given as its JSON)."""

    def __init__(self, spec: str, whole: tuple[str, ...]):
        model = Tokenizer.from_str(spec).model
        special = sorted((t["content"] for t in json.loads(spec)["added_tokens"]), key=len, reverse=True)
        self._special = re.compile("|".join(map(re.escape, special))) if special else None
        self._split = regex.compile(PRE_TOKEN)
        ones = dict.fromkeys(whole, 1)

        class Costs(dict):
            def __missing__(self, piece: str) -> int:
                n = len(model.tokenize(_bytes_as_letters(piece)))
                if len(piece) <= MEMO_CHARS:
                    if len(self) >= len(ones) + MEMO:
                        self.clear()
                        self.update(ones)
                    self[piece] = n
                return n

        self._costs = Costs(ones)

    def count(self, text: str) -> int:
        parts = self._special.split(text) if self._special else [text]
        n, cost = len(parts) - 1, self._costs.__getitem__
        for part in parts:
            if len(part) < LONG_TEXT:
                n += sum(map(cost, self._split.findall(part)))
            else:
                n += sum(cost(m.group()) for m in self._split.finditer(part))
        return n


_COUNTERS: dict[int, tuple[str, TokenCounter]] = {}


def _counter(spec: str, whole: tuple[str, ...]) -> TokenCounter:
    key = hash(spec)
    if key not in _COUNTERS or _COUNTERS[key][0] != spec:
        _COUNTERS.clear()
        _COUNTERS[key] = (spec, TokenCounter(spec, whole))
    return _COUNTERS[key][1]


def token_count(spark: SparkSession, text: Column, tokenizer_path: str) -> Column:
    """Column with the number of tokens of `text` (null: 0).  The tokenizer file is read on the
    driver and sent to the workers with the proven strings (a fixed size, whatever the data)."""
    with open(tokenizer_path, encoding="utf-8") as f:
        spec = f.read()
    sent = spark.sparkContext.broadcast((spec, prove_whole_tokens(spec)))

    @F.arrow_udf("long")
    def count(texts: pa.Array) -> pa.Array:
        counter = _counter(*sent.value)
        return pa.array([0 if t is None else counter.count(t) for t in texts.to_pylist()], pa.int64())

    return count(text)


def count_tokens(docs: DataFrame, tokenizer_path: str, limit: int = 512) -> DataFrame:
    """`docs` with n_bytes (UTF-8), n_tokens and over_limit (n_tokens > limit) in place of columns
    so named.  Row by row: repeated rows and null ids stay, a null text counts as empty, an empty
    table gives an empty result."""
    text = F.coalesce(F.col("text"), F.lit(""))
    out = docs.withColumns({"n_bytes": F.octet_length(text).cast("long"),
                            "n_tokens": token_count(docs.sparkSession, F.col("text"), tokenizer_path)})
    return out.withColumn("over_limit", F.col("n_tokens") > limit)
