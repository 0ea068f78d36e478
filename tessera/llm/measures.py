"""Measurements of a text that quality rules and the quality classifier share.

One pass of a text's UTF-8 bytes gives them all; words are runs without the six ASCII
white-space characters, lines are split at ``\\n`` alone.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

SYMBOLS = b"#*$%&|<>"
_SPACES = b" \t\n\x0b\x0c\r"
_UPPER = bytes(range(65, 91))
_DIGITS = b"0123456789"
_PUNCT = b".,;:"

#: Name of each measurement, in the order in which `measure` returns them.
NAMES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_distinct_words",
         "n_upper", "n_digits", "n_exclaim", "n_punct", "longest_word", "longest_run")
TYPE = "struct<" + ",".join(f"{n}:bigint" for n in NAMES) + ">"


def measure(b: bytes) -> tuple[int, ...]:
    words = b.split()  # bytes.split() cuts at exactly the six ASCII white-space characters
    n = len(words)
    if n == 0:
        return (0,) * len(NAMES)
    chars = len(b.decode("utf-8")) - (len(b) - len(b.translate(None, _SPACES)))
    without = lambda which: len(b) - len(b.translate(None, which))
    lines = [x for x in b.split(b"\n") if x.strip()]
    ids: dict[bytes, int] = {}
    seq = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, n)
    return (n, chars, without(SYMBOLS), len(lines) - len(set(lines)), repeated_window_words(seq, len(ids)), len(lines),
            len(ids), without(_UPPER), without(_DIGITS), b.count(b"!"), without(_PUNCT), max(map(len, words)),
            longest_run(seq))


def repeated_window_words(seq: np.ndarray, distinct: int) -> int:
    """Words inside 3-word windows that occur twice or more (`seq`: word numbers below `distinct`)."""
    if len(seq) < 4:
        return 0
    if distinct < 2_000_000:  # below 2**63 with three factors
        window = (seq[:-2] * distinct + seq[1:-1]) * distinct + seq[2:]
    else:
        pairs = np.unique(seq[:-1] * distinct + seq[1:], return_inverse=True)[1]
        window = pairs[:-1] * distinct + seq[2:]
    order = np.argsort(window, kind="stable")
    same = window[order[1:]] == window[order[:-1]]
    if not same.any():
        return 0
    again = np.zeros(len(window), bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    cover = np.zeros(len(seq), bool)
    for k in range(3):
        cover[k:len(window) + k] |= again
    return int(cover.sum())


def longest_run(seq: np.ndarray) -> int:
    """Length of the longest run of one word."""
    edges = np.flatnonzero(np.diff(seq))
    return int(np.diff(np.concatenate(([-1], edges, [len(seq) - 1]))).max())


def _measures(texts: pa.Array) -> pa.Array:
    rows = [measure(b or b"") for b in texts.cast(pa.binary()).to_pylist()]
    cols = np.array(rows, np.int64).reshape(len(rows), len(NAMES)).T
    return pa.StructArray.from_arrays([pa.array(c) for c in cols], names=list(NAMES))


def measures(text: str = "text") -> Column:
    """Struct column of all measurements; a null text measures like an empty one (all 0)."""
    return F.arrow_udf(_measures, TYPE)(F.coalesce(F.col(text), F.lit("")))
