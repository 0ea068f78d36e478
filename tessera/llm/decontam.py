"""Benchmark decontamination with SimHash windows.

Every benchmark item is compared with the windows of a document that have as many words as it:

1. Every window that has a 5-word shingle of some item of its length gets a fingerprint, its SimHash
   (64 bits, over its words).  Windows without one have similarity 0 with all items of the length; one
   look-up per shingle tells them, and most documents end here.
2. The fingerprints are looked up in the multi-index of the items of that length: four blocks of 16
   bits; fingerprints within RADIUS bits differ by at most RADIUS // 4 bits in one block at least,
   and each block's table knows the items within so many bits of any value.  No item within the
   radius is lost.  These are the candidates.
3. The exact weighted similarity of the shingles (counts as weights: sum of least over sum of
   greatest) confirms or drops each candidate.

An item of fewer than five words is one shingle, its whole sequence: the windows of its length that
equal it are copies.  Items are sent to the tasks in blocks of bounded size, one pass over the
documents for each; a task holds one block.

An item of n words has n - 4 shingles, and one replaced word changes five of them: at a similarity of
0.8 a copy with one word replaced in the middle counts from 49 words on, one with two from 94.
"""
from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.core.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import free_name, stored
from tessera.llm.shingles import shingles, windows, word_hashes

SHINGLE = 5
LEAST = 0.8            # similarity from which a window counts as a copy of an item
RADIUS = 19            # a window of that similarity has about 5 bits, at worst 9 or 10 bits, of 64 changed
_BLOCKS, _BITS = 4, 16
TABLE_ITEMS = 500      # items in one multi-index (its tables take about 10,000 entries of 4 bytes an item)
PASS_ITEMS = 10_000    # items sent with one pass over the documents
WINDOWS = 4096         # windows fingerprinted and looked up at once
_FILTER = 20           # bits of the first, inexact look-up


def fingerprints(bits: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """SimHash of the windows at `starts`, from running sums of the words' bits (words + 1, 64)."""
    sums = bits[starts + length] - bits[starts]
    return np.packbits(2 * sums > length, axis=1, bitorder="little").view(np.uint64)[:, 0]


def running_bits(h: np.ndarray) -> np.ndarray:
    each = np.unpackbits(h.view(np.uint8).reshape(len(h), 8), axis=1, bitorder="little")
    out = np.zeros((len(h) + 1, 64), np.int32)
    np.cumsum(each, axis=0, out=out[1:])
    return out


_BALL = np.array([x for x in range(1 << _BITS) if x.bit_count() <= RADIUS // _BLOCKS], np.uint16)


def _block(prints: np.ndarray, k: int) -> np.ndarray:
    return (prints >> np.uint64(_BITS * k)).astype(np.uint16)


class MultiIndex:
    """Items by the values of each fingerprint block, and all values near them, sorted."""

    def __init__(self, prints: np.ndarray):
        self.prints = prints
        items = np.repeat(np.arange(len(prints), dtype=np.uint16), len(_BALL))
        self.tables = []
        for k in range(_BLOCKS):
            values = (_block(prints, k)[:, None] ^ _BALL[None, :]).ravel()
            order = np.argsort(values, kind="stable")
            self.tables.append((values[order], items[order]))

    def within(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Every (place in `prints`, item, distance) with at most RADIUS bits between the two, in order."""
        near = []
        for k, (values, items) in enumerate(self.tables):
            own = _block(prints, k)
            first = np.searchsorted(values, own, "left")
            n = np.searchsorted(values, own, "right") - first
            at = np.repeat(np.arange(len(own)), n)
            item = items[np.repeat(first, n) + runs(n)].astype(np.int64)
            close = np.bitwise_count(prints[at] ^ self.prints[item]) <= RADIUS
            near.append(at[close] * len(self.prints) + item[close])
        at, item = np.divmod(np.unique(np.concatenate(near)), len(self.prints))
        return at, item, np.bitwise_count(prints[at] ^ self.prints[item])


def runs(n: np.ndarray) -> np.ndarray:
    """0 .. n[0] - 1, 0 .. n[1] - 1, and so on."""
    return np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)


@dataclass(frozen=True)
class Hit:
    item_id: int
    start_word: int
    n_words: int
    hamming: int
    similarity: float


class Benchmark:
    """Items prepared for search; null texts and texts without a word are left out."""

    def __init__(self, items: list[tuple[int, str]]):
        self.ids, self.counts, every = [], [], []
        prints: dict[int, list[tuple[int, np.uint64]]] = {}  # items and their fingerprints by size
        self.short: dict[int, dict[int, list[int]]] = {}  # items of fewer than SHINGLE words: length, hash, ids
        for item_id, text in items:
            h = word_hashes((text or "").encode())
            if len(h) < SHINGLE:
                if len(h):
                    self.short.setdefault(len(h), {}).setdefault(int(windows(h, len(h))[0]), []).append(item_id)
                continue
            s = shingles(h, SHINGLE)
            self.ids.append(item_id)
            self.counts.append(np.unique(s, return_counts=True))
            one = fingerprints(running_bits(h), np.zeros(1, np.int64), len(h))[0]
            prints.setdefault(len(s), []).append((len(self.ids) - 1, one))
            every.append(np.stack([self.counts[-1][0], np.full(len(self.counts[-1][0]), len(s), np.uint64)], 1))
        pairs = np.unique(np.concatenate(every), axis=0) if every else np.zeros((0, 2), np.uint64)
        # the shingles of all items, and for each the sizes (in shingles) of the items that have it
        self.known, first = np.unique(pairs[:, 0], return_index=True)
        self.first, self.of_size = np.append(first, len(pairs)), pairs[:, 1].astype(np.int64)
        self.maybe = np.zeros(1 << _FILTER, bool)
        self.maybe[(self.known >> np.uint64(64 - _FILTER)).astype(np.int64)] = True
        #: for each size the multi-indexes of its items, with the items' numbers
        self.indexes = {size: [(np.array([i for i, _ in part]), MultiIndex(np.array([x for _, x in part], np.uint64)))
                               for part in (own[at:at + TABLE_ITEMS] for at in range(0, len(own), TABLE_ITEMS))]
                        for size, own in prints.items()}

    def search(self, text: bytes) -> list[Hit]:
        """The best window of its length for each item that the text holds a copy of (ties: the
        first).  A text shorter than an item is one window as a whole."""
        h = word_hashes(text)
        return self._short(h) + self._long(h)

    def _short(self, h: np.ndarray) -> list[Hit]:
        """Items of fewer than SHINGLE words: the first window with the same words."""
        out = []
        for n, items in self.short.items():
            if len(h) >= n:
                own = windows(h, n)
                known = np.fromiter(items, np.uint64, len(items))
                values, at = np.unique(own[np.isin(own, known)], return_index=True)
                place = np.flatnonzero(np.isin(own, known))
                out += [Hit(i, int(place[k]), n, 0, 1.0) for v, k in zip(values.tolist(), at) for i in items[v]]
        return out

    def _long(self, h: np.ndarray) -> list[Hit]:
        if len(h) < SHINGLE or not len(self.known):
            return []
        s = shingles(h, SHINGLE)
        at = np.flatnonzero(self.maybe[(s >> np.uint64(64 - _FILTER)).view(np.int64)])
        if not len(at):
            return []
        row = np.minimum(np.searchsorted(self.known, s[at]), len(self.known) - 1)
        real = self.known[row] == s[at]
        at, row = at[real], row[real]
        n = self.first[row + 1] - self.first[row]  # sizes for each shingle found
        where = np.repeat(at, n)
        sizes = self.of_size[np.repeat(self.first[row], n) + runs(n)]
        best: dict[int, Hit] = {}
        for size in np.unique(sizes).tolist():
            wide = min(size, len(s))
            shared = np.zeros(len(s) + 1, np.int64)
            shared[where[sizes == size] + 1] = 1
            np.cumsum(shared, out=shared)
            starts = np.flatnonzero(shared[wide:] > shared[:-wide])
            seen: dict[tuple[int, bytes], float] = {}  # the same words again have the same answer
            for k in range(0, len(starts), WINDOWS):
                for start, i, d in self._near(h, starts[k:k + WINDOWS], size, wide + SHINGLE - 1):
                    window = np.sort(s[start:start + wide])
                    key = i, window.tobytes()
                    if key not in seen:
                        seen[key] = similarity(np.unique(window, return_counts=True), self.counts[i])
                    x = seen[key]
                    if x >= LEAST and (i not in best or x > best[i].similarity):
                        best[i] = Hit(self.ids[i], start, wide + SHINGLE - 1, d, x)
        return [best[i] for i in sorted(best)]

    def _near(self, h: np.ndarray, starts: np.ndarray, size: int, words: int) -> Iterator[tuple[int, int, int]]:
        """(start, item, distance) of the windows of `words` words at `starts` (rising) and the items of `size`
        shingles within the radius; only the words that the windows span are held as bits."""
        for run in np.split(starts, np.flatnonzero(np.diff(starts) > WINDOWS) + 1):
            prints = fingerprints(running_bits(h[run[0]:run[-1] + words]), run - run[0], words)
            for numbers, index in self.indexes[size]:
                for at, item, d in zip(*(x.tolist() for x in index.within(prints))):
                    yield int(run[at]), int(numbers[item]), d


Counts = tuple[np.ndarray, np.ndarray]


def similarity(a: Counts, b: Counts) -> float:
    """Weighted Jaccard similarity of two multisets of shingles."""
    _, at, bt = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    common = int(np.minimum(a[1][at], b[1][bt]).sum())
    return common / (int(a[1].sum()) + int(b[1].sum()) - common)


_READY: list = [None, None]  # the block last sent to this worker, and the same prepared


def _prepared(block: list[tuple[int, str]]) -> Benchmark:
    if _READY[0] is not block:
        _READY[:] = block, Benchmark(block)
    return _READY[1]


_HITS = "array<struct<item_id:bigint,start_word:bigint,n_words:bigint,hamming:int,similarity:double>>"


def blocks_of(benchmark: DataFrame, size: int = PASS_ITEMS) -> Iterator[list[tuple[int, str]]]:
    """The benchmark's (item_id, text) in blocks of about `size` rows, each small enough to send; the driver
    gathers one after another."""
    items = benchmark.select("item_id", "text").distinct()  # a repeated item is one item
    k = -(-items.count() // size)
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(k))
    for b in range(k):
        yield [(r[0], r[1]) for r in items.filter(part == b).orderBy("item_id", "text").collect()]


_HIT = pa.list_(pa.struct([("item_id", pa.int64()), ("start_word", pa.int64()), ("n_words", pa.int64()),
                           ("hamming", pa.int32()), ("similarity", pa.float64())]))


def _searcher(sent: Broadcast) -> Callable[[pa.Array], pa.Array]:
    def search(texts: pa.Array) -> pa.Array:
        ready = _prepared(sent.value)
        return pa.array([[vars(x) for x in ready.search(b or b"")] for b in texts.cast(pa.binary()).to_pylist()], _HIT)

    return search


def with_hits(docs: DataFrame, block: list[tuple[int, str]], column: str) -> DataFrame:
    """`docs` with an array column of the items of one block found in each text; one Python pass, no
    shuffle.  (Marked as not deterministic, or Spark would search a text again for each later use of
    the column.)"""
    sent = docs.sparkSession.sparkContext.broadcast(block)
    return docs.withColumn(column, F.arrow_udf(_searcher(sent), _HITS).asNondeterministic()(F.coalesce(F.col("text"), F.lit(""))))


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document and item found in it: doc_id, item_id, start_word, n_words, hamming,
    similarity (of the best window).

    Documents with null or empty texts hold nothing; null ids and repeated rows are reported like
    any other row; an empty benchmark or table gives an empty result.  Each block of items is a pass
    of its own over the documents."""
    rows, out = docs.select("doc_id", "text"), None
    for block in blocks_of(benchmark):
        hits = with_hits(rows, block, "hits").filter(F.size("hits") > 0).select("doc_id", F.explode("hits").alias("h"))
        hits = hits.select("doc_id", "h.*")
        out = hits if out is None else out.unionByName(hits)
    if out is None:
        out = with_hits(rows.limit(0), [], "hits").select("doc_id", F.explode("hits").alias("h")).select("doc_id", "h.*")
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """`docs` without the documents that hold a copy of a benchmark item, columns unchanged.

    Documents with null or empty texts and null ids stay unless they hold a copy, repeated rows stay or go
    together; an empty benchmark keeps all.  Between two blocks of items the documents that are left
    are written to the shared folder, so no task holds two blocks."""
    hits, out = free_name(docs, "__hits"), docs
    for k, block in enumerate(blocks_of(benchmark)):
        out = stored(out, f"clean-{k}") if k else out
        out = with_hits(out, block, hits).filter(F.size(hits) == 0).drop(hits)
    return out
