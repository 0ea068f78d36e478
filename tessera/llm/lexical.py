"""Ranked lexical search: the best documents of each query item by an integer term score, exactly.

A document is a vector with one impact for each query term it holds, an item a vector of term
weights, and a score their inner product.  As in LEMP the impact vectors are ordered by length
and searched in buckets of similar length: Cauchy-Schwarz (item length times the bucket's
longest vector) and the bucket's largest impact a coordinate rule whole buckets out for an item;
inside a bucket only vectors that hold one of the coordinates an item cannot do without are
looked at, and of these those whose partial sum plus bounds on the rest reaches the item's
tenth best score so far.  Survivors are scored again in 64-bit integers.
"""
from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import LOWER, UPPER, stored

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
TOP = 10
BLOCK_PAIRS = 200_000     # (item, term) pairs that are searched for together, about
BUCKET_ROWS = 4096        # vectors of a bucket at most
BUCKET_ENTRIES = 1 << 20  # impacts of a bucket at most, unless one vector holds more
PART_ENTRIES = 1 << 21    # impacts of a partition of the ordered index, about
LONGEST = 1 / 64          # share of the vectors, the longest, that the first thresholds come from
PIECE = 1 << 20           # bytes of a text that are cut into terms at a time
#: Term characters in lower case (A-Z only), everything else a blank.
_CUT = bytes(b if b >= 128 or chr(b).isalnum() and not 65 <= b <= 90 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def terms(text: bytes) -> Iterator[list[bytes]]:
    """Terms of a text with repeats, piece by piece."""
    at = 0
    while at < len(text):
        end = at + PIECE
        piece = text[at:end].translate(_CUT)
        while end < len(text) and _CUT[text[end]] != 32:  # not inside a term
            more = text[end:end + 256].translate(_CUT)
            stop = more.find(b" ")
            piece += more if stop < 0 else more[:stop]
            end += len(more) if stop < 0 else stop
            if stop >= 0:
                break
        at = end
        yield piece.split()


@dataclass(frozen=True)
class Items:
    """Query items of one block: terms and weights of item i stand at `ends[i]` to `ends[i + 1]`."""
    ids: tuple
    vocabulary: dict[bytes, int]
    ends: np.ndarray
    terms: np.ndarray

    def pairs(self, weight: np.ndarray) -> "Weighed":
        w = weight[self.terms]
        owner = np.repeat(np.arange(len(self.ids)), np.diff(self.ends))
        return Weighed(self.ends, self.terms, w, np.sqrt(np.bincount(owner, w.astype(float) ** 2, len(self.ids))))


@dataclass(frozen=True)
class Weighed:
    ends: np.ndarray
    terms: np.ndarray
    weights: np.ndarray
    lengths: np.ndarray


def item_terms(benchmark: DataFrame) -> DataFrame:
    """Distinct (item_id, term); rows that share an id make one item."""
    low = F.translate(F.coalesce("text", F.lit("")), UPPER, LOWER)
    return benchmark.select("item_id", F.explode(F.regexp_extract_all(low, F.lit(TERM), F.lit(0))).alias("term")).distinct()


def item_blocks(benchmark: DataFrame) -> Iterator[Items]:
    """The items in blocks of about BLOCK_PAIRS (item, term) pairs, gathered one after another."""
    pairs = stored(item_terms(benchmark), "item-terms")
    blocks = -(-pairs.count() // BLOCK_PAIRS)
    for b in range(blocks):
        rows = pairs.filter(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b).groupBy("item_id").agg(
            F.sort_array(F.collect_list("term")).alias("terms")).collect()
        rows.sort(key=lambda r: (r["item_id"] is None, r["item_id"]))
        vocabulary: dict[bytes, int] = {}
        lists = [[vocabulary.setdefault(t.encode(), len(vocabulary)) for t in r["terms"]] for r in rows]
        yield Items(tuple(r["item_id"] for r in rows), vocabulary, np.cumsum([0] + [len(x) for x in lists]),
                    np.array([t for x in lists for t in x], np.int64))


def counted(docs: DataFrame, items: Items) -> DataFrame:
    """(doc_id, n, ids, tfs) of every document with a term: its number of terms, and how often the terms
    of the block's items occur in it.  Written once."""
    shared = docs.sparkSession.sparkContext.broadcast(items.vocabulary)

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for part in parts:
            n, ids, tfs, ends, rows = [], [], [], [0], []
            for i, text in enumerate(part.column(1).cast(pa.binary()).to_pylist()):
                size, held = 0, Counter()
                for words in terms(text or b""):
                    size += len(words)
                    for w, c in Counter(words).items():
                        if w in known:
                            held[known[w]] += c
                if size:
                    rows.append(i)
                    n.append(size)
                    ids += held.keys()
                    tfs += held.values()
                    ends.append(len(ids))
            yield pa.RecordBatch.from_arrays(
                [part.column(0).take(pa.array(rows, pa.int64())), pa.array(n, pa.int64()),
                 pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32())),
                 pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(tfs, pa.int64()))], names=["doc_id", "n", "ids", "tfs"])

    kind = dict(docs.dtypes)["doc_id"]
    return stored(docs.select("doc_id", "text").mapInArrow(count, f"doc_id {kind}, n long, ids array<int>, tfs array<long>"),
                  "term-counts")


def term_weights(vectors: DataFrame, n_docs: int, size: int) -> np.ndarray:
    """Weight of each term of the block; 0 for a term that no document holds."""
    out = np.zeros(size, np.int64)
    for r in vectors.select(F.explode("ids").alias("t")).groupBy("t").count().collect():
        out[r["t"]] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * r["count"] + 1)))
    return out


def ordered(vectors: DataFrame, n_docs: int, n_terms: int) -> DataFrame:
    """(doc_id, length, ids, impacts), the longest vectors first: dealt by ranges of length to partitions and
    sorted inside, written once.  Equal lengths are dealt on by the row, so copies do not pile up."""
    spread = f"(cast(n as decimal(18,0)) * cast({90 * n_docs} as decimal(20,0))) div {n_terms}"
    impacts = F.expr(f"transform(tfs, t -> cast((1000000000L * t) div (1000L * t + 8L * (10L + cast({spread} as bigint))) as int))")
    rows = vectors.filter("size(ids) > 0").select("doc_id", "ids", impacts.alias("impacts"))
    square = F.aggregate("impacts", F.lit(0.0), lambda a, x: a + x.cast("double") * x)
    entries = vectors.agg(F.sum(F.size("ids"))).first()[0] or 0
    rows = rows.select("doc_id", F.sqrt(square).alias("length"), "ids", "impacts", F.monotonically_increasing_id().alias("row"))
    parts = max(16, -(-entries // PART_ENTRIES))
    out = rows.repartitionByRange(parts, F.desc("length"), "row").sortWithinPartitions(F.desc("length"), "row").drop("row")
    return stored(out, "impact-vectors")


class Best:
    """The TOP best (score, doc_id) of an item: higher scores first, then lower ids, null ids last."""
    def __init__(self, least: int):
        self.rows, self.least = [], least  # `least`: scores below it cannot be among the best

    def add(self, scores: list[int], ids: list) -> None:
        self.rows += [r for r in zip(scores, ids) if r[0] >= self.least]
        self.rows.sort(key=lambda r: (-r[0], r[1] is None, 0 if r[1] is None else r[1]))
        del self.rows[TOP:]
        if len(self.rows) == TOP:
            self.least = max(self.least, self.rows[-1][0])


class Bucket:
    """Vectors of similar length, as lists of (row, impact) a term."""
    def __init__(self, longest: np.ndarray, ends: np.ndarray, ids: np.ndarray, impacts: np.ndarray, n_terms: int):
        self.squares, self.longest = longest ** 2, float(longest.max())
        order = np.argsort(ids, kind="stable")
        self.rows = np.repeat(np.arange(len(longest)), np.diff(ends))[order]
        self.impacts = impacts[order].astype(np.int64)
        self.starts = np.searchsorted(ids[order], np.arange(n_terms + 1))
        held = np.flatnonzero(np.diff(self.starts))
        self.highest = np.zeros(n_terms, np.int64)
        self.highest[held] = np.maximum.reduceat(self.impacts, self.starts[held]) if len(held) else 0

    def lists(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows and impacts of some terms, one after another, and the position of each one's term in `which`."""
        sizes = self.starts[which + 1] - self.starts[which]
        place = np.repeat(np.arange(len(which)), sizes)
        at = np.arange(len(place)) + np.repeat(self.starts[which] - np.concatenate(([0], np.cumsum(sizes)[:-1])), sizes)
        return self.rows[at], self.impacts[at], place

    def survivors(self, terms: np.ndarray, weights: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
        """(rows, exact scores) of the vectors that the bounds cannot rule out for an item."""
        most = weights * self.highest[terms]
        order = np.argsort(most, kind="stable")
        terms, weights, sums = terms[order], weights[order], np.cumsum(most[order])
        without = int(np.searchsorted(sums, max(least, 1)))  # the first terms alone stay below `least`
        rest = int(sums[without - 1]) if without else 0
        n = len(self.squares)
        rows, x, place = self.lists(terms[without:])
        w = weights[without:][place]
        partial = np.bincount(rows, w * x, n)  # below 2**53, so exact
        found = np.flatnonzero(partial)
        left = np.sqrt(np.maximum(self.squares[found] - np.bincount(rows, x.astype(float) ** 2, n)[found], 0) + 1)
        free = np.sqrt((weights[:without].astype(float) ** 2).sum())
        found = found[partial[found] + np.minimum(rest, left * free * (1 + 1e-9) + 1) >= least]
        if not len(found):
            return found, found
        scores = np.zeros(n, np.int64)
        np.add.at(scores, rows, w * x)
        if without:
            rows, x, place = self.lists(terms[:without])
            np.add.at(scores, rows, weights[:without][place] * x)
        good = (scores[found] >= least) & (scores[found] > 0)
        return found[good], scores[found][good]


def buckets(part: pa.RecordBatch, n_terms: int) -> Iterator[tuple[Bucket, pa.Array]]:
    """A batch of ordered vectors (doc_id, length, ids, impacts) in buckets, with their ids."""
    length = part.column(1).to_numpy(zero_copy_only=False)
    ends = part.column(2).offsets.to_numpy()
    first, last = ends[0], ends[-1]
    ids = part.column(2).values.to_numpy(zero_copy_only=False)[first:last]
    impacts = part.column(3).values.to_numpy(zero_copy_only=False)
    impacts = impacts[part.column(3).offsets.to_numpy()[0]:][:last - first]
    ends, a = ends - first, 0
    while a < len(length):
        b = int(np.searchsorted(ends, ends[a] + BUCKET_ENTRIES, "right")) - 1
        b = min(max(b, a + 1), a + BUCKET_ROWS, len(length))
        yield Bucket(length[a:b], ends[a:b + 1] - ends[a], ids[ends[a]:ends[b]], impacts[ends[a]:ends[b]], n_terms), part.column(0)[a:b]
        a = b


def search_task(parts: Iterator[pa.RecordBatch], items: Weighed, least: np.ndarray, n_terms: int) -> dict[int, Best]:
    """The best vectors of one task for each item."""
    best: dict[int, Best] = {}
    now = least.copy()
    for part in parts:
        for bucket, ids in buckets(part, n_terms):
            bound = np.add.reduceat(items.weights * bucket.highest[items.terms], items.ends[:-1])
            open_ = (bound >= np.maximum(now, 1)) & (items.lengths * bucket.longest * (1 + 1e-9) + 1 >= now)
            for i in np.flatnonzero(open_):
                own = slice(items.ends[i], items.ends[i + 1])
                rows, scores = bucket.survivors(items.terms[own], items.weights[own], int(now[i]))
                if len(rows):
                    if len(rows) > TOP:  # only the best of them, with all ties of the last
                        keep = scores >= np.partition(scores, len(scores) - TOP)[len(scores) - TOP]
                        rows, scores = rows[keep], scores[keep]
                    kept = best.setdefault(int(i), Best(int(least[i])))
                    kept.add(scores.tolist(), ids.take(pa.array(rows)).to_pylist())
                    now[i] = max(now[i], kept.least)
    return best


def search(index: DataFrame, items: Weighed, least: np.ndarray, n_terms: int) -> DataFrame:
    """(item, doc_id, score): of every task the vectors that may be among an item's best."""
    shared = index.sparkSession.sparkContext.broadcast((items, least))
    kind = dict(index.dtypes)["doc_id"]

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = []

        def watched() -> Iterator[pa.RecordBatch]:
            for p in parts:
                types[:] = [p.schema.field(0).type]
                yield p

        found = search_task(watched(), *shared.value, n_terms)
        rows = [(i, d, s) for i, b in found.items() for s, d in b.rows]
        for k in range(0, len(rows), 1 << 14):
            i, d, s = zip(*rows[k:k + (1 << 14)])
            yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(d, types[0]), pa.array(s, pa.int64())],
                                             names=["item", "doc_id", "score"])

    return index.mapInArrow(run, f"item int, doc_id {kind}, score long")


def ranked(found: DataFrame) -> DataFrame:
    """(item, rank, doc_id, score) of the TOP best of each item; Spark limits each task's rows first."""
    by = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= TOP)


def search_block(docs: DataFrame, items: Items, kind: str) -> DataFrame | None:
    """(item_id, rank, doc_id, score) of one block of items."""
    spark, size = docs.sparkSession, len(items.vocabulary)
    vectors = counted(docs, items)
    totals = vectors.agg(F.count(F.lit(1)).alias("n"), F.sum("n").alias("l")).first()
    if not totals["n"]:
        return None
    weighed = items.pairs(term_weights(vectors, totals["n"], size))
    index = ordered(vectors, totals["n"], totals["l"])
    cut = index.agg(F.percentile_approx("length", 1 - LONGEST)).first()[0]
    if cut is None:
        return None
    nothing = np.zeros(len(items.ids), np.int64)
    first = stored(ranked(search(index.filter(F.col("length") >= cut), weighed, nothing, size)), "longest")
    least = nothing.copy()
    for r in first.filter(F.col("rank") == TOP).select("item", "score").collect():
        least[r["item"]] = r["score"]
    usable = weighed.lengths > 0
    shortest = float((least[usable] / weighed.lengths[usable]).min(initial=np.inf)) * (1 - 1e-9) - 1  # Cauchy-Schwarz
    others = search(index.filter((F.col("length") < cut) & (F.col("length") >= shortest)), weighed, least, size)
    named = spark.createDataFrame(list(enumerate(items.ids)), f"item int, item_id {kind}")
    return ranked(first.select("item", "doc_id", "score").union(others)).join(named, "item").select(
        "item_id", "rank", "doc_id", "score")


def rank_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The TOP highest-scoring documents of each item with a score above 0: item_id, rank (from 1), doc_id,
    score (long); equal scores by ascending doc_id (null ids last).

    Every row of `docs` is a document of its own, repeated rows too; rows of `benchmark` that share an id
    (null is one) make one item.  Null and empty texts have no terms: they are in no result and count
    for nothing.  Texts are read whole, piece by piece.  Empty tables give no row; extra columns are
    ignored.  Items are searched for in blocks of bounded size, each with a pass over the texts; what
    is gathered on the driver is a block's terms and thresholds."""
    kind = dict(benchmark.dtypes)["item_id"]
    out = [r for b in item_blocks(benchmark) if (r := search_block(docs, b, kind)) is not None]
    if not out:
        return docs.sparkSession.createDataFrame([], f"item_id {kind}, rank int, doc_id {dict(docs.dtypes)['doc_id']}, score long")
    whole = out[0]
    for r in out[1:]:
        whole = whole.unionByName(r)
    return whole


def sql(top: int = TOP) -> str:
    """The same ranking by plain joins over all pairs of item and document that share a term."""
    cut = f"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{TERM}')"
    return f"""
WITH it AS (SELECT DISTINCT item_id, unnest({cut}) AS term FROM benchmark),
     d AS (SELECT * FROM (SELECT row_number() OVER () AS r, doc_id, {cut} AS ts FROM documents) WHERE len(ts) > 0),
     s AS (SELECT count(*) AS nd, CAST(sum(len(ts)) AS BIGINT) AS l FROM d),
     tf AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(ts) AS term FROM d)
             WHERE term IN (SELECT term FROM it) GROUP BY ALL),
     w AS (SELECT term, CAST(floor(1000 * ln((2 * any_value(nd) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
             FROM tf, s GROUP BY term),
     p AS (SELECT tf.r, doc_id, term, (1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * len(ts) * nd) // l)) AS x
             FROM tf JOIN d ON tf.r = d.r, s),
     sc AS (SELECT item_id, r, any_value(doc_id) AS doc_id, CAST(sum(w * x) AS BIGINT) AS score
              FROM it JOIN w USING (term) JOIN p USING (term) GROUP BY item_id, r HAVING sum(w * x) > 0)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
  FROM sc QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= {top}"""
