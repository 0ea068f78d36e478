"""Mixing sources to target weights by Sainte-Laguë apportionment.

Each source's documents, in a seeded order, form a stream of words that is cut into blocks of
equal length.  Targets share the corpus by weight, no source above LIMIT times its size.  Blocks
are seats: they go to the sources by the highest quotients target / (seat - 1/2), as many as the
corpus holds.  A source's blocks are dealt to mix shards, each with an integer quota, and within a
shard a seeded permutation says which blocks are taken once more than the others.
"""
from __future__ import annotations

import math
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import WORD, stored

WEIGHTS = (1, 2, 3)  # of the sources in order, repeating
LIMIT = 3            # a source gives at most so many times its words
BLOCK = 256          # words in a block at most
LEAST_BLOCKS = 256   # a source of fewer words than BLOCK * LEAST_BLOCKS has smaller blocks
SHARDS = 16
SEED = "mix"
#: Steps of the seeded permutation: primes; the first that does not divide the number of blocks.
STEPS = (786433, 393241, 196613)
ROWS_A_BUCKET = 8192


def order_key(doc_id: Column, text: Column, seed: str = SEED) -> Column:
    """60 bits (hex) by which documents are ordered; a null id is ordered by its text."""
    own = F.coalesce(doc_id.cast("string"), F.concat(F.lit("null "), F.md5(F.coalesce(text, F.lit("")))))
    return F.substring(F.md5(F.concat(F.lit(f"{seed} "), own)), 1, 15)


def sized(docs: DataFrame, whole: bool = False) -> DataFrame:
    """doc_id, source, size (words; null text: 0) and the order key of every row; with `whole`, the
    row itself too, as one struct (so that no name of a caller can clash with ours), and a hash of
    its text, which orders rows of one id and size."""
    row = [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__doc"), F.xxhash64("text").alias("__t")] if whole else []
    return docs.select(
        "doc_id", "source", F.regexp_count(F.coalesce(F.col("text"), F.lit("")), F.lit(WORD)).cast("long").alias("size"),
        order_key(F.col("doc_id"), F.col("text")).alias("__h"), *row)


def targets(sizes: DataFrame) -> DataFrame:
    """One row per source: source, source_size, weight, target (double), block (words)."""
    src = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name, one = Window.orderBy(F.asc_nulls_last("source")), Window.partitionBy()
    weights = F.array(*map(F.lit, WEIGHTS))
    src = src.withColumn("rank", F.row_number().over(by_name))
    src = src.withColumn("weight", F.element_at(weights, (F.col("rank") - 1) % len(WEIGHTS) + 1).cast("long"))
    # fill by rising size per weight: before a source, smaller ones are full; it and the rest share
    up = Window.orderBy(F.col("source_size") / F.col("weight"), "rank")
    src = (src.withColumn("total", F.sum("source_size").over(one))
           .withColumn("left", F.col("total") - F.coalesce(F.sum(F.col("source_size") * LIMIT).over(
               up.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
           .withColumn("sharing", F.sum("weight").over(up.rowsBetween(0, Window.unboundedFollowing)))
           .withColumn("full", (F.col("source_size") * LIMIT).cast("decimal(38,0)") * F.col("sharing")
                       <= F.col("weight").cast("decimal(38,0)") * F.col("left")))
    src = src.withColumn("k", F.row_number().over(up))
    src = src.withColumn("__k", F.when(~F.col("full"), F.struct("k", "left", "sharing")))
    src = src.withColumn("level", F.min("__k").over(one)).withColumn("cap", (F.col("source_size") * LIMIT).cast("double"))
    share = (F.col("weight") * F.col("level.left")).cast("double") / F.col("level.sharing")
    return src.select("source", "rank", "source_size", "weight",
                      F.when(F.col("full") | F.col("level").isNull(), F.col("cap")).otherwise(
                          F.least("cap", share)).alias("target"),
                      F.greatest(F.lit(1), F.least(F.lit(BLOCK), F.expr(f"source_size div {LEAST_BLOCKS}"))).cast("long")
                      .alias("block"))


def quotas(src: DataFrame) -> DataFrame:
    """`src` with blocks (of the source) and quota (seats): Sainte-Laguë over as many seats as the
    targets hold blocks.  Near the ideal share only a few seats of a source can be in doubt; those
    compete by quotient (ties: the earlier source), at most about three a source on average."""
    one = Window.partitionBy()
    v = (src.withColumn("blocks", F.expr("(source_size + block - 1) div block"))
         .withColumn("ideal", F.col("target") / F.col("block"))
         .withColumn("house", F.round(F.sum("ideal").over(one)).cast("long"))
         .withColumn("sum", F.sum("ideal").over(one))
         .withColumn("n", F.count(F.lit(1)).over(one)))
    near = F.floor(F.when(F.col("sum") > 0, F.col("ideal") * F.col("house") / F.col("sum")).otherwise(F.lit(0.0)) + 0.5)
    slack = (F.ceil(F.when(F.col("sum") > 0, F.col("ideal") * 2 * F.col("n") / F.col("sum")).otherwise(F.lit(0.0))) + 2)
    v = (v.withColumn("most", F.col("blocks") * LIMIT)
         .withColumn("sure", F.least("most", F.greatest(F.lit(0), near - slack)).cast("long"))
         .withColumn("last", F.least("most", near + slack).cast("long"))
         .withColumn("taken", F.sum("sure").over(one)))
    seats = v.select("rank", "house", "taken", "ideal",
                     F.explode(F.when(F.col("last") > F.col("sure"), F.sequence(F.col("sure") + 1, F.col("last")))).alias("seat"))
    best = Window.orderBy(F.desc(F.col("ideal") / (F.col("seat") - 0.5)), "rank", "seat")
    won = (seats.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= F.col("house") - F.col("taken"))
           .groupBy(F.col("rank").alias("__r")).agg(F.count(F.lit(1)).alias("won")))
    return v.join(won, F.col("rank") == F.col("__r"), "left").select(
        "source", "rank", "source_size", "weight", "target", "block", "blocks",
        (F.col("sure") + F.coalesce("won", F.lit(0))).cast("long").alias("quota"))


def times_taken(i: str, blocks: str = "blocks", quota: str = "quota", rank: str = "rank") -> str:
    """SQL for how often block number `i` of a source is taken: its shard's quota spread evenly, the
    rest to the first blocks of the shard's seeded permutation."""
    h, whole = f"({i} % {SHARDS})", f"({blocks} // {SHARDS})"
    n = f"(({blocks} + {SHARDS - 1} - {h}) // {SHARDS})"
    upto = lambda x: f"(({x}) * {whole} + least({x}, {blocks} % {SHARDS}))"  # noqa: E731  blocks of the first x shards
    # quota * blocks so far would pass 64 bits only beyond 3 * 10**9 blocks of a source
    q = (f"(({quota} * {upto(f'{h} + 1')}) // {blocks} - ({quota} * {upto(h)}) // {blocks})")
    step = f"(CASE WHEN {n} % {STEPS[0]} <> 0 THEN {STEPS[0]} WHEN {n} % {STEPS[1]} <> 0 THEN {STEPS[1]} ELSE {STEPS[2]} END)"
    place = f"(({step} * ({i} // {SHARDS}) + 7919 * ({h} + {rank})) % {n})"
    return f"({q} // {n} + CASE WHEN {place} < {q} % {n} THEN 1 ELSE 0 END)"


def _spark(sql: str) -> str:
    return sql.replace("//", "div")


def planned(docs: DataFrame) -> DataFrame:
    """`docs`, as `sized` gives them, with source_size, target, and what the plan needs: __start (words
    of the source before the document), block, blocks, quota, rank.

    Positions in a source come from sums of (source, bucket of the order key) and a running sum
    inside one bucket; buckets hold about ROWS_A_BUCKET rows, so a source with a third of all rows
    is spread over as many tasks as any other data of that size."""
    sizes = stored(docs, "mix-sizes")
    rows = sizes.count()
    digits = min(7, max(0, math.ceil(math.log(max(1, rows / ROWS_A_BUCKET), 16))))
    sizes = sizes.withColumn("__b", F.substring("__h", 1, digits) if digits else F.lit(""))
    # the source's own partial sums, reduced before the shuffle
    sums = sizes.groupBy("source", "__b").agg(F.sum("size").alias("s"))
    before = sums.select(F.col("source").alias("__s"), F.col("__b").alias("__sb"), (F.sum("s").over(
        Window.partitionBy("source").orderBy("__b")) - F.col("s")).alias("before"))
    src = quotas(targets(sizes)).select(F.col("source").alias("__src"), "rank", "source_size", "target", "block",
                                        "blocks", "quota")
    last = ["__t"] if "__t" in sizes.columns else []
    inside = Window.partitionBy("source", "__b").orderBy("__h", F.asc_nulls_first("doc_id"), "size", *last)
    out = sizes.withColumn("__in", F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"))
    out = out.join(before, F.col("source").eqNullSafe(F.col("__s")) & (F.col("__b") == F.col("__sb")))
    out = out.join(src, F.col("source").eqNullSafe(F.col("__src")))
    return out.withColumn("__start", F.col("before") + F.col("__in")).drop("__s", "__sb", "__src", "before", "__in", "__b", "__h", "__t")


def spans() -> Column:
    """Array of {from, to, times}: the document's words [from, to) by block, with the block's times."""
    return F.expr(_spark(f"""CASE WHEN size > 0 THEN transform(
        sequence(__start // block, (__start + size - 1) // block),
        i -> struct(greatest(i * block, __start) - __start AS `from`,
                    least((i + 1) * block, __start + size) - __start AS `to`,
                    {times_taken('i')} AS times)) ELSE array() END"""))


TAKEN = ("aggregate(__spans, 0L, (a, s) -> a + (s.`to` - s.`from`) * s.times)")


def mix_plan(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, taken.

    Sources are ordered by code point (null: a source, last).  Null ids and repeated rows are
    documents of their own; empty texts have size 0 and give nothing; an empty table gives an
    empty result.  The same table gives the same rows on every run."""
    p = planned(sized(docs))
    return p.withColumn("__spans", spans()).select("doc_id", "source", "size", "source_size", "target",
                                                   F.expr(TAKEN).cast("long").alias("taken"))


def mixed(docs: DataFrame) -> DataFrame:
    """The mixture itself, with the columns of `docs`: a document once for each pass that takes some
    of it (LIMIT passes at most).  A pass that takes all its words gives the text unchanged, else
    the text is cut to the words taken (their own spacing kept, cuts joined by a line break);
    n_chars, if there, is that of the new text."""
    p = planned(sized(docs, whole=True)).withColumn("__spans", spans())
    passes = p.withColumn("__pass", F.explode(F.sequence(F.lit(1), F.lit(LIMIT))))
    own = F.filter("__spans", lambda s: s["times"] >= F.col("__pass"))
    got = F.aggregate("__own", F.lit(0).cast("long"), lambda a, s: a + s["to"] - s["from"])
    passes = passes.withColumn("__own", own).withColumn("__got", got).filter("__got > 0")
    ends = F.transform("__own", lambda s: s["from"]), F.transform("__own", lambda s: s["to"])
    # a null text in place of one that is taken whole, so that it need not travel to Python
    cut = F.arrow_udf(_cut, "string")(F.when(F.col("__got") < F.col("size"), F.col("__doc.text")), *ends)
    out = passes.withColumn("__text", cut).withColumn("__text", F.coalesce("__text", "__doc.text"))
    changed = {"text": F.col("__text")}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.length("__text").cast(docs.schema["n_chars"].dataType)
    return out.select(*[changed.get(c, F.col(f"__doc.`{c}`")).alias(c) for c in docs.columns])


def _cut(texts: pa.Array, starts: pa.Array, stops: pa.Array) -> pa.Array:
    return pa.array([None if t is None else cut_words(t, a, b)
                     for t, a, b in zip(texts.to_pylist(), starts.to_pylist(), stops.to_pylist())], pa.string())


def cut_words(text: str, starts: list[int], stops: list[int]) -> str:
    """The words [start, stop) of a text, for rising ranges; touching ranges are one."""
    at = [m.span() for m in re.finditer(WORD, text)]
    runs: list[list[int]] = []
    for a, b in zip(starts, stops):
        if runs and runs[-1][1] == a:
            runs[-1][1] = b
        else:
            runs.append([a, b])
    return "\n".join(text[at[a][0]:at[b - 1][1]] for a, b in runs if b > a)


def sql() -> str:
    """The same plan in SQL, for checking."""
    w = f"[{', '.join(map(str, WEIGHTS))}]"
    return f"""
WITH s AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
                  substr(md5('{SEED} ' || coalesce(CAST(doc_id AS VARCHAR), 'null ' || md5(coalesce(text, '')))), 1, 15) AS h
             FROM documents),
     a AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM s GROUP BY source),
     b AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS rank FROM a),
     c AS (SELECT *, CAST({w}[(rank - 1) % {len(WEIGHTS)} + 1] AS BIGINT) AS weight FROM b),
     d AS (SELECT *, row_number() OVER u AS k, CAST(sum(source_size) OVER () - coalesce(sum(source_size * {LIMIT}) OVER
                  (ORDER BY source_size / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS rest,
                  CAST(sum(weight) OVER (ORDER BY source_size / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
                       AS BIGINT) AS sharing
             FROM c WINDOW u AS (ORDER BY source_size / weight, rank)),
     e AS (SELECT *, source_size * {LIMIT} * sharing <= weight * rest AS filled FROM d),
     f AS (SELECT rest AS l_rest, sharing AS l_sharing FROM e WHERE NOT filled ORDER BY k LIMIT 1),
     g AS (SELECT source, rank, source_size, CASE WHEN filled OR l_rest IS NULL THEN CAST(source_size * {LIMIT} AS DOUBLE)
                  ELSE least(CAST(source_size * {LIMIT} AS DOUBLE), CAST(weight * l_rest AS DOUBLE) / l_sharing) END AS target,
                  greatest(1, least({BLOCK}, source_size // {LEAST_BLOCKS})) AS block
             FROM e LEFT JOIN f ON true),
     v AS (SELECT *, (source_size + block - 1) // block AS blocks, target / block AS ideal FROM g),
     x AS (SELECT *, row_number() OVER (ORDER BY ideal / (seat - 0.5) DESC, rank, seat) AS place
             FROM (SELECT rank, ideal, unnest(range(1, CAST(blocks * {LIMIT} + 1 AS BIGINT))) AS seat FROM v)),
     y AS (SELECT rank, count(*) AS quota FROM x WHERE place <= (SELECT CAST(round(sum(ideal)) AS BIGINT) FROM v) GROUP BY rank),
     z AS (SELECT v.*, coalesce(quota, 0) AS quota FROM v LEFT JOIN y USING (rank)),
     p AS (SELECT *, CAST(sum(size) OVER (PARTITION BY source ORDER BY h, doc_id NULLS FIRST, size
                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - size AS BIGINT) AS start FROM s)
SELECT doc_id, size, source_size, target,
       CAST(CASE WHEN size > 0 THEN list_sum(list_transform(range(start // block, (start + size - 1) // block + 1), lambda i:
            (least((i + 1) * block, start + size) - greatest(i * block, start)) * {times_taken('i')})) ELSE 0 END AS BIGINT) AS taken
  FROM p JOIN z ON p.source IS NOT DISTINCT FROM z.source"""
