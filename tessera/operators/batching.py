"""Batched text jobs on executors: greedy batching under two limits, fixed-size
chunks, prompt rows, scoring through a supplied function with bounded
retries, answer parsing, length checks and positional un-batching.

Determinism without a global sort: rows are spread over `shards` by their id and
ordered inside a shard, so batch numbers do not depend on partitioning or Arrow
batch sizes.  Whole-number ids go by ``pmod(id, shards)`` and are ordered by id;
ids of any other type go by a hash and are ordered by it (a null id is in shard
0).  Each batch is then keyed by (shard, batch) and every later step is a join /
group by on that key.  `shards` is the caller's choice (``shards_for``): greedy
batches are sequential inside a shard.
"""
from __future__ import annotations

import json
import time
from typing import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Service limits used for batching.
MAX_ITEMS = 900
MAX_CHARS = 45000
CHUNK_SIZE = 20

MEMBERS = 1000  # members in one array of a group
ANSWERS_A_FRAME = 32  # answered requests that a Python worker holds and gives back at once


def shards_for(rows: int, rows_per_shard: int = 1_000_000) -> int:
    """A number of shards that grows with the data."""
    return max(1, -(-rows // rows_per_shard))


def whole_numbers(df: DataFrame, id_col: str) -> bool:
    return isinstance(df.schema[id_col].dataType, T.IntegralType)


def id_hash(id_col: str) -> Column:
    """32 bits of an id of any type, as a long."""
    return F.conv(F.substring(F.md5(F.col(id_col).cast("string")), 1, 8), 16, 10).cast("long")


def shard_of(df: DataFrame, id_col: str, shards: int) -> Column:
    n = F.col(id_col) if whole_numbers(df, id_col) else id_hash(id_col)
    return F.coalesce(F.pmod(n, F.lit(shards)).cast("int"), F.lit(0))


def greedy_batches(df: DataFrame, id_col: str, text_col: str, max_items: int = MAX_ITEMS,
                   max_chars: int = MAX_CHARS, *, shards: int) -> DataFrame:
    """Assign (shard, batch) so that each batch holds <= max_items texts and <= max_chars
    characters, filling batches greedily in id order inside a shard.  A text longer than
    max_chars gets a batch of its own (no empty batch is emitted).

    Sequential by nature, so one shard is scanned by one task in id order with O(1)
    state (``mapInPandas`` over a partition sorted by (shard, id)); the state is carried
    across Arrow batches and reset when the shard changes.
    """
    order = F.col(id_col) if whole_numbers(df, id_col) else F.md5(F.col(id_col).cast("string"))
    kind = df.schema[id_col].dataType.simpleString()
    base = df.select(F.col(id_col).alias("_id"), order.alias("_order"), F.length(F.col(text_col)).alias("_len"),
                     shard_of(df, id_col, shards).alias("shard")).filter(F.col("_len").isNotNull())
    part = base.repartition(shards, "shard").sortWithinPartitions("shard", "_order", "_id", "_len").drop("_order")

    def scan(it):
        cur_shard, batch, cnt, chars = None, -1, 0, 0
        for pdf in it:
            out_b = []
            for sh, ln in zip(pdf["shard"].to_numpy(), pdf["_len"].to_numpy()):
                if sh != cur_shard:
                    cur_shard, batch, cnt, chars = sh, 0, 1, int(ln)
                elif cnt + 1 > max_items or chars + ln > max_chars:
                    batch, cnt, chars = batch + 1, 1, int(ln)
                else:
                    cnt, chars = cnt + 1, chars + int(ln)
                out_b.append(batch)
            yield pd.DataFrame({"_id": pdf["_id"], "shard": pdf["shard"], "batch": out_b,
                                "_len": pdf["_len"]})

    out = part.mapInPandas(scan, f"_id {kind}, shard int, batch int, _len int")
    return out.select(F.col("_id").alias(id_col), "shard", "batch", F.col("_len").alias("n_chars"))


ROWS_A_BUCKET = 8192
MARKS = 1000  # percentiles from which the bounds of buckets are taken


# --- the same batches without one task a shard -----------------------------------------------------

BLOCK_ROWS = 65536      # consecutive rows of a shard whose batches one task works out
BLOCKS_A_GROUP = 1024   # blocks whose jump tables are composed into one


def next_starts(lengths: np.ndarray, max_items: int, max_chars: int) -> np.ndarray:
    """For each row: the row after the batch that starts there."""
    sums = np.concatenate([[0], np.cumsum(lengths)])
    at = np.arange(len(lengths))
    full = np.searchsorted(sums, sums[:-1] + max_chars, "right") - 1  # rows that fit
    return np.minimum(np.maximum(full, at + 1), at + max_items)


def jump_table(lengths: np.ndarray, own: int, entries: int, max_items: int, max_chars: int) -> tuple[np.ndarray, np.ndarray]:
    """For a first batch at each of the first `entries` rows of a block of `own` rows (followed by some of the
    next block): where in the next block the first batch starts, and how many batches start here.  Every
    jump is doubled until it leaves the block."""
    to = next_starts(lengths, max_items, max_chars)[:own]
    count = np.ones(own, np.int64)
    while (inside := to < own).any():
        count[inside] += count[to[inside]]
        to = np.where(inside, to[np.minimum(to, own - 1)], to)
    n = min(entries, own)
    exits, counts = np.zeros(entries, np.int64), np.zeros(entries, np.int64)
    exits[:n], counts[:n] = to[:n] - own, count[:n]
    return exits, counts


def compose(tables: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """One jump table for a row of blocks."""
    at, total = np.arange(len(tables[0][0])), np.zeros(len(tables[0][0]), np.int64)
    for exits, counts in tables:
        at, total = exits[at], total + counts[at]
    return at, total


def greedy_batches_blocks(df: DataFrame, id_col: str, text_col: str, max_items: int = MAX_ITEMS, max_chars: int = MAX_CHARS,
                          *, shards: int = 1, rows_a_block: int = BLOCK_ROWS, blocks_a_group: int = BLOCKS_A_GROUP) -> DataFrame:
    """The batches of ``greedy_batches``, worked out in parallel inside a shard.

    A batch that starts at a row ends where one of the limits is met, so the next start follows from prefix
    sums.  Blocks of consecutive rows (each with the first `max_items` rows of the next one, as far as a
    batch can reach) turn that into a table: entered at this row, the block is left at that row of the next
    one.  Tables of many blocks compose into one; walking the groups, then the blocks of each group in
    parallel, gives every block its first start and batch number, and the blocks mark their batches.
    `rows_a_block` is raised to 2 * max_items; no task holds more than a block, a group of tables or the
    groups' tables of a shard."""
    rows_a_block = max(rows_a_block, 2 * max_items)
    kind = df.schema[id_col].dataType.simpleString()
    base = df.select(F.col(id_col).alias("_id"), F.length(F.col(text_col)).alias("_len")).filter(F.col("_len").isNotNull())
    order = None if whole_numbers(df, id_col) else F.md5(F.col("_id").cast("string"))
    ranked = rank_in_shard(base, "_id", shards, ties=[F.col("_len")] if order is None else [order, F.col("_id"), F.col("_len")])
    from tessera.session import materialize
    rows = materialize(ranked.select("_id", "_len", "shard", F.col("_rn").cast("long").alias("pos")))
    block = F.floor(F.col("pos") / rows_a_block).cast("long")
    near = F.pmod("pos", F.lit(rows_a_block)) < max_items  # the block before needs these rows, too
    both = F.when(near & (block > 0), F.array(block, block - 1)).otherwise(F.array(block))
    dealt = rows.withColumn("block", F.explode(both)).select(F.col("shard").alias("s"), F.col("block").alias("b"), "pos", "_len")

    def table(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("pos")
        b = int(pdf["b"].iloc[0])
        own = int((pdf["pos"] < (b + 1) * rows_a_block).sum())
        exits, counts = jump_table(pdf["_len"].to_numpy(), own, max_items, max_items, max_chars)
        return pd.DataFrame({"s": pdf["s"].iloc[:1], "b": [b], "exits": [exits], "counts": [counts]})

    tables = materialize(dealt.groupBy("s", "b").applyInPandas(table, "s int, b long, exits array<long>, counts array<long>")
                         .withColumn("g", F.floor(F.col("b") / blocks_a_group).cast("long")))

    def of(pdf: pd.DataFrame, by: str) -> list[tuple[np.ndarray, np.ndarray]]:
        return [(np.asarray(r.exits), np.asarray(r.counts)) for r in pdf.sort_values(by).itertuples()]

    def whole(pdf: pd.DataFrame) -> pd.DataFrame:
        exits, counts = compose(of(pdf, "b"))
        return pd.DataFrame({"s": pdf["s"].iloc[:1], "g": pdf["g"].iloc[:1], "exits": [exits], "counts": [counts]})

    def walk(pdf: pd.DataFrame, by: str, at: int, total: int) -> pd.DataFrame:
        pdf, first, before = pdf.sort_values(by), [], []
        for exits, counts in of(pdf, by):
            first.append(at)
            before.append(total)
            at, total = int(exits[at]), total + int(counts[at])
        return pd.DataFrame({"s": pdf["s"], by: pdf[by], "at": first, "before": before})

    groups = tables.groupBy("s", "g").applyInPandas(whole, "s int, g long, exits array<long>, counts array<long>")
    starts = groups.groupBy("s").applyInPandas(lambda pdf: walk(pdf, "g", 0, 0), "s int, g long, at long, before long")
    entries = tables.join(starts, ["s", "g"]).groupBy("s", "g").applyInPandas(
        lambda pdf: walk(pdf, "b", int(pdf["at"].iloc[0]), int(pdf["before"].iloc[0])), "s int, b long, at long, before long")

    def mark(key, mine: pd.DataFrame, entry: pd.DataFrame) -> pd.DataFrame:
        mine = mine.sort_values("pos")
        to, pos = next_starts(mine["_len"].to_numpy(), max_items, max_chars), int(entry["at"].iloc[0])
        begins = np.zeros(len(mine), np.int64)
        while pos < len(mine):  # one step a batch
            begins[pos], pos = 1, int(to[pos])
        number = int(entry["before"].iloc[0]) + np.cumsum(begins) - 1
        return pd.DataFrame({"_id": mine["_id"], "shard": mine["shard"], "batch": number, "_len": mine["_len"]})

    mine = rows.withColumn("block", block)
    out = mine.groupBy("shard", "block").cogroup(entries.groupBy("s", "b")).applyInPandas(mark, f"_id {kind}, shard int, batch int, _len int")
    return out.select(F.col("_id").alias(id_col), "shard", "batch", F.col("_len").alias("n_chars"))


def in_buckets(df: DataFrame, rows_a_bucket: int) -> DataFrame:
    """`df` with ``_bkt``, a bucket of about `rows_a_bucket` rows that rises with the whole number ``_o`` (null: the first).

    Bounds are approximate percentiles (one row of metadata), so far or crowded numbers change no bucket's share; a
    number finds its place among them by halving.  Rows for more than MARKS buckets are cut again inside
    each, by equal widths."""
    at = ", ".join(f"{i / MARKS!r}D" for i in range(MARKS + 1))
    n, marks = df.agg(F.count(F.lit(1)), F.expr(f"percentile_approx(_o, array({at}), {10 * MARKS})")).first()
    buckets = max(1, -(-n // rows_a_bucket))
    few, parts = min(MARKS, buckets), -(-buckets // MARKS)
    bounds = sorted({marks[k * MARKS // few] for k in range(few + 1)}) if marks else [0]
    table = F.split(F.lit(",".join(map(str, bounds))), ",").cast("array<long>")  # a constant of the plan
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(len(bounds).bit_length()))])
    d = df.withColumn("_bkt", F.aggregate(steps, F.lit(0), lambda below, step: F.when(
        F.get(table, below + step - 1) < F.col("_o"), below + step).otherwise(below)).cast("long"))
    if parts == 1:
        return d
    low, high = (F.get(table, (F.col("_bkt") - k).cast("int")).cast("double") for k in (1, 0))
    part = F.least(F.floor((F.col("_o") - low) / (high - low) * parts), F.lit(parts - 1))
    return d.withColumn("_bkt", F.col("_bkt") * parts + F.when(low < high, part).otherwise(0))


def rank_in_group(df: DataFrame, group: str, id_col: str, rows_a_bucket: int = ROWS_A_BUCKET,
                  ties: list[Column] | None = None) -> DataFrame:
    """`df` with ``_rn``, the 0-based position of each row inside its group (null: a group), computed in
    parallel: rows are in buckets that follow the order (whole-number ids, else the id's hash; ``in_buckets``),
    a small table of counts per (group, bucket) gives each bucket's starting offset, and ``row_number`` runs only
    inside one bucket, so no task ever sorts a whole group.  The rows are moved once: the offsets come to the
    tasks that number them (a struct, as a null group joins itself in one).  Deterministic: positions
    depend neither on the bounds nor on partitioning.  `ties` orders rows of equal hash or id (default: the id)."""
    order = F.col(id_col) if whole_numbers(df, id_col) else id_hash(id_col)
    d = in_buckets(df.withColumns({"_o": order.cast("long"), "_g": F.struct(F.col(group))}), rows_a_bucket)
    counts = d.groupBy("_g", "_bkt").agg(F.count(F.lit(1)).alias("_n"))
    wo = Window.partitionBy("_g").orderBy("_bkt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(F.col("_g").alias("_s"), F.col("_bkt").alias("_b"),
                            F.coalesce(F.sum("_n").over(wo), F.lit(0)).alias("_off"))
    wb = Window.partitionBy("_g", "_bkt").orderBy("_o", *(ties or [F.col(id_col)]))
    r = d.withColumn("_rb", F.row_number().over(wb) - 1)
    return r.join(offsets, (F.col("_g") == F.col("_s")) & (F.col("_bkt") == F.col("_b"))) \
        .withColumn("_rn", F.col("_off") + F.col("_rb")).drop("_o", "_g", "_bkt", "_s", "_b", "_off", "_rb")


def rank_in_shard(df: DataFrame, id_col: str, shards: int, rows_a_bucket: int = ROWS_A_BUCKET,
                  ties: list[Column] | None = None) -> DataFrame:
    """`rank_in_group` over the shards of the ids: adds shard and ``_rn``."""
    return rank_in_group(df.withColumn("shard", shard_of(df, id_col, shards)), "shard", id_col, rows_a_bucket, ties)


def member_arrays(df: DataFrame, key: str, member: str, size: int = MEMBERS) -> DataFrame:
    """The members of every group as arrays: one row per group and part with key, part (0-based), n_members, n_rows
    (rows of these members) and members (distinct, in order).  A group has as many parts as it needs: all hold
    `size` members but the last, so groups may be ragged and of any size.

    Order: whole numbers rise, other types follow their hash.  A null group is a group; null members are left out (a
    group of nulls only has no row), repeated rows are reduced map-side; an empty table gives an empty result."""
    from tessera.session import materialize
    own = df.filter(F.col(member).isNotNull()).groupBy(F.col(key).alias("_key"), F.col(member).alias("_member")).agg(
        F.count(F.lit(1)).alias("_rows"))
    d = rank_in_group(materialize(own), "_key", "_member")
    g = d.groupBy("_key", F.floor(F.col("_rn") / size).cast("long").alias("part")).agg(
        F.array_sort(F.collect_list(F.struct("_rn", "_member"))).alias("_all"), F.sum("_rows").alias("n_rows"))
    return g.select(F.col("_key").alias(key), "part", F.size("_all").cast("long").alias("n_members"), "n_rows",
                    F.transform("_all", lambda x: x["_member"]).alias("members"))


def chunk(df: DataFrame, id_col: str, size: int = CHUNK_SIZE, *, shards: int) -> DataFrame:
    """Fixed-size chunks in order inside each shard: adds shard, batch, pos (0-based)."""
    d = rank_in_shard(df, id_col, shards)
    return d.withColumns({"batch": F.floor(F.col("_rn") / size).cast("int"),
                          "pos": F.pmod(F.col("_rn"), F.lit(size)).cast("int")}).drop("_rn")


def chat_messages(system: str, user: Column) -> Column:
    """array<struct<role, content, name>>: a system instruction and one user message."""
    return F.array(F.struct(F.lit("system").alias("role"), F.lit(system).alias("content"), F.lit(None).cast("string").alias("name")),
                   F.struct(F.lit("user").alias("role"), user.alias("content"), F.lit(None).cast("string").alias("name")))


def batch_prompts(chunked: DataFrame, id_col: str, text_col: str, instruction: str) -> DataFrame:
    """One row per (shard, batch): ordered items and the chat messages whose user content is
    the instruction followed by the JSON array of the batch texts.  Groups hold at most one
    chunk, so their size is bounded by the chunk size."""
    g = chunked.groupBy("shard", "batch").agg(
        F.sort_array(F.collect_list(F.struct("pos", F.col(id_col).alias("id"), F.col(text_col).alias("text")))).alias("items"))
    user = F.concat(F.lit(instruction), F.to_json(F.transform("items", lambda x: x["text"])))
    return g.withColumns({"n_items": F.size("items"), "messages": chat_messages(instruction.split("\n")[0], user)})


def parse_scores(answer: Column) -> Column:
    """JSON array of numbers -> array<double>; NULL or malformed text -> NULL."""
    return F.from_json(answer, T.ArrayType(T.DoubleType()))


def check_answers(scored: DataFrame, answer_col: str = "answer") -> tuple[DataFrame, DataFrame]:
    """(accepted, rejects).  A batch is accepted when its parsed scores have exactly one value
    per item, or when the service answered NULL (its items keep NULL scores).  Rejects carry a
    reason: 'failed' (the call failed; with its ``error``), 'malformed' or 'length'."""
    s = scored.withColumn("scores", parse_scores(F.col(answer_col)))
    calls = "error" in scored.columns
    failed = F.col("error").isNotNull() if calls else F.lit(False)
    ok = ~failed & (F.col(answer_col).isNull() | F.coalesce(F.size("scores") == F.col("n_items"), F.lit(False)))
    reason = F.when(failed, "failed").when(F.col("scores").isNull(), "malformed").otherwise("length")
    return s.filter(ok), s.filter(~ok).select("shard", "batch", "n_items", reason.alias("reason"), *["error"] * calls)


def unbatch(accepted: DataFrame, out_col: str = "score") -> DataFrame:
    """Positional un-batching: the i-th score goes to the i-th item."""
    z = accepted.select("shard", "batch", F.posexplode("items").alias("_i", "item"), "scores")
    return z.select(F.col("item.id").alias("id"), F.col("item.text").alias("text"),
                    F.try_element_at(F.col("scores"), F.col("_i") + 1).alias(out_col))


def score_batches(prompts: DataFrame, fn: Callable[[pd.DataFrame], pd.Series], retries: int = 3,
                  wait_seconds: float = 0.0, most_wait: float = 300.0) -> DataFrame:
    """Call `fn` (pandas frame of prompt rows -> series of answer strings) on executors, one
    request per prompt row.  A failing request is tried up to `retries` times (waits between
    them start at `wait_seconds` and double up to `most_wait`), then the prompt gets a NULL answer and the last error text in ``error``; nothing is gathered on
    the driver.  Adds ``answer``, ``error``, ``attempts``.  A task that Spark runs again calls the
    service again for its prompts: store the result (``materialize``) before using it twice."""
    schema = T.StructType(prompts.schema.fields + [T.StructField("answer", T.StringType()),
                                                   T.StructField("error", T.StringType()),
                                                   T.StructField("attempts", T.IntegerType())])

    def call(one: pd.DataFrame):
        err, n = None, 0
        for n in range(1, retries + 1):
            try:
                return list(fn(one))[0], None, n
            except Exception as e:  # noqa: BLE001 - any service failure is reported per prompt
                err = f"{type(e).__name__}: {e}"
                if wait_seconds and n < retries:
                    time.sleep(min(most_wait, wait_seconds * 2 ** (n - 1)))
        return None, err, n

    def run(it):
        for pdf in it:
            for at in range(0, len(pdf), ANSWERS_A_FRAME):
                few = pdf.iloc[at:at + ANSWERS_A_FRAME]
                res = [call(few.iloc[[i]].reset_index(drop=True)) for i in range(len(few))]
                yield few.assign(answer=[r[0] for r in res], error=[r[1] for r in res], attempts=[r[2] for r in res])
            pdf = few = None  # else they stay while the next frame is made

    return prompts.mapInPandas(run, schema)


# --- default scorer: weighted defect terms -------------------------------------------------

# Defect vocabulary and weights of the default review scorer.
DEFECT_TERMS = {
    "broken": 0.4, "defect": 0.4, "damaged": 0.3, "error": 0.2, "fail": 0.3, "bad": 0.1,
    "cassé": 0.4, "défaut": 0.4, "kaputt": 0.4, "fehler": 0.3, "roto": 0.4, "defecto": 0.4,
}


def term_score_expr(text: Column) -> Column:
    """Weighted count of defect terms in the lower-cased text, clipped to [0, 1]."""
    low = F.lower(text)
    total = None
    for term, w in DEFECT_TERMS.items():
        occ = (F.length(low) - F.length(F.replace(low, F.lit(term), F.lit("")))) / len(term)
        part = occ * w
        total = part if total is None else total + part
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), total))


def term_scorer(pdf: pd.DataFrame) -> pd.Series:
    """Default scoring function for ``score_batches``: one JSON array of scores per prompt,
    computed from the prompt's items with the weighted defect terms."""
    out = []
    for items in pdf["items"]:
        scores = []
        for it in items:
            low = (it["text"] or "").lower()
            s = sum(low.count(t) * w for t, w in DEFECT_TERMS.items())
            scores.append(min(1.0, max(0.0, s)))
        out.append(json.dumps(scores))
    return pd.Series(out)


def defect_scores(df: DataFrame, id_col: str, text_col: str, scorer: Callable = term_scorer,
                  instruction: str = "Score each review for product defects from 0 to 1.\n",
                  size: int = CHUNK_SIZE, *, shards: int) -> tuple[DataFrame, DataFrame]:
    """Reviews -> (id, review, defect_score) and the rejected batches (failed calls with their
    error, malformed answers, answers of the wrong length)."""
    texts = df.filter(F.col(text_col).isNotNull()).select(id_col, text_col)
    prompts = batch_prompts(chunk(texts, id_col, size, shards=shards), id_col, text_col, instruction)
    # the scored prompts feed both the accepted rows and the rejects: write them once so the
    # (possibly remote, paid) scorer is never called twice for a batch
    from tessera.session import materialize
    scored = materialize(score_batches(prompts, scorer))
    ok, rejects = check_answers(scored)
    res = unbatch(ok, "defect_score").select(F.col("id").alias(id_col), F.col("text").alias("review"), "defect_score")
    return res, rejects
