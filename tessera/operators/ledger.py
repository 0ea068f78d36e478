"""Service jobs that can be resumed: answers are kept in a ledger by the content they answer.

The ledger is a Parquet table (key, answer, error, run) in shared storage; a key is the SHA-256 of a text, and a
row without an answer notes what failed in a run.
A job sends the distinct texts that have no answer yet (an anti join), in waves: every wave is
one write, so a job that is killed has lost the wave in flight at most, and the next run goes
on with what is missing.  A text is sent once however many rows, columns or runs hold it.
"""
from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.arrays import first_translation
from tessera.operators.batching import MAX_CHARS, MAX_ITEMS, greedy_batches, score_batches, shards_for
from tessera.session import materialize

SCHEMA = "key string, answer string, error string, run string"
WAVE = 100_000  # texts of a wave, about


def text_key(col: str):
    return F.sha2(F.col(col).cast("string"), 256)


class Ledger:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def rows(self) -> DataFrame:
        where = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
        if not where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(where):
            return self.spark.createDataFrame([], SCHEMA)
        return self.spark.read.schema(SCHEMA).parquet(self.path)

    def answers(self) -> DataFrame:
        """(key, answer), one row a key (two runs at once may have answered one text twice)."""
        return self.rows().filter(F.col("answer").isNotNull()).groupBy("key").agg(F.min("answer").alias("answer"))

    def failures(self, run: str) -> DataFrame:
        """(key, error) of the texts that a run got no answer for."""
        return self.rows().filter((F.col("run") == run) & F.col("answer").isNull()).select("key", "error")

    def append(self, rows: DataFrame, run: str) -> None:
        rows.select("key", "answer", "error", F.lit(run).alias("run")).write.mode("append").parquet(self.path)


def distinct_texts(df: DataFrame, cols: list[str]) -> DataFrame:
    """(key, text) of the different non-null texts of all columns together."""
    out = None
    for c in cols:
        one = df.select(text_key(c).alias("key"), F.col(c).cast("string").alias("text")).filter(F.col("text").isNotNull())
        out = one if out is None else out.unionByName(one)
    return out.groupBy("key").agg(F.first("text").alias("text"))


def requests(texts: DataFrame, max_items: int, max_chars: int, shards: int) -> DataFrame:
    """(shard, batch, items) under the service's two limits; items: id (the key) and text."""
    place = greedy_batches(texts, "key", "text", max_items, max_chars, shards=shards).select(
        F.col("key").alias("_k"), "shard", "batch")
    placed = texts.join(place, texts["key"] == place["_k"])
    return placed.groupBy("shard", "batch").agg(F.sort_array(F.collect_list(F.struct(F.col("key").alias("id"), "text"))).alias("items"))


def answer_missing(df: DataFrame, cols: list[str], call: Callable, ledger: Ledger, *, parse: Callable, max_items: int = MAX_ITEMS,
                   max_chars: int = MAX_CHARS, retries: int = 3, wait_seconds: float = 0.0, wave: int = WAVE) -> DataFrame:
    """Send every text of `cols` that the ledger does not answer, wave by wave; returns the failures of this run
    (key, error), whose texts stay unanswered and are sent again by the next run.

    `call` gets one request (see ``score_batches``), `parse` turns its answer text into an array with one string
    an item; an item without one (an answer that is malformed or too short) counts as failed."""
    open_ = materialize(distinct_texts(df, cols).join(ledger.answers().select("key"), "key", "left_anti"))
    n = open_.count()
    waves, run = max(1, -(-n // wave)), uuid.uuid4().hex
    for w in range(waves):
        part = open_.filter(F.pmod(F.xxhash64("key"), F.lit(waves)) == w)
        sent = score_batches(requests(part, max_items, max_chars, shards_for(min(n, wave), 20_000)), call, retries, wait_seconds)
        each = sent.select("error", F.posexplode("items").alias("_i", "_item"), parse(F.col("answer")).alias("_a")).select(
            F.col("_item.id").alias("key"), F.try_element_at("_a", F.col("_i") + 1).alias("answer"), "error")
        # answers and failures in one write: each request is sent once, and nothing is stored twice
        ledger.append(each.withColumn("error", F.when(F.col("answer").isNull(), F.coalesce("error", F.lit("no answer for this text")))), run)
    return ledger.failures(run)


def translations(answer):
    """First translation of each text from a translation service's JSON answer."""
    from tessera.operators.translate import ANSWER
    return F.transform(F.from_json(answer, ANSWER), lambda x: first_translation(F.array(x)))


def translate_resumable(df: DataFrame, cols: list[str], call: Callable, ledger: Ledger, *, suffix: str = "_en",
                        keys: bool = False, **limits) -> DataFrame:
    """Translate columns through a service, sending only texts that the ledger does not answer yet.  Adds
    ``<col><suffix>`` and ``<col>_error`` (of this run, where the text stays unanswered); NULL texts stay
    NULL.  Rows may repeat ids or have none: answers are joined by content.  `keys` also adds ``<col>_key``,
    the key of the text; the rows are dealt by the key of the column with the most text.

    A row is moved once a column: with its keys (not its texts, where they are not used further), and
    with the answers of the columns that have less text."""
    failed, known = answer_missing(df, cols, call, ledger, parse=translations, **limits), ledger.answers()
    sizes = df.agg(*[F.sum(F.length(F.col(c).cast("string"))).alias(f"_n{i}") for i, c in enumerate(cols)]).first()
    out = df.withColumns({f"_key_{c}": text_key(c) for c in cols})
    for _, c in sorted(zip(sizes, cols), key=lambda x: x[0] or 0):
        en, error, key = f"{c}{suffix}", f"{c}_error", F.col(f"_key_{c}")
        out = out.join(known.select(F.col("key").alias("_key"), F.col("answer").alias(en)), key == F.col("_key"), "left").drop("_key")
        out = out.join(failed.select(F.col("key").alias("_key"), F.col("error").alias(error)), key == F.col("_key"), "left").drop("_key")
        out = out.withColumn(error, F.when(F.col(en).isNull(), F.col(error)))
    return out.select(*df.columns, *[x for c in cols for x in (f"{c}{suffix}", f"{c}_error")], *[F.col(f"_key_{c}").alias(f"{c}_key") for c in cols if keys])
