"""Text translation: by an expression in place, or by a service in batches.

The default expression is a word dictionary applied inside each row with
``transform(split(text))`` and a literal map: JVM-side, no shuffle, whole texts.
"""
from __future__ import annotations

from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.arrays import first_translation
from tessera.operators.batching import MAX_CHARS, MAX_ITEMS, greedy_batches, score_batches
from tessera.operators.joins import attach_result
from tessera.session import materialize

# Default word dictionary (fr / de / es function words -> en).
WORD_DICTIONARY = {
    "le": "the", "la": "the", "les": "the", "et": "and", "des": "of the", "du": "of the", "un": "a",
    "une": "a", "dans": "in", "pour": "for", "avec": "with", "sur": "on", "qui": "who", "est": "is",
    "par": "by", "en": "in", "que": "that", "aux": "to the",
    "der": "the", "die": "the", "das": "the", "und": "and", "ist": "is", "mit": "with", "für": "for",
    "auf": "on", "ein": "a", "eine": "a", "nicht": "not", "von": "of", "zu": "to", "den": "the", "im": "in the",
    "el": "the", "los": "the", "las": "the", "y": "and", "es": "is", "con": "with", "para": "for",
    "por": "by", "una": "a", "del": "of the",
}


def dictionary_translator(words: dict[str, str] = WORD_DICTIONARY) -> Callable[[Column], Column]:
    """Word-by-word translation (split on single spaces, case-insensitive look-up,
    unknown words kept)."""
    m = F.create_map(*[F.lit(x) for kv in words.items() for x in kv])

    def tr(text: Column) -> Column:
        return F.array_join(F.transform(F.split(text, " "),
                                        lambda w: F.coalesce(F.try_element_at(m, F.lower(w)), w)), " ")
    return tr


def translate_columns(df: DataFrame, cols: list[str], fn: Callable[[Column], Column] | None = None,
                      suffix: str = "_en") -> DataFrame:
    """Translate columns by an expression, in place (adds ``<col><suffix>``; NULL stays NULL).  For a
    service that is called with batches of texts, see ``translate_job``."""
    fn = fn or dictionary_translator()
    return df.withColumns({f"{c}{suffix}": fn(F.col(c)) for c in cols})


# --- translation by a service --------------------------------------------------------------------

ANSWER = "array<struct<translations:array<struct<text:string,to:string>>>>"


def translate_job(df: DataFrame, id_col: str, cols: list[str], call: Callable, *, shards: int, suffix: str = "_en",
                  max_items: int = MAX_ITEMS, max_chars: int = MAX_CHARS, retries: int = 3) -> DataFrame:
    """Translate columns in turn through a service: NULL texts are dropped, the others batched under
    the service's two limits, each batch sent as one request, and the first translation of each
    text joined back by id.  Adds ``<col><suffix>`` and ``<col>_error`` (of the failed request).

    `call` gets a pandas frame of requests (column ``items``: id and text of each) and returns one
    answer per request: a JSON array with, per text, its translations.  Ids are unique."""
    out = df
    for c in cols:
        texts = df.select(F.col(id_col), F.col(c)).filter(F.col(c).isNotNull())
        batches = greedy_batches(texts, id_col, c, max_items, max_chars, shards=shards)
        batches = batches.select(F.col(id_col).alias("_b_id"), "shard", "batch")
        placed = texts.join(batches, texts[id_col].eqNullSafe(batches["_b_id"])).drop("_b_id")
        # a batch is bounded by the limits
        requests = placed.groupBy("shard", "batch").agg(F.sort_array(F.collect_list(F.struct(
            F.col(id_col).alias("id"), F.col(c).alias("text")))).alias("items"))
        answered = materialize(score_batches(requests, call, retries))
        each = answered.withColumn("_a", F.from_json("answer", ANSWER)).select(
            "error", F.posexplode("items").alias("_i", "_item"), "_a")
        result = each.select(F.col("_item.id").alias(id_col), first_translation(
            F.array(F.try_element_at("_a", F.col("_i") + 1))).alias(f"{c}{suffix}"), F.col("error").alias(f"{c}_error"))
        out = attach_result(out, result, id_col, [f"{c}{suffix}", f"{c}_error"])
    return out
