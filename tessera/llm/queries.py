"""The registered queries of this subpackage and their SQL where SQL can express them."""
from __future__ import annotations

from typing import Callable

import public_tokenizers
from pyspark.sql import functions as F

from tessera.llm import (chat, decontam, langid, lexical, licenses, mixing, neardup, quality_model, quality_rules, sharding,
                         tokens, toxicity, whitening)
from tessera.llm.common import table

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


@query("op4_quality_rules", sql=f"""
WITH w AS (SELECT doc_id, coalesce(text, '') AS text,
                  regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws,
                  list_filter(string_split(coalesce(text, ''), chr(10)),
                              lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) AS ls
             FROM documents),
     g AS (SELECT doc_id, i, ws[i] AS a, ws[i + 1] AS b, ws[i + 2] AS c
             FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM w WHERE len(ws) >= 3)),
     r AS (SELECT doc_id, i FROM g QUALIFY count(*) OVER (PARTITION BY doc_id, a, b, c) >= 2),
     rep AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM r, (VALUES (0), (1), (2)) v(k) GROUP BY doc_id),
     m AS (SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words,
                  CAST(coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
                  CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
                  CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
                  CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words,
                  CAST(len(ls) AS BIGINT) AS n_lines, CAST(len(list_distinct(ws)) AS BIGINT) AS n_distinct_words,
                  CAST(length(text) - length(regexp_replace(text, '[A-Z]', '', 'g')) AS BIGINT) AS n_upper,
                  CAST(length(text) - length(regexp_replace(text, '[0-9]', '', 'g')) AS BIGINT) AS n_digits,
                  CAST(length(text) - length(replace(text, '!', '')) AS BIGINT) AS n_exclaim,
                  list_reduce(list_prepend([0, 0, 0], list_transform(range(1, len(ws) + 1), lambda i:
                      [CASE WHEN i > 1 AND ws[i] = ws[i - 1] THEN 1 ELSE 0 END, 0, 0])),
                      lambda x, y: [CASE WHEN y[1] = 1 THEN x[1] + 1 ELSE 1 END, 0,
                                 greatest(x[3], CASE WHEN y[1] = 1 THEN x[1] + 1 ELSE 1 END)])[3] AS longest_run
             FROM w LEFT JOIN rep ON w.doc_id = rep.doc_id),
     b AS (SELECT *, ({' + '.join(f"CASE WHEN {r.fails} THEN {1 << r.bit} ELSE 0 END" for r in quality_rules.RULES)})
                     AS bits FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
           AND (bits & {quality_rules.mask(quality_rules.POLICIES[quality_rules.CURRENT])}) = 0 AS kept,
       CAST(bits AS BIGINT) AS fail_bits,
       (bits & {quality_rules.mask(quality_rules.POLICIES[1])}) = 0 AS kept_v1,
       (bits & {quality_rules.mask(quality_rules.POLICIES[2])}) = 0 AS kept_v2
  FROM b""")
def op4_quality_rules(spark, sf):
    """Measurements, failure bits and verdicts of every document (policies 1, 2 and the current)."""
    led = quality_rules.quality_ledger(table(spark, sf, "documents").select("doc_id", "text"))
    return led.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                      "kept", "fail_bits", quality_rules.passes(1).alias("kept_v1"),
                      quality_rules.passes(2).alias("kept_v2"))


@query("op10_token_counts")
def op10_token_counts(spark, sf):
    """Tokens of every document by the byte-level BPE of 50,257 ids (checked against the library's
    own encode in the tests)."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return tokens.count_tokens(docs, public_tokenizers.path("byte_bpe_50k.json")).select(
        "doc_id", "n_bytes", "n_tokens", "over_limit")


@query("op5_language_id")
def op5_language_id(spark, sf):
    """Language of every document (held-out accuracy and brute force in the tests)."""
    return langid.identify_languages(table(spark, sf, "documents").select("doc_id", "lang", "text"))


@query("op7_quality_classifier")
def op7_quality_classifier(spark, sf):
    """Quality score of every document (held-out accuracy and brute force in the tests)."""
    return quality_model.classify(table(spark, sf, "documents").select("doc_id", "text"),
                                  table(spark, sf, "labels").select("doc_id", "quality"))


@query("op1_license_scan", sql=licenses.sql())
def op1_license_scan(spark, sf):
    """Licence sentences, licences and verdict of every document (built-in functions only)."""
    out = licenses.scan(table(spark, sf, "documents").select("doc_id", "text"))
    return out.select("doc_id", F.array_join("sentence_ids", ",").alias("sentence_ids"),
                      F.array_join("licenses", ",").alias("licenses"), "n_unknown", "n_unused", "verdict")


def _sharding_sql() -> str:
    """Shards take turns in a recursive query; the state is the table and each shard's next preference."""
    m, n = sharding.SLOTS, sharding.SHARDS
    number = lambda text: f"CAST('0x' || substr(md5({text}), 1, 15) AS BIGINT)"
    return f"""
WITH RECURSIVE shards AS (SELECT i, {number("'start shard-' || i")} % {m} AS a, {number("'step shard-' || i")} % {m - 1} + 1 AS d
                            FROM range({n}) r(i)),
     walks AS (SELECT list(a ORDER BY i) AS starts, list(d ORDER BY i) AS steps FROM shards),
     fill(t, nexts, filled) AS (
       SELECT 0, list_transform(range({n}), lambda i: CAST(0 AS BIGINT)), list_transform(range({m}), lambda i: CAST(-1 AS BIGINT))
       UNION ALL
       SELECT t + 1, list_transform(range({n}), lambda i: CASE WHEN i = t % {n} THEN j + 1 ELSE nexts[i + 1] END),
              list_transform(filled, lambda x, k: CASE WHEN k = (a + j * d) % {m} + 1 THEN t % {n} ELSE x END)
         FROM (SELECT t, nexts, filled, starts[t % {n} + 1] AS a, steps[t % {n} + 1] AS d,
                      (SELECT min(q) FROM range({m}) r(q) WHERE q >= nexts[t % {n} + 1]
                          AND filled[(starts[t % {n} + 1] + q * steps[t % {n} + 1]) % {m} + 1] < 0) AS j
                 FROM fill, walks WHERE t < {m})),
     slots AS (SELECT unnest(range({m})) AS slot, unnest(filled) AS shard FROM fill WHERE t = {m})
SELECT doc_id, CAST(d.slot AS BIGINT) AS slot, CAST(shard AS INTEGER) AS shard
  FROM (SELECT doc_id, {number("coalesce(CAST(doc_id AS VARCHAR), concat_ws('|', 'null', coalesce(source, ''), coalesce(lang, ''), coalesce(CAST(n_chars AS VARCHAR), '')))")} % {m} AS slot FROM documents) d
  JOIN slots ON d.slot = slots.slot"""


@query("op3_sharding", sql=_sharding_sql())
def op3_sharding(spark, sf):
    """Slot and shard of every document (built-in functions only)."""
    docs = table(spark, sf, "documents").select("doc_id", "source", "lang", "n_chars")
    return sharding.place(docs).select("doc_id", "slot", "shard")


@query("op6_mixing", sql=mixing.sql())
def op6_mixing(spark, sf):
    """Words that the mixture takes of every document."""
    return mixing.mix_plan(table(spark, sf, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@query("op8_chat_format", sql=f"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL VALUES (-7, 0, 'user', '{chat.TRICKY}'), (-7, 1, 'assistant', '{chat.TRICKY}')),
     e AS (SELECT *, length(text) + length(text) - length(replace(text, '\\', ''))
                     + coalesce(list_sum(list_transform(regexp_extract_all(text, '#{{3,}}'), lambda x: length(x) - 2)), 0)
                     + (length(text) - length(replace(replace(text, '</turn>', '</turn'), '</role>', '</role'))) AS escaped,
                  CASE role WHEN 'system' THEN 12 WHEN 'user' THEN 10 WHEN 'assistant' THEN 15
                       ELSE 12 + length(role) END AS header FROM c)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(header + escaped + 8) AS BIGINT) AS formatted_chars
  FROM e GROUP BY conv_id""")
def op8_chat_format(spark, sf):
    """Every conversation formatted and read back."""
    turns = chat.with_tricky(spark, table(spark, sf, "conversations"))
    return chat.digests(chat.format_conversations(turns), in_order=True)


@query("op2_minhash_neardup", sql=neardup.sql())
def op2_minhash_neardup(spark, sf):
    """Near-duplicate groups of all documents (the SQL compares all pairs)."""
    return neardup.groups(table(spark, sf, "documents")).select("doc_id", "n_shingles", "component_id", "kept")


@query("op9_decontamination")
def op9_decontamination(spark, sf):
    """Documents that hold benchmark items, one row per document and item (checked against all
    windows in the tests)."""
    return decontam.contaminated(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


@query("op11_lexical_search", sql=lexical.sql())
def op11_lexical_search(spark, sf):
    """The ten best documents of each benchmark item (the SQL scores all pairs)."""
    return lexical.rank_documents(table(spark, sf, "documents").select("doc_id", "text"), table(spark, sf, "benchmark"))


@query("op12_toxicity")
def op12_toxicity(spark, sf):
    """Toxicity score of every document (held-out accuracy and brute force in the tests)."""
    return toxicity.classify(table(spark, sf, "documents").select("doc_id", "text"),
                             table(spark, sf, "labels").select("doc_id", "toxic"))


@query("op13_whitening")
def op13_whitening(spark, sf):
    """Every embedding on the eight leading whitened components (checked against numpy in the tests)."""
    return whitening.whiten(table(spark, sf, "embeddings"))


@query("pipeline")
def pipeline(spark, sf):
    """The stages of corpus_pipeline.py over documents."""
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf)
