"""Registered queries: batched text jobs, messages, translation, look-ups and merges."""
from __future__ import annotations

import json
import uuid

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.arrays import first_translation, non_empty
from tessera.operators import batching as B
from tessera.operators.joins import exclude_by_name, extend_lookup, merge_left, one_per_key, translate_lookup
from tessera.operators.ledger import Ledger, answer_missing, translate_resumable, translations
from tessera.operators.translate import WORD_DICTIONARY, translate_columns, translate_job
from tessera.session import literal_frame, scratch_path
from tessera.sources.tables import load
from tessera.suite.common import rounded
from tessera.suite.registry import query

SHARDS = 4  # at least; jobs that scan a shard in one task take more as the data grow
SHARDS_SQL = f"(SELECT greatest({SHARDS}, (count(*) + 999999) // 1000000) FROM documents)"
INSTRUCTION = "Score each review for product defects from 0 to 1.\nReviews: "

CHUNK_SQL = """ch AS (SELECT doc_id, text, CAST(doc_id % 4 AS INTEGER) AS shard,
   CAST((row_number() OVER (PARTITION BY doc_id % 4 ORDER BY doc_id) - 1) // 20 AS INTEGER) AS batch,
   CAST((row_number() OVER (PARTITION BY doc_id % 4 ORDER BY doc_id) - 1) % 20 AS INTEGER) AS pos
   FROM documents WHERE text IS NOT NULL)"""


def _shards(docs: DataFrame) -> int:
    return max(SHARDS, B.shards_for(docs.count()))


@query("greedy_batches", sql=f"""
WITH RECURSIVE d0 AS (SELECT doc_id, CAST(doc_id % {SHARDS_SQL} AS INTEGER) AS shard, length(text) AS len
                      FROM documents WHERE text IS NOT NULL),
d AS (SELECT *, row_number() OVER (PARTITION BY shard ORDER BY doc_id) AS rn FROM d0),
r AS (SELECT shard, rn, doc_id, len, 0 AS batch, 1 AS cnt, len AS chars FROM d WHERE rn = 1
      UNION ALL
      SELECT d.shard, d.rn, d.doc_id, d.len,
             CASE WHEN r.cnt + 1 > 900 OR r.chars + d.len > 45000 THEN r.batch + 1 ELSE r.batch END,
             CASE WHEN r.cnt + 1 > 900 OR r.chars + d.len > 45000 THEN 1 ELSE r.cnt + 1 END,
             CASE WHEN r.cnt + 1 > 900 OR r.chars + d.len > 45000 THEN d.len ELSE r.chars + d.len END
      FROM r JOIN d ON d.shard = r.shard AND d.rn = r.rn + 1)
SELECT doc_id, shard, CAST(batch AS INTEGER) AS batch, CAST(len AS INTEGER) AS n_chars FROM r""")
def q_greedy_batches(spark, sf):
    """Documents batched greedily under 900 texts / 45,000 characters, in shards by doc_id of a million rows
    at most (four shards at least)."""
    d = load(spark, sf, "documents")
    return B.greedy_batches(d, "doc_id", "text", shards=_shards(d))


@query("fixed_chunks", sql=f"""WITH {CHUNK_SQL}
SELECT shard, batch, CAST(count(*) AS BIGINT) AS n_items, min(doc_id) AS first_id, max(doc_id) AS last_id,
       CAST(sum(length(text)) AS BIGINT) AS chars FROM ch GROUP BY 1, 2""")
def q_fixed_chunks(spark, sf):
    d = load(spark, sf, "documents").filter(F.col("text").isNotNull()).select("doc_id", F.length("text").alias("chars"))
    c = B.chunk(d, "doc_id", shards=SHARDS)
    return c.groupBy("shard", "batch").agg(F.count(F.lit(1)).alias("n_items"), F.min("doc_id").alias("first_id"),
                                           F.max("doc_id").alias("last_id"), F.sum("chars").cast("bigint").alias("chars"))


STRING_IDS_SQL = f"""d0 AS (SELECT 'r' || doc_id AS review_id, length(text) AS len, md5('r' || doc_id) AS h,
   CAST('0x' || substr(md5('r' || doc_id), 1, 8) AS BIGINT) AS o FROM documents WHERE text IS NOT NULL),
d1 AS (SELECT *, CAST(o % {SHARDS_SQL} AS INTEGER) AS shard FROM d0)"""


def _string_ids(spark, sf):
    d = load(spark, sf, "documents").filter(F.col("text").isNotNull())
    return d.select(F.concat(F.lit("r"), F.col("doc_id").cast("string")).alias("review_id"), "text", F.length("text").alias("chars"))


@query("fixed_chunks_string_id", sql=f"""WITH {STRING_IDS_SQL},
c AS (SELECT *, row_number() OVER (PARTITION BY shard ORDER BY o, review_id) - 1 AS rn FROM d1)
SELECT shard, CAST(rn // 20 AS INTEGER) AS batch, count(*) AS n_items, min(review_id) AS first_id, max(review_id) AS last_id,
       CAST(sum(len) AS BIGINT) AS chars FROM c GROUP BY 1, 2""")
def q_fixed_chunks_string_id(spark, sf):
    """Chunks of 20 over ids that are strings."""
    c = B.chunk(_string_ids(spark, sf).select("review_id", "chars"), "review_id", shards=_shards(load(spark, sf, "documents")))
    return c.groupBy("shard", "batch").agg(F.count(F.lit(1)).alias("n_items"), F.min("review_id").alias("first_id"),
                                           F.max("review_id").alias("last_id"), F.sum("chars").cast("bigint").alias("chars"))


_GREEDY_STEPS_SQL = """r AS (SELECT shard, rn, id, len, 0 AS batch, 1 AS cnt, len AS chars FROM d WHERE rn = 1
      UNION ALL
      SELECT d.shard, d.rn, d.id, d.len,
             CASE WHEN r.cnt + 1 > 900 OR r.chars + d.len > 45000 THEN r.batch + 1 ELSE r.batch END,
             CASE WHEN r.cnt + 1 > 900 OR r.chars + d.len > 45000 THEN 1 ELSE r.cnt + 1 END,
             CASE WHEN r.cnt + 1 > 900 OR r.chars + d.len > 45000 THEN d.len ELSE r.chars + d.len END
      FROM r JOIN d ON d.shard = r.shard AND d.rn = r.rn + 1)"""


@query("greedy_batches_string_id", sql=f"""WITH RECURSIVE {STRING_IDS_SQL},
d AS (SELECT review_id AS id, shard, len, row_number() OVER (PARTITION BY shard ORDER BY h, review_id) AS rn FROM d1),
{_GREEDY_STEPS_SQL}
SELECT id AS review_id, shard, CAST(batch AS INTEGER) AS batch, CAST(len AS INTEGER) AS n_chars FROM r""")
def q_greedy_batches_string_id(spark, sf):
    """Greedy batches over ids that are strings."""
    return B.greedy_batches(_string_ids(spark, sf), "review_id", "text", shards=_shards(load(spark, sf, "documents")))


def _service(pdf: pd.DataFrame) -> pd.Series:
    """A translation service as seen by the job: nested answers, and a failure for every request whose
    first text has an id divisible by 5."""
    out = []
    for items in pdf["items"]:
        if items[0]["id"] % 5 == 0:
            raise RuntimeError("service unavailable")
        out.append(json.dumps([{"translations": [{"text": "en:" + i["text"], "to": "en"}, {"text": "second", "to": "x"}]}
                               for i in items]))
    return pd.Series(out)


def _job_sql(col: str) -> str:
    steps = _GREEDY_STEPS_SQL.replace("r AS (", f"r_{col} AS (").replace("FROM r JOIN d ON d.shard = r.shard AND d.rn = r.rn + 1",
                                                                      f"FROM r_{col} r JOIN d_{col} d ON d.shard = r.shard AND d.rn = r.rn + 1")
    return f"""s_{col} AS (SELECT doc_id AS id, CAST(doc_id % {SHARDS_SQL} AS INTEGER) AS shard, length({col}) AS len
      FROM documents WHERE {col} IS NOT NULL),
d_{col} AS (SELECT *, row_number() OVER (PARTITION BY shard ORDER BY id) AS rn FROM s_{col}),
{steps.replace("FROM d WHERE rn = 1", f"FROM d_{col} WHERE rn = 1")},
b_{col} AS (SELECT id, min(id) OVER (PARTITION BY shard, batch) % 5 = 0 AS failed FROM r_{col})"""


@query("translate_job", sql=f"""WITH RECURSIVE {_job_sql('text')}, {_job_sql('lang')}
SELECT doc_id, CASE WHEN NOT t.failed THEN 'en:' || text END AS text_en, CASE WHEN NOT l.failed THEN 'en:' || lang END AS lang_en,
       CASE WHEN t.failed THEN 'RuntimeError: service unavailable' END AS text_error
FROM documents LEFT JOIN b_text t ON t.id = doc_id LEFT JOIN b_lang l ON l.id = doc_id""")
def q_translate_job(spark, sf):
    """Two columns translated in turn by a service under its batch limits, joined back by id; failed
    requests leave NULL and their error."""
    d = load(spark, sf, "documents").select("doc_id", "text", "lang")
    r = translate_job(d, "doc_id", ["text", "lang"], _service, shards=_shards(d))
    return r.select("doc_id", "text_en", "lang_en", "text_error")


@query("translate_resume", sql="""
SELECT doc_id, 'en:' || text AS text_en, 'en:' || lang AS lang_en,
       CAST(length(text) % 10 = 3 AS BOOLEAN) AS sent_twice FROM documents""")
def q_translate_resume(spark, sf):
    """Texts and language names translated by a service through the answer ledger: a first run in which the
    requests with some texts fail, and a second one that sends only what is missing.  `sent_twice`:
    texts that the first run left open."""
    d = load(spark, sf, "documents").select("doc_id", "text", "lang")
    ledger = Ledger(spark, scratch_path(spark, f"answers-{uuid.uuid4().hex}"))

    def call(pdf: pd.DataFrame, broken: bool) -> pd.Series:
        out = []
        for items in pdf["items"]:
            if broken and len(items[0]["text"]) % 10 == 3:
                raise RuntimeError("service unavailable")
            out.append(json.dumps([{"translations": [{"text": "en:" + i["text"], "to": "en"}]} for i in items]))
        return pd.Series(out)

    first = answer_missing(d, ["text"], lambda p: call(p, True), ledger, parse=translations, max_items=1, retries=1)
    left = first.select("key").distinct().withColumn("open", F.lit(True))
    out = translate_resumable(d, ["text", "lang"], lambda p: call(p, False), ledger, keys=True)
    out = out.join(left, F.col("text_key") == F.col("key"), "left")
    return out.select("doc_id", "text_en", "lang_en", F.when(F.col("text_key").isNotNull(), F.coalesce("open", F.lit(False))).alias("sent_twice"))


@query("greedy_batches_parallel", sql=f"""WITH RECURSIVE
d AS (SELECT doc_id AS id, 0 AS shard, length(text) AS len, row_number() OVER (ORDER BY doc_id) AS rn FROM documents WHERE text IS NOT NULL),
{_GREEDY_STEPS_SQL}
SELECT id AS doc_id, shard, CAST(batch AS INTEGER) AS batch, CAST(len AS INTEGER) AS n_chars FROM r""")
def q_greedy_batches_parallel(spark, sf):
    """All documents batched greedily in one sequence (no shards), in parallel."""
    return B.greedy_batches_blocks(load(spark, sf, "documents"), "doc_id", "text")


@query("first_translation", sql="""
SELECT doc_id, CASE WHEN length(text) % 3 > 0 THEN string_split(text, chr(10))[1] END AS first_text FROM documents""")
def q_first_translation(spark, sf):
    """Nested answers (results, each with translations) flattened and the first text taken; every
    third document has results without translations."""
    lines = F.transform(F.split("text", "\n"), lambda x: F.struct(x.alias("text"), F.lit("en").alias("to")))
    some = F.when(F.length("text") % 3 > 0, lines).otherwise(F.slice(lines, 1, 0))
    answer = F.array(F.struct(F.slice(lines, 1, 0).alias("translations")), F.struct(some.alias("translations")))
    return load(spark, sf, "documents").select("doc_id", first_translation(answer).alias("first_text"))


@query("non_empty_arrays", sql="""
SELECT doc_id, CAST(len(list_filter(string_split(text, chr(10)), lambda x: length(x) > 300)) AS INTEGER) AS n_long_lines
FROM documents WHERE len(list_filter(string_split(text, chr(10)), lambda x: length(x) > 300)) > 0""")
def q_non_empty_arrays(spark, sf):
    """Documents whose array of long lines is not empty."""
    d = load(spark, sf, "documents").withColumn("long", F.filter(F.split("text", "\n"), lambda x: F.length(x) > 300))
    return d.filter(non_empty("long")).select("doc_id", F.size("long").alias("n_long_lines"))


def _prompts(spark, sf):
    d = load(spark, sf, "documents").filter(F.col("text").isNotNull())
    return B.batch_prompts(B.chunk(d, "doc_id", shards=SHARDS), "doc_id", "text", INSTRUCTION)


@query("batch_prompts", sql=f"""WITH {CHUNK_SQL}
SELECT shard, batch, CAST(count(*) AS INTEGER) AS n_items, 'system' AS role0, 'user' AS role1,
       'Score each review for product defects from 0 to 1.' AS system_content,
       CAST({len(INSTRUCTION)} + 2 + sum(length(text)) + 3 * count(*) - 1
            + sum(length(text) - length(replace(replace(replace(replace(replace(text, chr(10), ''), '"', ''), chr(92), ''),
                                                 chr(9), ''), chr(13), ''))) AS BIGINT)
       AS user_content_length,
       arg_min(doc_id, pos) AS first_doc_id
FROM ch GROUP BY 1, 2""")
def q_batch_prompts(spark, sf):
    """One prompt per chunk of 20 documents: messages = [system, user(instruction + JSON array)].
    The oracle checks the roles, the system text and the exact JSON length of the user content."""
    p = _prompts(spark, sf)
    return p.select("shard", "batch", "n_items", F.col("messages")[0]["role"].alias("role0"),
                    F.col("messages")[1]["role"].alias("role1"), F.col("messages")[0]["content"].alias("system_content"),
                    F.length(F.col("messages")[1]["content"]).cast("bigint").alias("user_content_length"),
                    F.col("items")[0]["id"].alias("first_doc_id"))


def _fake_answers(prompts):
    """Synthetic service answers built from the batch contents: most batches get one score per
    item; some get a refusal, some no answer, some one score too few."""
    scores = F.transform("items", lambda x: F.round(F.pmod(F.length(x["text"]), F.lit(11)) / 10, 1))
    k = F.pmod(F.col("shard") + F.col("batch"), F.lit(9))
    ans = (F.when(k == 4, F.lit("sorry, I cannot help with that"))
           .when(k == 7, F.lit(None).cast("string"))
           .when(k == 2, F.to_json(F.slice(scores, 1, F.size(scores) - 1)))
           .otherwise(F.to_json(scores)))
    return prompts.withColumn("answer", ans)


FAKE_SQL = f"""WITH {CHUNK_SQL},
it AS (SELECT *, round((length(text) % 11) / 10, 1) AS s, (shard + batch) % 9 AS k FROM ch),
bt AS (SELECT shard, batch, count(*) AS n_items, min(k) AS k FROM it GROUP BY 1, 2)"""


@query("parse_scores", sql=FAKE_SQL + """
SELECT shard, batch, CAST(n_items AS INTEGER) AS n_items,
       CAST(CASE WHEN k = 4 OR k = 7 THEN NULL WHEN k = 2 THEN n_items - 1 ELSE n_items END AS INTEGER) AS n_scores
FROM bt""")
def q_parse_scores(spark, sf):
    p = _fake_answers(_prompts(spark, sf)).withColumn("scores", B.parse_scores(F.col("answer")))
    return p.select("shard", "batch", "n_items", F.size("scores").alias("n_scores")).withColumn(
        "n_scores", F.when(F.col("n_scores") >= 0, F.col("n_scores")))


@query("unbatch_scores", sql=FAKE_SQL + """
SELECT doc_id, CASE WHEN k = 7 THEN NULL ELSE s END AS score FROM it WHERE k NOT IN (2, 4)""")
def q_unbatch_scores(spark, sf):
    ok, _ = B.check_answers(_fake_answers(_prompts(spark, sf)))
    return rounded(B.unbatch(ok).select(F.col("id").alias("doc_id"), "score"), 1)


@query("score_rejects", sql=FAKE_SQL + """
SELECT shard, batch, CAST(n_items AS INTEGER) AS n_items, CASE WHEN k = 4 THEN 'malformed' ELSE 'length' END AS reason
FROM bt WHERE k IN (2, 4)""")
def q_score_rejects(spark, sf):
    _, rej = B.check_answers(_fake_answers(_prompts(spark, sf)))
    return rej


def _term_sql(col: str) -> str:
    parts = [f"(length(lower({col})) - length(replace(lower({col}), '{t}', ''))) / {len(t)} * {w}"
             for t, w in B.DEFECT_TERMS.items()]
    return f"least(1.0, greatest(0.0, {' + '.join(parts)}))"


@query("defect_scores", sql=f"""
SELECT doc_id, text AS review, round({_term_sql('text')}, 4) AS defect_score FROM documents WHERE text IS NOT NULL""")
def q_defect_scores(spark, sf):
    """Reviews scored in prompts of 20 through the (default, weighted-term) scorer on executors,
    parsed, length-checked and un-batched by position."""
    res, _ = B.defect_scores(load(spark, sf, "documents"), "doc_id", "text", shards=SHARDS)
    return rounded(res, 4)


@query("score_batches_retry", sql=f"""WITH {CHUNK_SQL},
b AS (SELECT shard, batch, count(*) AS n, arg_min(doc_id, pos) AS first FROM ch GROUP BY 1, 2)
SELECT shard, batch, CAST(n AS INTEGER) AS n_items, CAST(CASE WHEN first % 10 = 7 OR first % 2 = 1 THEN 3 ELSE 1 END AS INTEGER) AS attempts,
       CASE WHEN first % 10 = 7 THEN 'RuntimeError: service unavailable' END AS error, first % 10 <> 7 AS answered FROM b""")
def q_score_batches_retry(spark, sf):
    """A flaky scorer: batches whose first document id is odd fail twice before succeeding,
    batches whose first id ends in 7 always fail.  Three attempts: the first kind succeed on
    the third attempt, the second kind end with an error and NULL answers."""
    p = _prompts(spark, sf)
    calls: dict = {}

    def flaky(pdf: pd.DataFrame) -> pd.Series:
        first = int(pdf["items"].iloc[0][0]["id"]) if len(pdf) else 0
        calls[first] = calls.get(first, 0) + 1
        if first % 10 == 7:
            raise RuntimeError("service unavailable")
        if first % 2 == 1 and calls[first] < 3:
            raise TimeoutError("timeout")
        return B.term_scorer(pdf)

    s = B.score_batches(p, flaky, retries=3)  # dealt by batch already, in tasks that grow in number with the texts
    return s.select("shard", "batch", "n_items", "attempts", "error", F.col("answer").isNotNull().alias("answered"))


@query("messages_flatten", sql="""
SELECT conv_id, CAST(count(*) AS INTEGER) AS n_turns,
       arg_min(text, turn) FILTER (WHERE role = 'user') AS first_user_text,
       arg_max(text, turn) FILTER (WHERE role = 'assistant') AS last_assistant_text,
       CAST(sum(len(string_split(text, chr(10)))) AS INTEGER) AS n_lines
FROM conversations GROUP BY conv_id""")
def q_messages_flatten(spark, sf):
    """Per conversation: number of turns, first user text, last assistant text and number of
    lines.  All are partial aggregates (a very long conversation is reduced map-side); the
    ordered message array of a conversation is only built for bounded batches
    (``batch_prompts``)."""
    c = load(spark, sf, "conversations")
    user, asst = F.col("role") == "user", F.col("role") == "assistant"
    return c.groupBy("conv_id").agg(
        F.count(F.lit(1)).cast("int").alias("n_turns"),
        F.min(F.when(user, F.struct("turn", "text")))["text"].alias("first_user_text"),
        F.max(F.when(asst, F.struct("turn", "text")))["text"].alias("last_assistant_text"),
        F.sum(F.size(F.split("text", "\n"))).cast("int").alias("n_lines"))


def _dict_sql() -> str:
    pairs = ", ".join(f"'{k}': '{v}'" for k, v in WORD_DICTIONARY.items())
    return "MAP {" + pairs + "}"


@query("translate_back_join", sql=f"""
SELECT doc_id, lang, array_to_string(list_transform(string_split(text, ' '),
       lambda w: coalesce(({_dict_sql()})[lower(w)], w)), ' ') AS text_en
FROM documents""")
def q_translate_back_join(spark, sf):
    """Document texts translated with the word dictionary, in place (NULL texts stay NULL)."""
    d = load(spark, sf, "documents").select("doc_id", "lang", "text")
    return translate_columns(d, ["text"]).select("doc_id", "lang", "text_en")


# Category translation table (deliberately missing two categories).
CATEGORY_NAMES = [("ECONOMY", "economia"), ("STANDARD", "padrao"), ("MEDIUM", "medio"), ("PROMO", "promocao")]


def _category_lookup(spark, sf):
    part = load(spark, sf, "part")
    base = literal_frame(spark, CATEGORY_NAMES, "p_type string, category_name string")
    missing = exclude_by_name(part.select("p_type").distinct(), base, "p_type") \
        .select("p_type", F.lower("p_type").alias("category_name"))
    return extend_lookup(base, missing)


CAT_SQL = """lk0 AS (SELECT * FROM (VALUES ('ECONOMY', 'economia'), ('STANDARD', 'padrao'), ('MEDIUM', 'medio'),
                                     ('PROMO', 'promocao')) t(p_type, category_name)),
lk AS (SELECT * FROM lk0 UNION ALL SELECT DISTINCT p_type, lower(p_type) FROM part WHERE p_type NOT IN (SELECT p_type FROM lk0))"""


@query("category_lookup", sql=f"""WITH {CAT_SQL}
SELECT p.p_partkey, p.p_type, lk.category_name FROM part p LEFT JOIN lk ON lk.p_type = p.p_type""")
def q_category_lookup(spark, sf):
    """The translation table is extended with rows for categories it lacks, then looked up."""
    lk = _category_lookup(spark, sf)
    return translate_lookup(load(spark, sf, "part").select("p_partkey", "p_type"), lk, "p_type", "category_name")


@query("products_merge", sql=f"""WITH {CAT_SQL},
mp AS (SELECT lower(replace(p_type, '_', ' ')) AS original_category, category_name AS higher_order_category FROM lk)
SELECT p.p_partkey, p.p_brand, lower(replace(p.p_type, '_', ' ')) AS category, mp.higher_order_category AS product_segment
FROM part p LEFT JOIN mp ON mp.original_category = lower(replace(p.p_type, '_', ' '))""")
def q_products_merge(spark, sf):
    """Products merged with the category mapping on the spaced, lower-cased category name;
    the mapped column is renamed to product_segment."""
    mp = _category_lookup(spark, sf).select(F.lower(F.replace("p_type", F.lit("_"), F.lit(" "))).alias("original_category"),
                                            F.col("category_name").alias("higher_order_category"))
    p = load(spark, sf, "part").withColumn("category", F.lower(F.replace("p_type", F.lit("_"), F.lit(" "))))
    m = merge_left(p, mp, "category", "original_category", ["higher_order_category"],
                   {"higher_order_category": "product_segment"})
    return m.select("p_partkey", "p_brand", "category", "product_segment")


@query("leads_merge", sql="""
WITH deals AS (SELECT o_custkey, max(o_orderkey) AS last_deal, round(sum(o_totalprice), 2) AS deal_value,
                      CAST(count(*) AS BIGINT) AS n_deals FROM orders WHERE o_orderstatus = 'F' GROUP BY 1)
SELECT c.c_custkey, c.c_mktsegment, d.last_deal, d.deal_value, d.n_deals
FROM customer c LEFT JOIN deals d ON d.o_custkey = c.c_custkey WHERE c.c_acctbal > 0""")
def q_leads_merge(spark, sf):
    """Leads (customers with a positive balance) merged with their closed deals (finished orders,
    one row per customer), chosen columns expanded and renamed."""
    o = load(spark, sf, "orders").filter(F.col("o_orderstatus") == "F")
    deals = o.groupBy("o_custkey").agg(F.max("o_orderkey").alias("last_deal"),
                                       F.round(F.sum("o_totalprice"), 2).alias("deal_value"),
                                       F.count(F.lit(1)).alias("n_deals"))
    leads = load(spark, sf, "customer").filter(F.col("c_acctbal") > 0)
    return merge_left(leads, deals, "c_custkey", "o_custkey", ["last_deal", "deal_value", "n_deals"]) \
        .select("c_custkey", "c_mktsegment", "last_deal", "deal_value", "n_deals")
