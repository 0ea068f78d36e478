"""Registered queries: segmentation, CSV sources, table export and catalog listings."""
from __future__ import annotations

import uuid
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators import batching as B
from tessera.operators import segment as S
from tessera.operators.transformers import TextEmbedder, TextTranslator
from tessera.plans.sales import sales_model
from tessera.session import scratch_path
from tessera.sources import catalog, files, sinks
from tessera.sources.tables import load
from tessera.suite.common import FACT_SQL
from tessera.suite.registry import query


def _named_embeddings(spark, sf):
    e = load(spark, sf, "embeddings")
    return e.withColumn("name", F.concat(F.lit("item_"), F.col("vec_id").cast("string")))


GROUP_SQL = """e AS (SELECT vec_id, label, 'item_' || vec_id AS name, unnest(embedding) AS x,
                    unnest(range(1, len(embedding) + 1)) AS i FROM embeddings),
c AS (SELECT label, i, avg(x) AS c FROM e GROUP BY 1, 2),
d AS (SELECT e.label, e.name, sum((e.x - c.c) * (e.x - c.c)) AS dist FROM e JOIN c USING (label, i) GROUP BY 1, 2),
n AS (SELECT label, count(*) AS n_members, min(name) AS only_name FROM d GROUP BY 1),
near AS (SELECT label, arg_min(name, (dist, name)) AS near FROM d GROUP BY 1),
g AS (SELECT n.label, CAST(n_members AS BIGINT) AS n_members,
             CASE WHEN n_members = 1 THEN only_name ELSE near END AS group_name FROM n JOIN near USING (label))"""


@query("distinct_categories", sql="""
SELECT replace(p_name, '_', ' ') AS category, count(*) AS n FROM part WHERE p_name IS NOT NULL GROUP BY 1""")
def q_distinct_categories(spark, sf):
    return S.distinct_values(load(spark, sf, "part"), "p_name")


@query("group_names", sql=f"WITH {GROUP_SQL} SELECT label, n_members, group_name FROM g")
def q_group_names(spark, sf):
    """One name per embedding group: the member nearest the group's centroid."""
    return S.name_groups(_named_embeddings(spark, sf), "label", "name", "embedding")


@query("category_mapping", sql=f"""WITH {GROUP_SQL}
SELECT 'item_' || em.vec_id AS original_category, g.group_name AS higher_order_category
FROM embeddings em JOIN g ON g.label = em.label""")
def q_category_mapping(spark, sf):
    e = _named_embeddings(spark, sf)
    return S.category_mapping(e, "label", "name", S.name_groups(e, "label", "name", "embedding"))


def _members_sql(table: str, key: str, member: str, order: str, size: int) -> str:
    return f"""WITH m AS (SELECT {key}, {member} AS m, count(*) AS n FROM {table} WHERE {member} IS NOT NULL GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {order}) - 1 AS rn FROM m)
SELECT {key}, CAST(rn // {size} AS BIGINT) AS part, count(*) AS n_members, CAST(sum(n) AS BIGINT) AS n_rows,
       string_agg(CAST(m AS VARCHAR), '|' ORDER BY rn) AS members FROM r GROUP BY 1, 2"""


def _joined(df: DataFrame) -> DataFrame:
    return df.withColumn("members", F.array_join(F.transform("members", lambda x: x.cast("string")), "|"))


@query("group_members", sql=_members_sql("part", "p_type", "p_name", "CAST('0x' || substr(md5(m), 1, 8) AS BIGINT), m", 1000))
def q_group_members(spark, sf):
    """The distinct names of every product type, as arrays (joined for the comparison)."""
    return _joined(B.member_arrays(load(spark, sf, "part"), "p_type", "p_name"))


@query("group_members_in_parts", sql=_members_sql("orders", "o_orderpriority", "o_custkey", "m", 64))
def q_group_members_in_parts(spark, sf):
    """The customers of every order priority, in arrays of 64: groups of any size, the last array ragged."""
    return _joined(B.member_arrays(load(spark, sf, "orders"), "o_orderpriority", "o_custkey", 64))


@query("segment_chain", sql="""
SELECT replace(p_type, '_', ' ') AS original_category, count(*) AS n_products, true AS named_after_a_category FROM part
WHERE p_type IS NOT NULL GROUP BY 1""")
def q_segment_chain(spark, sf):
    """The segmentation end to end: distinct category names, embedding, PCA, k-means, a name per group
    and the mapping back to every category (the oracle checks that each category is mapped once,
    to a category's name)."""
    names = S.distinct_values(load(spark, sf, "part"), "p_type")
    e = S.embed_text(names, "category", 64).withColumn("vector", vector_to_array("embedding"))
    p, _ = S.pca_by_variance(e, "vector", 0.95)
    c = S.kmeans(p, "pca", 3, 42).withColumn("v", vector_to_array("pca")).select("category", "n", "cluster", "v")
    m = S.category_mapping(c, "cluster", "category", S.name_groups(c, "cluster", "category", "v"))
    known = names.select(F.col("category").alias("_c"))
    m = m.join(known, F.col("higher_order_category") == F.col("_c"), "left")
    return names.join(m, F.col("category") == F.col("original_category")).select(
        "original_category", F.col("n").alias("n_products"), F.col("_c").isNotNull().alias("named_after_a_category"))


@query("pca_kmeans")
def q_pca_kmeans(spark, sf):
    """Centred PCA keeping 95 % of the variance, then KMeans(k=18, seed=42) (a fit: checked against
    the spectrum of the vectors in the tests)."""
    p, k = S.pca_by_variance(load(spark, sf, "embeddings"), "embedding", 0.95)
    c = S.kmeans(p, "pca", 18, 42)
    return c.select("vec_id", "label", "cluster", F.lit(k).alias("components"))


@query("embed_text", sql="""
SELECT doc_id, CAST(len(list_distinct(list_filter(string_split_regex(regexp_replace(lower(text), '[^A-Za-z0-9_]+', ' ', 'g'), ' '),
                       lambda w: length(w) >= 2))) > 0 AS INTEGER) AS has_words,
       CASE WHEN len(list_filter(string_split_regex(regexp_replace(lower(text), '[^A-Za-z0-9_]+', ' ', 'g'), ' '),
                       lambda w: length(w) >= 2)) > 0 THEN 1.0 ELSE 0.0 END::DOUBLE AS norm FROM documents WHERE text IS NOT NULL""")
def q_embed_text(spark, sf):
    """TF-IDF embeddings of whole documents (Spark ML, sparse vectors): unit length for every text
    with a word."""
    e = S.embed_text(load(spark, sf, "documents"), "text")
    v = vector_to_array("embedding")
    norm = F.round(F.sqrt(F.aggregate(v, F.lit(0.0), lambda a, x: a + x * x)), 6)
    return e.select("doc_id", norm.alias("norm")).withColumn("has_words", (F.col("norm") > 0).cast("int"))


def text_profile(texts: list[str]) -> list[list[float]]:
    """An embedding service: characters, lines, vowels and blanks of each text; it cannot do texts whose length ends in 3."""
    if any(len(t) % 10 == 3 for t in texts):
        raise RuntimeError("service unavailable")
    return [[float(len(t)), t.count("\n") + 1.0, float(sum(map(t.count, "aeiou"))), float(t.count(" "))] for t in texts]


def first_line(texts: list[str]) -> list[str]:
    """A text service: the first line as a heading."""
    return ["# " + t.split("\n")[0] for t in texts]


@query("embed_service", sql="""
SELECT doc_id, CASE WHEN length(text) % 10 <> 3 THEN CAST(length(text) AS DOUBLE) END AS n_chars,
       CASE WHEN length(text) % 10 <> 3 THEN CAST(length(text) - length(replace(text, chr(10), '')) + 1 AS DOUBLE) END AS n_lines,
       CASE WHEN length(text) % 10 <> 3 THEN CAST(length(regexp_replace(text, '[^aeiou]', '', 'g')) AS DOUBLE) END AS n_vowels,
       CASE WHEN length(text) % 10 <> 3 THEN CAST(length(text) - length(replace(text, ' ', '')) AS DOUBLE) END AS n_blanks,
       CASE WHEN length(text) % 10 = 3 THEN 'RuntimeError: service unavailable' END AS error,
       '# ' || string_split(text, chr(10))[1] AS heading FROM documents""")
def q_embed_service(spark, sf):
    """Documents through a Pipeline of two services that was saved and loaded again: a text service, and an
    embedding whose failing texts keep their error."""
    pipe = Pipeline(stages=[TextTranslator(inputCol="text", outputCol="heading", errorCol="heading_error", function="tessera.suite.io_seg_q:first_line"),
                            TextEmbedder(inputCol="text", outputCol="embedding", function="tessera.suite.io_seg_q:text_profile", retries=1)])
    docs = load(spark, sf, "documents").select("doc_id", "text")
    path = scratch_path(spark, f"pipeline-{uuid.uuid4().hex}")
    pipe.fit(docs).write().save(path)
    out = PipelineModel.load(path).transform(docs)
    names = ("n_chars", "n_lines", "n_vowels", "n_blanks")
    return out.select("doc_id", *[F.col("embedding")[i].alias(n) for i, n in enumerate(names)], "error", "heading")


@query("csv_roundtrip_documents", sql="""
SELECT doc_id, lang, source, n_chars, CAST(length(text) AS INTEGER) AS text_chars, true AS same_text FROM documents""")
def q_csv_roundtrip(spark, sf):
    """Documents (multi-line texts with quotes) written as CSV and read back with an explicit
    schema; every text must come back unchanged."""
    d = load(spark, sf, "documents")
    path = scratch_path(spark, f"csv-{uuid.uuid4().hex}")
    files.write_csv(d, path)
    back = files.read_csv(spark, path, "doc_id long, text string, lang string, source string, n_chars long",
                          multiline=True)
    j = back.alias("b").join(d.select("doc_id", F.col("text").alias("orig")), "doc_id")
    return j.select("doc_id", "lang", "source", "n_chars", F.length("text").alias("text_chars"),
                    F.col("text").eqNullSafe(F.col("orig")).alias("same_text"))


# Every table but the vectors, which CSV cannot hold.
CSV_TABLES = ("region", "nation", "supplier", "customer", "part", "orders", "lineitem", "events", "documents", "pages",
              "benchmark", "labels", "conversations")


@query("ingest_folder", sql=" UNION ALL ".join(
    f"SELECT '{t}' AS \"table\", (SELECT count(*) FROM {t}) AS rows, CAST((SELECT count(*) FROM (DESCRIBE {t})) AS INTEGER) AS columns, "
    "false AS all_string" for t in CSV_TABLES))
def q_ingest_folder(spark, sf):
    """Tables landed as CSV files named like '<prefix>_<table>_dataset.csv', ingested as all-string
    tables, then re-ingested with inferred types (schema overwrite)."""
    base = scratch_path(spark, f"ingest-{uuid.uuid4().hex}")
    src, dst = f"{base}/raw", f"{base}/tables"
    for t in CSV_TABLES:
        files.write_csv(load(spark, sf, t), f"{src}/shop_{t}_dataset.csv")
    for t, path in files.ingest_folder(spark, src, dst, multiline=True):
        if any(tp != "string" for _, tp in spark.read.parquet(path).dtypes):
            raise ValueError(f"{t} is not all strings")
    done = files.ingest_folder(spark, src, dst, infer=True, multiline=True)
    frames = []
    for t, path in done:
        df = spark.read.parquet(path)
        frames.append(df.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(t).alias("table"), "rows", F.lit(len(df.columns)).alias("columns"),
            F.lit(all(tp == "string" for _, tp in df.dtypes)).alias("all_string")))
    return reduce(DataFrame.unionByName, frames)


@query("export_status", sql="""
WITH f AS (SELECT count(*) AS n FROM orders JOIN lineitem ON o_orderkey = l_orderkey),
b AS (SELECT min(year(o_orderdate)) AS y0, max(year(o_orderdate)) AS y1 FROM orders)
SELECT * FROM (
  SELECT 'orders' AS "table", n AS rows, false AS failed FROM f
  UNION ALL SELECT 'customer', count(*), false FROM customer UNION ALL SELECT 'supplier', count(*), false FROM supplier
  UNION ALL SELECT 'part', count(*), false FROM part UNION ALL SELECT 'reviews', count(*), false FROM events
  UNION ALL SELECT 'payments', count(*), false FROM events UNION ALL SELECT 'geo_customers', count(*), false FROM nation
  UNION ALL SELECT 'geo_sellers', count(*), false FROM nation UNION ALL SELECT 'leads', count(*), false FROM customer
  UNION ALL SELECT 'date', date_diff('day', make_date(y0, 1, 1), make_date(y1 + 1, 1, 1)), false FROM b
  UNION ALL SELECT 'broken_view', NULL, true)""")
def q_export_status(spark, sf):
    """Every model table exported to parquet; a broken table is reported and the rest go on."""
    m = sales_model(spark, sf)
    tables = dict(m.tables)
    tables["broken_view"] = lambda: load(spark, sf, "orders").select(
        (F.col("o_totalprice") / F.lit(0)).alias("bad"))
    done = sinks.export_tables(spark, tables, scratch_path(spark, f"export-{uuid.uuid4().hex}"))
    return done.select("table", "rows", (~F.col("ok") & (F.length("error") > 0)).alias("failed"))


@query("catalog_exclude", sql=f"""
SELECT 'orders' AS table_name, count(*) AS n_rows, 20 AS n_columns, NULL::VARCHAR AS description, NULL::BOOLEAN AS is_hidden
  FROM {FACT_SQL} f
UNION ALL SELECT 'customer', count(*), 5, NULL, NULL FROM customer
UNION ALL SELECT 'supplier', count(*), 4, NULL, NULL FROM supplier
UNION ALL SELECT 'part', count(*), 6, NULL, NULL FROM part
UNION ALL SELECT 'reviews', count(*), 8, NULL, NULL FROM events
UNION ALL SELECT 'payments', count(*), 5, NULL, NULL FROM events
UNION ALL SELECT 'geo_customers', count(*), 3, NULL, NULL FROM nation JOIN region ON n_regionkey = r_regionkey
UNION ALL SELECT 'geo_sellers', count(*), 3, NULL, NULL FROM nation JOIN region ON n_regionkey = r_regionkey""")
def q_catalog_exclude(spark, sf):
    """Model tables with row and column counts, minus the excluded names."""
    return catalog.list_tables(spark, sales_model(spark, sf), exclude=["date", "leads"])


def _rel_sql(name, ft, fc, tt, tc, card, cf, src, dst) -> str:
    return (f"SELECT '{name}' AS name, '{ft}' AS from_table, '{fc}' AS from_col, '{tt}' AS to_table, '{tc}' AS to_col, "
            f"'{card}' AS cardinality, '{cf}' AS cross_filter, count(*) AS from_rows, "
            f"CAST(sum(CASE WHEN t.k IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS unmatched_rows "
            f"FROM {src} f LEFT JOIN (SELECT DISTINCT {tc} AS k FROM {dst}) t ON f.{fc} = t.k")


GEO = "(SELECT n_nationkey FROM nation JOIN region ON n_regionkey = r_regionkey)"
CALKEYS = """(SELECT CAST(year(d) * 10000 + month(d) * 100 + day(d) AS INTEGER) AS date_key FROM
   (SELECT CAST(unnest(generate_series(make_date(min(year(o_orderdate)), 1, 1), make_date(max(year(o_orderdate)), 12, 31),
                                       INTERVAL 1 DAY)) AS DATE) AS d FROM orders))"""


@query("relationship_catalog", sql=" UNION ALL ".join([
    _rel_sql("R1", "customer", "c_nationkey", "geo_customers", "n_nationkey", "many:many", "single", "customer", GEO),
    _rel_sql("R2", "orders", "o_custkey", "customer", "c_custkey", "many:1", "both", FACT_SQL, "customer"),
    _rel_sql("R3", "orders", "date_key", "date", "date_key", "many:1", "single", FACT_SQL, CALKEYS),
    _rel_sql("R4", "orders", "l_suppkey", "supplier", "s_suppkey", "many:1", "single", FACT_SQL, "supplier"),
    _rel_sql("R5", "orders", "l_partkey", "part", "p_partkey", "many:1", "single", FACT_SQL, "part"),
    _rel_sql("R6", "orders", "o_custkey", "reviews", "user_id", "many:many", "single", FACT_SQL, "events"),
    _rel_sql("R7", "orders", "o_custkey", "payments", "user_id", "many:many", "single", FACT_SQL, "events"),
    _rel_sql("R8", "supplier", "s_nationkey", "geo_sellers", "n_nationkey", "many:many", "single", "supplier", GEO),
    _rel_sql("R9", "orders", "o_custkey", "leads", "c_custkey", "many:many", "single", FACT_SQL, "customer"),
]))
def q_relationship_catalog(spark, sf):
    """The model's relationships as a DataFrame with an integrity count per edge."""
    return catalog.list_relationships(spark, sales_model(spark, sf))
