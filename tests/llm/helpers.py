"""A plain Python version of the filtering stages, with the learned model taken as given."""
from pyspark.sql import functions as F

import corpus_pipeline
from tessera.llm import quality_model
from .test_neardup_decontam import brute_groups, brute_hits


def brute_pipeline_kept(spark, sf):
    """Ids that the first three stages keep, and their number of words."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model = quality_model.learn(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    good = [(r["doc_id"], r["text"]) for r in quality_model.scored(docs, model).filter(
        F.col("score") >= quality_model.THRESHOLD).select("doc_id", "text").collect()]
    first = {d for d, _, c in brute_groups(good, corpus_pipeline.NEAR_PERCENT) if d == c}
    good = [(d, t) for d, t in good if d in first]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    grams = {g for _, t in items for g in shingles(t)}
    suspects = [(d, t) for d, t in good if shingles(t) & grams]
    bad = {d for d, _ in brute_hits(suspects, items)}
    kept = [(d, t) for d, t in good if d not in bad]
    return {d for d, _ in kept}, sum(len((t or "").encode().split()) for _, t in kept)


def shingles(text):
    from .test_neardup_decontam import shingle_tuples
    return shingle_tuples(text)
