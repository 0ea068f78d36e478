import pytest


@pytest.fixture(scope="session")
def frame(spark):
    """Documents from (doc_id, text[, lang[, source]]) tuples."""
    def make(rows, extra=False):
        full = [tuple(r) + ("en", "s")[len(r) - 2:] for r in rows]
        df = spark.createDataFrame(full, "doc_id long, text string, lang string, source string")
        from pyspark.sql import functions as F
        df = df.withColumn("n_chars", F.length("text").cast("long"))
        if extra:  # names that operators use themselves
            for name in ("score", "size", "rank", "block", "slot", "shard", "row", "digest", "n_words", "fail_bits",
                         "__row", "__m", "__ids", "__p", "__slot", "__hits", "s", "h"):
                df = df.withColumn(name, F.lit("x"))
        return df
    return make
