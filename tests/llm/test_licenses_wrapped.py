"""Licence notices whose words are parted by line breaks, spaces or comment marks."""
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tessera.llm import licenses


@pytest.mark.parametrize("text, found", [
    ("This was released into the public\ndomain.", ["Public-Domain"]),
    ("# All rights\n# reserved.", ["All-Rights-Reserved"]),
    ("All rights  reserved.", ["All-Rights-Reserved"]),
    ("dnl All rights\ndnl reserved.", ["All-Rights-Reserved"]),
    ("// All rights" + " " * 20000 + "\r\n  // reserved.", ["All-Rights-Reserved"]),
    ("Creative\nCommons Attribution 4.0", ["CC-BY"]),
    ("Use CC\n * BY-NC-SA here.", ["CC-BY-NC-SA"]),
    ("Into the public\n\ndomain.", []), ("A public place in his domain.", [])])
def test_wrapped_notices(spark, frame, text, found):
    assert licenses.scan(frame([(1, text)])).first()["licenses"] == found


def test_prefilter_loses_no_sentence(spark):
    """The prefilter against looking at the sentences of every text."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select(F.coalesce("text", F.lit("")).alias("t"))
    for gap in ("\n", "\r\n  ", "\n# ", "\n/* ", "  ", "\ndnl ", "\n -- "):
        wrapped = docs.union(docs.sparkSession.createDataFrame([(s,) for s in licenses.STEMS], "t string")).select(
            F.replace("t", F.lit(" "), F.lit(gap)).alias("t"))
        lost = wrapped.filter(~licenses.has_stem(F.col("t"))).filter(F.exists(
            licenses.sentences(F.col("t")), lambda s: licenses.identifier(s).isNotNull()))
        assert lost.count() == 0, gap
