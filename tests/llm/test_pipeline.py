"""Registered queries of the subpackage and the corpus pipeline."""
import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
import corpus_pipeline
from conftest import SF_SMALL
from .helpers import brute_pipeline_kept

SF = SF_SMALL


def test_one_query_for_each_operator():
    names = [q for q in E.queries() if q.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14)) and "pipeline" in E.queries()


def test_stage_functions_keep_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("score", F.lit(1)).withColumn("rank", F.lit("r"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).columns == docs.columns, name


def test_run_against_brute_force(spark):
    out = corpus_pipeline.run(spark, SF)
    rows = out.select("doc_id", "shard", "slot").collect()
    wanted, words = brute_pipeline_kept(spark, SF)
    assert {r["doc_id"] for r in rows} <= wanted
    got = out.select(F.sum(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")))).first()[0]
    assert abs(got - words) < 0.01 * words


@pytest.mark.parametrize("gone", [True])
def test_the_rest_works_without_the_subpackage(tmp_path, gone):
    """Without llm/ and corpus_pipeline.py the entry point imports and lists the other queries."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    os.symlink(f"{root}/__spark_entry__.py", tmp_path / "__spark_entry__.py")
    (tmp_path / "tessera").mkdir()
    for name in os.listdir(f"{root}/tessera"):
        if name != "llm":
            os.symlink(f"{root}/tessera/{name}", tmp_path / "tessera" / name)
    (tmp_path / "tessera" / "llm" / "__pycache__").mkdir(parents=True)  # what a deletion may leave behind
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 80 and not any(k.startswith('op1_') for k in q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env=os.environ | {"PYTHONPATH": str(tmp_path)})
