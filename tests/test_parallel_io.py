"""Several tables at once: results in order, failures reported, a bound on the jobs in flight."""
import os
import threading
import time

import pytest
from pyspark.sql import functions as F

from tessera.session import scratch_path
from tessera.sources import files, sinks
from tessera.sources.parallel import run_all


def test_results_in_order_under_a_bound(spark):
    now, most, lock = [0], [0], threading.Lock()

    def job(k):
        with lock:
            now[0] += 1
            most[0] = max(most[0], now[0])
        time.sleep(0.05)
        with lock:
            now[0] -= 1
        if k == 3:
            raise ValueError("three")
        return spark.sparkContext.getLocalProperty("spark.jobGroup.id")

    got = run_all(spark, "t", {str(k): (lambda k=k: job(k)) for k in range(8)}, at_once=3)
    assert list(got) == [str(k) for k in range(8)] and most[0] == 3
    assert isinstance(got["3"], ValueError) and all(got[k] == f"t-{k}" for k in got if k != "3")


def test_export_goes_on_after_a_failure(spark):
    tables = {f"t{k}": (lambda k=k: spark.range(k)) for k in range(6)}
    tables["bad"] = lambda: spark.range(1).select(F.raise_error(F.lit("no")).alias("x"))
    tables["gone"] = lambda: spark.table("does_not_exist")
    path = scratch_path(spark, "export-many")
    rows = {r["table"]: r for r in sinks.export_tables(spark, tables, path).collect()}
    assert list(rows) == list(tables) and [rows[f"t{k}"]["rows"] for k in range(6)] == list(range(6))
    assert not rows["bad"]["ok"] and "no" in rows["bad"]["error"] and not rows["gone"]["ok"]
    assert spark.read.parquet(f"{path}/t5").count() == 5


def test_ingest_names_what_failed(spark):
    base = scratch_path(spark, "ingest-many")
    for k in range(3):
        files.write_csv(spark.range(k + 1).withColumn("s", F.lit("a\nb")), f"{base}/raw/x_t{k}_y.csv")
    assert [t for t, _ in files.ingest_folder(spark, f"{base}/raw", f"{base}/out", multiline=True)] == ["t0", "t1", "t2"]
    assert spark.read.parquet(f"{base}/out/t2").count() == 3
    os.makedirs(f"{base}/raw/x_bad_y.csv")  # a folder without a file
    with pytest.raises(RuntimeError, match="x_bad_y.csv"):
        files.ingest_folder(spark, f"{base}/raw", f"{base}/out2", multiline=True)
    assert spark.read.parquet(f"{base}/out2/t2").count() == 3
