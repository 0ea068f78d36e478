"""Several independent Spark jobs at once, each in a job group of its own, under a bound."""
from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

AT_ONCE = 4


def run_all(spark: SparkSession, name: str, jobs: dict[str, Callable[[], object]], at_once: int = AT_ONCE) -> dict[str, object]:
    """Run `jobs` (name -> function) with at most `at_once` in flight: results by name, in the order given.  An
    exception is the result of its job; the others go on."""
    def run(job: str, fn: Callable[[], object]) -> object:
        spark.sparkContext.setJobGroup(f"{name}-{job}", f"{name}: {job}")
        try:
            return fn()
        except Exception as e:  # noqa: BLE001 - reported by the caller
            return e

    with ThreadPoolExecutor(max_workers=max(1, at_once)) as pool:
        waiting = {job: pool.submit(inheritable_thread_target(spark)(lambda j=job, f=fn: run(j, f))) for job, fn in jobs.items()}
        return {job: w.result() for job, w in waiting.items()}
