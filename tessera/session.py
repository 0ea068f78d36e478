"""Spark session helpers.

Only settings a Spark user would set for an analytics job live here: AQE,
UTC session time zone, Arrow for pandas exchange, shuffle sizing.  The
checkpoint folder is read from the session (`spark.checkpoint.dir`, set by the
cluster); a scratch folder is only chosen when it is unset, as in tests.
"""
from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.ansi.enabled": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "tessera", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the package defaults."""
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    for k, v in DEFAULT_CONF.items():
        if not k.startswith("spark.ui."):
            spark.conf.set(k, v)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder of the cluster; a scratch folder only if unset and every
    executor runs in this process (``local[*]``).  On a cluster an unset folder, or one
    without a scheme and unknown to the other machines, is refused rather than guessed."""
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="tessera-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    return d


def materialize(df: DataFrame) -> DataFrame:
    """Write a small, reused intermediate (a dimension, per-period partials, resampled
    series) once as a parquet table in the shared checkpoint folder and read it back:
    later branches of the plan scan it instead of recomputing its lineage (one job, no
    second checkpoint pass), and it survives executor loss."""
    spark = df.sparkSession
    path = scratch_path(spark, f"mat-{uuid.uuid4().hex}")
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def literal_frame(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A small constant table computed on the JVM: a ``range`` of row numbers whose columns
    pick values out of literal arrays.  No Python worker or serialisation round trip (unlike
    ``createDataFrame`` of a list), and unlike a literal relation the optimizer does not try
    to fold whole downstream pipelines at planning time."""
    from pyspark.sql import functions as F
    from pyspark.sql.types import _parse_datatype_string
    st = _parse_datatype_string(schema)
    if not rows:
        return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in st.fields])
    idx = F.col("id").cast("int") + 1
    cols = []
    for j, f in enumerate(st.fields):
        arr = F.array(*[F.lit(r[j]).cast(f.dataType) for r in rows])
        cols.append(F.element_at(arr, idx).alias(f.name))
    return spark.range(len(rows)).select(*cols)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for intermediate tables; the folder's
    scheme (``file:``, ``hdfs:``, ``s3a:``) is kept."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}"
    _SCRATCH.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


_SCRATCH: dict[str, list[str]] = {}


def drop_scratch(spark: SparkSession) -> int:
    """Delete every intermediate folder this application has made so far (results that read them
    must have been written by then).  Returns how many."""
    hadoop, jvm = spark.sparkContext._jsc.hadoopConfiguration(), spark.sparkContext._jvm
    paths = _SCRATCH.pop(spark.sparkContext.applicationId, [])
    for p in paths:
        where = jvm.org.apache.hadoop.fs.Path(p)
        where.getFileSystem(hadoop).delete(where, True)
    return len(paths)
