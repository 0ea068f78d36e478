"""Table sinks: overwrite, append with a run timestamp, export of a whole model."""
from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tessera.sources.parallel import AT_ONCE, run_all


def write_table(df: DataFrame, path: str, mode: str = "overwrite", fmt: str = "parquet",
                overwrite_schema: bool = False, partition_by: list[str] | None = None) -> None:
    """Write a table.  `overwrite_schema` lets an overwrite change the schema (a plain
    overwrite already does for parquet; for formats with a schema log it sets the option)."""
    w = df.write.format(fmt).mode(mode)
    if overwrite_schema and fmt != "parquet":
        w = w.option("overwriteSchema", "true")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def append_table(df: DataFrame, path: str, fmt: str = "parquet", ts_col: str = "prediction_ts") -> None:
    """Append rows stamped with the run time (history of runs, e.g. forecasts)."""
    df.withColumn(ts_col, F.current_timestamp()).write.format(fmt).mode("append").save(path)


def append_run(df: DataFrame, path: str, run_id: str, ts_col: str = "prediction_ts", run_col: str = "run_id") -> None:
    """Append the rows of one run, stamped with the run time, so that a run which is repeated after a failure
    leaves one copy: the run is a partition of the table, and only partitions that are written are replaced."""
    stamped = df.withColumn(ts_col, F.current_timestamp()).withColumn(run_col, F.lit(run_id))
    stamped.write.format("parquet").mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(run_col).save(path)


def latest_run(df: DataFrame, keys: list[str], ts_col: str = "prediction_ts") -> DataFrame:
    """Rows of the newest run per key: one row per key is reduced map-side, the history is not sorted."""
    last = df.groupBy(*keys).agg(F.max(ts_col).alias("_last")).select(*[F.col(k).alias(f"_k_{k}") for k in keys], "_last")
    same = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys] + [F.col(ts_col) == F.col("_last")]
    return df.join(last, same, "left_semi")


def export_tables(spark: SparkSession, tables: dict, dst: str, fmt: str = "parquet", at_once: int = AT_ONCE) -> DataFrame:
    """Write every table (name -> DataFrame factory) to `dst/<name>`, several at once; a failing table does
    not stop the others.  Returns (table, ok, error, rows): the whole error text, and the rows that
    were written, counted by the write itself."""
    from tessera.session import literal_frame

    def write(name: str, make) -> int:
        seen = Observation()
        write_table(make().observe(seen, F.count(F.lit(1)).alias("rows")), f"{dst.rstrip('/')}/{name}", fmt=fmt)
        return seen.get.get("rows", 0)

    done = run_all(spark, "export", {name: (lambda n=name, m=make: write(n, m)) for name, make in tables.items()}, at_once)
    status = [(name, False, f"{type(r).__name__}: {r}", None) if isinstance(r, Exception) else (name, True, None, r)
              for name, r in done.items()]
    return literal_frame(spark, status, "table string, ok boolean, error string, rows long")


def export_model(model, dst: str, fmt: str = "parquet") -> DataFrame:
    """Export every table of a model (see ``export_tables``)."""
    from pyspark.sql import SparkSession
    return export_tables(SparkSession.getActiveSession(), model.tables, dst, fmt)
