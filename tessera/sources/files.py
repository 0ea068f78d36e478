"""CSV ingestion: single files and whole folders of files into tables."""
from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tessera.sources.parallel import AT_ONCE, run_all
from tessera.sources.sinks import write_table


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None, infer: bool = False,
             multiline: bool = False) -> DataFrame:
    """CSV with a header.  Without `schema` every column is a string unless `infer`;
    `multiline` reads quoted fields holding newlines, with "" as the escaped quote."""
    r = spark.read.option("header", True)
    if multiline:
        r = r.option("multiLine", True).option("quote", '"').option("escape", '"')
    if schema is not None:
        r = r.schema(schema)
    elif infer:
        r = r.option("inferSchema", True)
    return r.csv(path)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header; quotes escaped by doubling so multi-line text round-trips."""
    df.write.mode("overwrite").option("header", True).option("quote", '"').option("escape", '"').csv(path)


def table_name_from_file(name: str) -> str:
    """'shop_order_items_dataset.csv' -> 'order_items' (the middle parts of the name)."""
    stem = name[:-4] if name.lower().endswith(".csv") else name
    return "_".join(stem.split("_")[1:-1])


def list_csv(spark: SparkSession, folder: str) -> list[str]:
    """Names of the CSV entries (files or folders of part files) directly in `folder`.
    Metadata listing only; no data passes through the driver."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(folder)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.getPath().getName().lower().endswith(".csv"))


def ingest_folder(spark: SparkSession, src: str, dst: str, name_fn: Callable[[str], str] = table_name_from_file,
                  infer: bool = False, fmt: str = "parquet", multiline: bool = False, at_once: int = AT_ONCE) -> list[tuple[str, str]]:
    """Every CSV of `src` becomes table `dst/<name_fn(file)>`, overwritten (schema changes
    allowed), several files at once.  Returns [(table, path)]; if files failed, the others are written and
    an error names those that were not."""
    paths = {f: f"{dst.rstrip('/')}/{name_fn(f)}" for f in list_csv(spark, src)}

    def load(f: str) -> None:
        df = read_csv(spark, f"{src.rstrip('/')}/{f}", infer=infer, multiline=multiline)
        write_table(df, paths[f], fmt=fmt, overwrite_schema=True)

    done = run_all(spark, "ingest", {f: (lambda f=f: load(f)) for f in paths}, at_once)
    failed = {f: r for f, r in done.items() if isinstance(r, Exception)}
    if failed:
        raise RuntimeError("not ingested: " + "; ".join(f"{f}: {r}" for f, r in failed.items())) from next(iter(failed.values()))
    return [(name_fn(f), paths[f]) for f in paths]
