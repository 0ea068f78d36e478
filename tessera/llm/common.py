"""Small helpers shared by the operators of this subpackage."""
from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import scratch_path

#: A word is a run without the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
#: A-Z to a-z and nothing else, for ``bytes.translate`` (letters outside ASCII stay as they are).
ASCII_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(col: Column | str) -> Column:
    """Remainder 0..3 that splits documents into folds; null ids have none (null)."""
    return F.crc32(F.col(col).cast("string").cast("binary")) % 4 if isinstance(col, str) else \
        F.crc32(col.cast("string").cast("binary")) % 4


def held_out(col: str = "doc_id") -> Column:
    """True in the fold that is never learned from; a null id is never learned from either."""
    return F.coalesce(fold(col) == 2, F.lit(True))


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate table once to the shared checkpoint folder and read it back, so
    that later branches scan it and a lost executor costs no recomputation of its lineage."""
    spark = df.sparkSession
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, name: str) -> str:
    """`name`, or with underscores added until the frame has no such column (extra columns
    of a caller may clash with ours)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
