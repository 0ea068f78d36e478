"""Window operators: top-n per key, last-n by an order column."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_n_per(df: DataFrame, keys: list[str], order: list[Column], n: int = 1) -> DataFrame:
    """The first `n` rows of every key group by `order` (add a tie-breaker column to make it
    deterministic).  Row-number window: one sort per key partition."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


def last_n(df: DataFrame, order_col: str, n: int) -> DataFrame:
    """The `n` rows with the greatest `order_col`, returned in ascending order
    (a top-k: each task keeps only its own n best rows before the final merge)."""
    return df.orderBy(F.col(order_col).desc()).limit(n).orderBy(order_col)
