"""Join operators: merges, look-ups, join-back of results, name exclusion."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def merge_left(left: DataFrame, right: DataFrame, left_key: str, right_key: str, cols: list[str],
               rename: dict | None = None, null_safe: bool = False) -> DataFrame:
    """Left merge that expands the chosen `cols` of `right` (renamed by `rename`).

    Like a table merge, several matches fan out; reduce `right` first if it
    must be a look-up.  `null_safe` also matches NULL keys with each other.
    """
    rename = rename or {}
    r = right.select(F.col(right_key).alias("_rk"), *[F.col(c).alias(rename.get(c, c)) for c in cols])
    cond = left[left_key].eqNullSafe(r["_rk"]) if null_safe else left[left_key] == r["_rk"]
    return left.join(r, cond, "left").drop("_rk")


def one_per_key(df: DataFrame, key: str, order_col: str | None = None) -> DataFrame:
    """Reduce a look-up side to one row per key (the row with the greatest `order_col`,
    ties and no order -> greatest row by value), so a join on it cannot fan out."""
    others = [c for c in df.columns if c != key]
    ordering = [order_col] if order_col else []
    st = F.struct(*[F.col(c) for c in ordering + others])
    return df.groupBy(key).agg(F.max(st).alias("_s")).select(key, *[F.col(f"_s.{c}").alias(c) for c in others])


def attach_result(df: DataFrame, result: DataFrame, id_col: str, cols: list[str]) -> DataFrame:
    """Join per-id results (`cols`) back to their source.  The result side is reduced to one row per
    id first, so duplicate ids never fan out."""
    res = one_per_key(result.select(id_col, *cols), id_col).withColumnRenamed(id_col, "_rid")
    return df.join(res, df[id_col].eqNullSafe(res["_rid"]), "left").drop("_rid")


def extend_lookup(lookup: DataFrame, rows: DataFrame) -> DataFrame:
    """Append look-up rows (by column name)."""
    return lookup.unionByName(rows)


def translate_lookup(df: DataFrame, lookup: DataFrame, key: str, value: str, out_col: str | None = None) -> DataFrame:
    """Left look-up join of a translation table (one row per key)."""
    lk = one_per_key(lookup.select(key, value), key)
    if out_col:
        lk = lk.withColumnRenamed(value, out_col)
    return df.join(lk, key, "left")


def exclude_by_name(a: DataFrame, b: DataFrame, col: str, b_col: str | None = None) -> DataFrame:
    """Rows of `a` whose `col` does not occur in `b` (NOT IN as a left anti join)."""
    b_col = b_col or col
    bb = b.select(F.col(b_col).alias("_x")).distinct()
    return a.join(bb, a[col] == bb["_x"], "left_anti")
