"""Catalog listings of a model as DataFrames."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.plans.model import Model


def list_tables(spark: SparkSession, model: Model, exclude: list[str] | None = None, counts: bool = True) -> DataFrame:
    """(table_name, n_rows, n_columns, description, is_hidden): one row per model table; rows are
    counted unless `counts` is off (then n_rows is null and no table is read).  Tables named in
    `exclude` are left out before anything is read."""
    frames = []
    for name in model.tables:
        if name in (exclude or ()):
            continue
        df = model.table(name)
        n = df.agg(F.count(F.lit(1)).alias("n_rows")) if counts else spark.range(1).select(F.lit(None).cast("long").alias("n_rows"))
        frames.append(n.select(F.lit(name).alias("table_name"), "n_rows", F.lit(len(df.columns)).alias("n_columns")))
    out = reduce(DataFrame.unionByName, frames)
    return out.withColumns({"description": F.lit(None).cast("string"), "is_hidden": F.lit(None).cast("boolean")})


def list_relationships(spark: SparkSession, model: Model) -> DataFrame:
    """One row per relationship, with the rows of the many side and how many of them find no match
    on the other side.  Each table is read once for all relationships that start there, and once
    for those that end there: (relationship, key) pairs are counted map-side before the join."""
    rels = [r for r in model.relationships if r.from_table in model.tables and r.to_table in model.tables]
    from_keys, to_keys = [], []
    for table in dict.fromkeys(r.from_table for r in rels):
        own = [F.struct(F.lit(r.name).alias("name"), F.col(r.from_col).cast("string").alias("k"))
               for r in rels if r.from_table == table]
        from_keys.append(model.table(table).select(F.explode(F.array(*own)).alias("x")).select("x.*"))
    for table in dict.fromkeys(r.to_table for r in rels):
        own = [F.struct(F.lit(r.name).alias("name"), F.col(r.to_col).cast("string").alias("k"))
               for r in rels if r.to_table == table]
        to_keys.append(model.table(table).select(F.explode(F.array(*own)).alias("x")).select("x.*"))
    have = reduce(DataFrame.unionByName, from_keys).groupBy("name", "k").agg(F.count(F.lit(1)).alias("n"))
    known = reduce(DataFrame.unionByName, to_keys).distinct().select(F.col("name").alias("_n"), F.col("k").alias("_k"))
    j = have.join(known, (F.col("name") == F.col("_n")) & (F.col("k") == F.col("_k")), "left")
    counts = j.groupBy("name").agg(F.sum("n").alias("from_rows"), F.sum(F.when(F.col("_k").isNull(), F.col("n")).otherwise(0))
                                   .alias("unmatched_rows"))
    from tessera.session import literal_frame
    about = literal_frame(spark, [(r.name, r.from_table, r.from_col, r.to_table, r.to_col, r.cardinality,
                                   "both" if r.both else "single") for r in rels],
                          "name string, from_table string, from_col string, to_table string, to_col string, "
                          "cardinality string, cross_filter string")
    return about.join(counts, "name", "left").fillna(0, ["from_rows", "unmatched_rows"])
