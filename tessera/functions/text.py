"""Text and display helpers (built-in expressions only)."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Measure display formats.
CURRENCY_FORMATS = {
    '"R$" #,0': ("R$ ", 0),
    '"R$"#,0.00': ("R$", 2),
}


def format_measure(c, fmt: str) -> Column:
    """Render a number with a currency display format ('"R$" #,0' or '"R$"#,0.00');
    negatives get a leading minus, as in the format's negative section."""
    c = F.col(c) if isinstance(c, str) else c
    if fmt not in CURRENCY_FORMATS:
        raise ValueError(f"unsupported format {fmt!r}")
    prefix, digits = CURRENCY_FORMATS[fmt]
    r = F.round(c, digits)
    body = F.concat(F.lit(prefix), F.format_number(F.abs(r), digits))
    return F.when(r < 0, F.concat(F.lit("-"), body)).otherwise(body)


def length_profile(df: DataFrame, text_col: str, by: list[str] | None = None) -> DataFrame:
    """count / mean / stddev / min / quartiles / max of ``length(text)``.

    Quartiles are exact discrete quantiles (SQL ``percentile_disc``: the smallest
    length whose cumulative count reaches ceil(p·n)), computed from a histogram of lengths: the data is
    reduced to (group, length, count) first, so no group's rows are gathered
    into one task; the window then runs over distinct lengths only.
    """
    keep = list(by or [])
    by = keep or ["_all"]
    ln = F.length(F.col(text_col)).alias("_len")
    base = df.select(*(keep or [F.lit(0).alias("_all")]), ln).filter(F.col("_len").isNotNull())
    hist = base.groupBy(*by, "_len").agg(F.count(F.lit(1)).alias("_c"))
    w = Window.partitionBy(*by).orderBy("_len").rowsBetween(Window.unboundedPreceding, 0)
    hist = hist.withColumns({"_cum": F.sum("_c").over(w), "n": F.sum("_c").over(Window.partitionBy(*by))})
    # one aggregation over the histogram, so no join has to match groups (a null group is one)
    at = lambda p: F.min(F.when(F.col("_cum") >= F.ceil(F.col("n") * p), F.col("_len")))
    total, n = F.sum(F.col("_c") * F.col("_len").cast("double")), F.sum("_c")
    squares = F.sum(F.col("_c") * F.col("_len").cast("double") * F.col("_len"))
    out = hist.groupBy(*by).agg(
        n.alias("n"), (total / n).alias("mean"),
        F.when(n > 1, F.sqrt(F.greatest(squares - total * total / n, F.lit(0.0)) / (n - 1))).alias("stddev"),
        F.min("_len").alias("min"), F.max("_len").alias("max"), at(0.25).alias("q1"), at(0.5).alias("median"),
        at(0.75).alias("q3"))
    return out.select(*keep, "n", "mean", "stddev", "min", "q1", "median", "q3", "max")


def text_profile(df: DataFrame, cols: list[str]) -> DataFrame:
    """Length profile of several text columns, one row per column (``column`` names it)."""
    out = None
    for c in cols:
        p = length_profile(df, c).withColumn("column", F.lit(c))
        out = p if out is None else out.unionByName(p)
    return out.select("column", "n", "mean", "stddev", "min", "q1", "median", "q3", "max")
