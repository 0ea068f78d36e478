"""Many-series time operators: cleaning, resampling with zero-filled gaps, fills,
hold-out split.  Series are partitioned by their keys; windows run per series
over resampled buckets (bounded by the time range, not by fact rows)."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FREQS = ("D", "W", "M")


def clean_sales(df: DataFrame, date_col: str, value_col: str, from_year: int,
                exclude_months: list[tuple[int, int]] = (), status_col: str | None = None,
                status: str | None = None) -> DataFrame:
    """Keep rows from `from_year` on, drop the (year, month) pairs of `exclude_months`
    (and other statuses), and rename to (sales, date)."""
    d = F.col(date_col)
    cond = d >= F.lit(f"{from_year:04d}-01-01").cast("date")  # on the column itself: it reaches the scan
    for y, m in exclude_months:
        cond = cond & ~((F.year(d) == y) & (F.month(d) == m))
    if status_col is not None:
        cond = cond & (F.col(status_col) == status)
    return df.filter(cond).select(F.col(value_col).alias("sales"), d.alias("date"))


def bucket(ts, freq: str) -> Column:
    """Bucket label: day; week ending Sunday (the Sunday itself belongs to its week); month end."""
    d = F.to_date(F.col(ts) if isinstance(ts, str) else ts)
    if freq == "D":
        return d
    if freq == "W":
        return F.next_day(F.date_sub(d, 1), "Sun")
    if freq == "M":
        return F.last_day(d)
    raise ValueError(f"freq must be one of {FREQS}")


def resample(df: DataFrame, ts: str, val: str, freq: str, keys: list[str] | None = None) -> DataFrame:
    """Sum `val` per (keys, bucket); every bucket between a series' first and last one
    is present, empty ones with 0.  Output: keys…, ds, y."""
    keys = keys or []
    agg = df.groupBy(*keys, bucket(ts, freq).alias("ds")).agg(F.sum(val).alias("y"))
    rng = agg.groupBy(*keys).agg(F.min("ds").alias("_lo"), F.max("ds").alias("_hi"))
    if freq == "M":
        n = F.months_between(F.col("_hi"), F.col("_lo")).cast("int")
        spine = rng.select(*keys, "_lo", F.explode(F.sequence(F.lit(0), n)).alias("_i")) \
            .select(*keys, F.last_day(F.add_months(F.col("_lo"), F.col("_i"))).alias("ds"))
    else:
        step = F.expr("INTERVAL 1 DAY") if freq == "D" else F.expr("INTERVAL 7 DAYS")
        spine = rng.select(*keys, F.explode(F.sequence("_lo", "_hi", step)).alias("ds"))
    have = agg.select(*[F.col(k).alias(f"_r_{k}") for k in keys], F.col("ds").alias("_ds"), "y")
    same = [spine[k].eqNullSafe(have[f"_r_{k}"]) for k in keys] + [spine["ds"] == have["_ds"]]  # a null key is a series
    return spine.join(have, same, "left").select(*keys, "ds", F.coalesce(F.col("y"), F.lit(0.0)).alias("y"))


def ffill(df: DataFrame, keys: list[str], order: str, col: str, out: str | None = None) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(out or col, F.last(F.col(col), ignorenulls=True).over(w))


def bfill(df: DataFrame, keys: list[str], order: str, col: str, out: str | None = None) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(0, Window.unboundedFollowing)
    return df.withColumn(out or col, F.first(F.col(col), ignorenulls=True).over(w))


def drop_last(df: DataFrame, keys: list[str], order: str, n: int = 1) -> DataFrame:
    """Drop the last `n` buckets of each series (an incomplete trailing period)."""
    w = Window.partitionBy(*keys).orderBy(F.col(order).desc())
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") > n).drop("_rn")


def split_last(df: DataFrame, keys: list[str], order: str, h: int) -> DataFrame:
    """Mark the last `h` points of every series as 'test', the rest 'train'."""
    w = Window.partitionBy(*keys).orderBy(F.col(order).desc())
    return df.withColumn("split", F.when(F.row_number().over(w) <= h, "test").otherwise("train"))
