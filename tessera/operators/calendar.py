"""Date dimension: Gregorian calendar, fiscal Gregorian calendar, fiscal weekly
(4-4-5 / 4-5-4 / 5-4-4) calendar, holidays and working days.

The year range normally comes from the data (``year_bounds(fact, ts)``), so
the dimension is derived by Spark from the fact and no value passes through
the driver.  One row per day: ``explode(sequence(first, last))`` then column
expressions; the result is bounded by the year range (366 rows per year).

Notes kept on purpose:
* ``quarter`` labels carry a trailing space ("Q1 ").
* Relative positions are measured against `today` (an argument, never the
  wall clock), so the output is reproducible.
"""
from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import dates as D
from tessera.operators.fiscal import fiscal_columns, weekly_calendar
from tessera.operators.holidays import DEFAULT_WORKING_DAYS, holidays, one_per_date

# Labels used by the calendar.
WORKING_DAY_LABEL = "Working day"
NON_WORKING_DAY_LABEL = "Non-working day"


@dataclass
class CalendarConfig:
    country: str = "PT"                    # holiday country, "" = none
    first_day_of_week: int = 0             # 0 = Sunday, 1 = Monday, …
    working_days: tuple = DEFAULT_WORKING_DAYS
    fiscal_first_month: int = 1
    fiscal_named_by_last_day: bool = True  # fiscal year named after the calendar year it ends in
    weekly_type: str = "Last"              # "Last", "Nearest" or "Custom"
    quarter_week_type: str = "445"
    calendar_range: str = "Calendar"       # "Calendar", "FiscalGregorian", "FiscalWeekly"
    custom_periods: object = None          # [(fiscal_year, 'yyyy-mm-dd', 'yyyy-mm-dd'), …] or a frame of those
    ignore_weekly: bool = False            # custom years only, on any first weekday
    include_fiscal: bool = False
    include_weekly: bool = False
    extra: dict = field(default_factory=dict)


def year_bounds(df: DataFrame, ts_col: str) -> DataFrame:
    """One row (first_year, last_year, today) derived from a date/timestamp column of the data;
    `today` is the latest date present."""
    c = F.col(ts_col)
    return df.agg(F.min(F.year(c)).alias("first_year"), F.max(F.year(c)).alias("last_year"),
                  F.max(F.to_date(c)).alias("today"))


def fixed_bounds(spark: SparkSession, first_year: int, last_year: int, today: str) -> DataFrame:
    from tessera.session import literal_frame
    return literal_frame(spark, [(first_year, last_year, today)], "first_year int, last_year int, today string") \
        .withColumn("today", F.to_date("today"))


def calendar(spark: SparkSession, bounds: DataFrame, cfg: CalendarConfig | None = None,
             today: str | None = None) -> DataFrame:
    """The Date dimension over the years of `bounds` (first_year, last_year[, today]).

    Days run from 1 January of first_year-1 to 31 December of last_year+1 and are
    then kept by `cfg.calendar_range`.
    """
    cfg = cfg or CalendarConfig()
    fdw = cfg.first_day_of_week
    # the bounds are one aggregate row (two years and a date): read it once and generate the
    # dimension from JVM ranges, so no branch of the plan re-runs the aggregate over the fact
    row = bounds.select(F.col("first_year").cast("int"), F.col("last_year").cast("int"),
                        F.col("today").cast("date").cast("string")).first()
    if row is None or row[0] is None:
        raise ValueError("calendar bounds are empty")
    b = fixed_bounds(spark, row[0], row[1], today if today is not None else row[2])
    days = b.select("first_year", "last_year", "today", F.explode(F.sequence(
        F.make_date(F.col("first_year") - 1, F.lit(1), F.lit(1)),
        F.make_date(F.col("last_year") + 1, F.lit(12), F.lit(31)))).alias("date"))
    years = spark.range(row[0] - 1, row[1] + 2).select(F.col("id").cast("int").alias("year"))
    hol = one_per_date(holidays(spark, years, cfg.country, cfg.working_days)) \
        .select("date", F.col("holiday_name"))
    # holiday list: bounded by rules x years -> broadcast is safe
    days = days.join(F.broadcast(hol), "date", "left")

    d, t = F.col("date"), F.col("today")
    y, m, q = F.year(d), F.month(d), F.quarter(d)
    wn = D.weeknum(d, fdw)
    ywn = D.year_week_number(d, fdw)
    som = F.trunc(d, "month")
    eom = F.last_day(d)
    soq = F.make_date(y, (q - 1) * 3 + 1, F.lit(1))
    eoq = F.last_day(F.add_months(soq, 2))
    soy = F.make_date(y, F.lit(1), F.lit(1))
    eoy = F.make_date(y, F.lit(12), F.lit(31))
    cal_first = F.make_date(F.col("first_year") - 1, F.lit(1), F.lit(1))

    def in_range(c: Column) -> Column:
        return F.when(c >= cal_first, c)

    working = D.dow0(d).isin(list(cfg.working_days)) & F.col("holiday_name").isNull()
    cols = [
        d.alias("date"),
        D.date_key(d).alias("date_key"),
        F.dayofmonth(d).alias("day_of_month"),
        D.weekday_number(d, fdw).alias("week_day_number"),
        F.date_format(d, "EEE").alias("week_day"),
        D.seq365(d).alias("sequential365_day_number"),
        y.alias("year_number"),
        y.cast("string").alias("year"),
        q.alias("quarter_number"),
        F.concat(F.lit("Q"), q.cast("string"), F.lit(" ")).alias("quarter"),
        (y * 4 - 1 + q).alias("year_quarter_number"),
        F.concat(F.lit("Q"), q.cast("string"), F.lit(" "), y.cast("string")).alias("quarter_year"),
        m.alias("month_number"),
        F.date_format(d, "MMM").alias("month"),
        (y * 12 - 1 + m).alias("year_month_number"),
        F.concat(F.date_format(d, "MMM"), F.lit(" "), y.cast("string")).alias("month_year"),
        wn.alias("week_number"),
        F.concat(F.lit("W"), F.lpad(wn.cast("string"), 2, "0")).alias("week"),
        ywn.alias("year_week_number"),
        F.concat(F.lit("W"), F.lpad(wn.cast("string"), 2, "0"), F.lit("-"), y.cast("string")).alias("week_year"),
        (y * 100 + wn).alias("week_year_order"),
        (ywn - D.year_week_number(t, fdw)).alias("relative_week_pos"),
        ((y * 12 + m) - (F.year(t) * 12 + F.month(t))).alias("relative_month_pos"),
        ((y * 4 + q) - (F.year(t) * 4 + F.quarter(t))).alias("relative_quarter_pos"),
        (y - F.year(t)).alias("relative_year_pos"),
        som.alias("start_of_month"), eom.alias("end_of_month"),
        soq.alias("start_of_quarter"), eoq.alias("end_of_quarter"),
        soy.alias("start_of_year"), eoy.alias("end_of_year"),
        F.dayofmonth(eom).alias("month_days"),
        (F.datediff(eoq, soq) + 1).alias("quarter_days"),
        (F.datediff(eoy, soy) + 1).alias("year_days"),
        F.dayofmonth(d).alias("day_of_month_number"),
        (F.datediff(d, soq) + 1).alias("day_of_quarter_number"),
        F.dayofyear(d).alias("day_of_year_number"),
        in_range(F.date_sub(d, 7)).alias("date_previous_week"),
        in_range(D.same_day_months_back(d, 1)).alias("date_previous_month"),
        in_range(D.same_day_months_back(d, 3)).alias("date_previous_quarter"),
        in_range(D.same_day_months_back(d, 12)).alias("date_previous_year"),
        F.col("holiday_name"),
        working.alias("is_working_day"),
        F.when(working, WORKING_DAY_LABEL).otherwise(NON_WORKING_DAY_LABEL).alias("day_type"),
    ]
    keep = ["first_year", "last_year"]
    out = days.select(*cols, *keep)
    if cfg.include_fiscal or cfg.calendar_range == "FiscalGregorian":
        out = out.join(F.broadcast(b.select("today")), F.lit(True)).select("*", *fiscal_columns(cfg, F.col("today"))).drop("today")
    if cfg.include_weekly or cfg.calendar_range == "FiscalWeekly":
        wk = weekly_calendar(b, cfg)
        out = out.join(wk, "date", "left")
    rng = {"Calendar": "year_number", "FiscalGregorian": "fiscal_year_number", "FiscalWeekly": "fw_year"}
    if cfg.calendar_range not in rng:
        raise ValueError(f"unknown calendar range {cfg.calendar_range!r}")
    rc = F.col(rng[cfg.calendar_range])
    out = out.filter((rc >= F.col("first_year")) & (rc <= F.col("last_year")))
    return out.drop(*keep)
