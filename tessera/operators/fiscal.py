"""Fiscal calendars beside the Gregorian one: fiscal years of shifted months, and fiscal years of
whole weeks (4-4-5 and its variants).

Both are built from a few bounded tables (one row per fiscal month, at most 12 a year) and column
expressions over days; nothing depends on fact data."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions import dates as D

# Weeks of the three months of a quarter.
QUARTER_WEEK_TYPES = {"445": (4, 4, 5), "454": (4, 5, 4), "544": (5, 4, 4)}
WEEKLY_TYPES = ("Last", "Nearest", "Custom")


def two(c: Column) -> Column:
    return F.lpad(c.cast("string"), 2, "0")


# --- fiscal years of shifted months ---------------------------------------------------------------

def fiscal_columns(cfg, today: Column) -> list[Column]:
    """Fiscal Gregorian columns for a frame with a ``date`` column.

    The months are moved so that the fiscal year begins in January of the year it is named after;
    year, quarter and month are then those of the moved month."""
    first = cfg.fiscal_first_month
    move = (13 - first) % 12 if cfg.fiscal_named_by_last_day else 1 - first
    d = F.col("date")
    moved = lambda c: F.add_months(F.trunc(c, "month"), move)
    back = lambda c: F.add_months(c, -move)
    m = moved(d)
    year, quarter, month = F.year(m), F.quarter(m), F.month(m)
    start_year, start_quarter = back(F.trunc(m, "year")), back(F.trunc(m, "quarter"))
    end_year, end_quarter = F.date_sub(F.add_months(start_year, 12), 1), F.date_sub(F.add_months(start_quarter, 3), 1)
    week = lambda c: D.year_week_number(c, cfg.first_day_of_week)
    months = lambda c: F.year(c) * 12 + F.month(c)
    quarters = lambda c: F.year(c) * 4 + F.quarter(c)
    days = lambda a, b: F.datediff(b, a) + 1
    start_month, end_month = F.trunc(d, "month"), F.last_day(d)
    return [
        year.alias("fiscal_year_number"),
        F.concat(F.lit("F "), year.cast("string")).alias("fiscal_year"),
        quarter.alias("fiscal_quarter_number"),
        F.concat(F.lit("FQ"), quarter.cast("string"), F.lit(" ")).alias("fiscal_quarter"),
        (quarters(m) - 1).alias("fiscal_year_quarter_number"),
        month.alias("fiscal_month_number"),
        (months(m) - 1).alias("fiscal_year_month_number"),
        (week(d) - week(start_year) + 1).cast("int").alias("fiscal_week_number"),
        (week(d) - week(today)).alias("fiscal_relative_week_pos"),
        (months(m) - months(moved(today))).alias("fiscal_relative_month_pos"),
        (quarters(m) - quarters(moved(today))).alias("fiscal_relative_quarter_pos"),
        (year - F.year(moved(today))).alias("fiscal_relative_year_pos"),
        start_month.alias("fiscal_start_of_month"), end_month.alias("fiscal_end_of_month"),
        start_quarter.alias("fiscal_start_of_quarter"), end_quarter.alias("fiscal_end_of_quarter"),
        start_year.alias("fiscal_start_of_year"), end_year.alias("fiscal_end_of_year"),
        days(start_month, end_month).alias("fiscal_month_days"),
        days(start_quarter, end_quarter).alias("fiscal_quarter_days"),
        days(start_year, end_year).alias("fiscal_year_days"),
        days(start_month, d).alias("fiscal_day_of_month"), days(start_quarter, d).alias("fiscal_day_of_quarter"),
        days(start_year, d).alias("fiscal_day_of_year"),
        F.date_sub(d, 7).alias("fiscal_date_previous_week"),
        D.same_day_months_back(d, 1).alias("fiscal_date_previous_month"),
        D.same_day_months_back(d, 3).alias("fiscal_date_previous_quarter"),
        D.same_day_months_back(d, 12).alias("fiscal_date_previous_year"),
    ]


# --- fiscal years of whole weeks ----------------------------------------------------------------------

def weekly_years(bounds: DataFrame, cfg) -> DataFrame:
    """(fw_year, fw_start, fw_end), one row per fiscal year.

    "Last": a year begins with the week that holds its first day.  "Nearest": with the week that
    holds most of the days around it, which is the week of the day three days later.  Either way
    it ends the day before the next one begins.  "Custom": the years of ``cfg.custom_periods`` (rows
    or a frame), which must begin on the first day of the week unless ``cfg.ignore_weekly``."""
    if cfg.weekly_type not in WEEKLY_TYPES:
        raise ValueError(f"unknown weekly type {cfg.weekly_type!r}")
    if cfg.weekly_type == "Custom" or cfg.ignore_weekly:
        if cfg.custom_periods is None:
            raise ValueError("custom periods are needed")
        own = cfg.custom_periods
        if not isinstance(own, DataFrame):
            from tessera.session import literal_frame
            own = literal_frame(bounds.sparkSession, own, "fw_year int, fw_start string, fw_end string")
        own = own.select("fw_year", F.to_date("fw_start").alias("fw_start"), F.to_date("fw_end").alias("fw_end"))
        if cfg.ignore_weekly:
            return own
        fits = D.weekday_number("fw_start", cfg.first_day_of_week) == 1
        return own.withColumn("fw_start", F.when(fits, F.col("fw_start")).otherwise(F.raise_error(
            F.lit("custom fiscal periods do not start on the first day of week"))))
    early = 1 if cfg.fiscal_first_month > 1 and cfg.fiscal_named_by_last_day else 0
    more = 1 if cfg.fiscal_first_month > 1 else 0
    inside = 3 if cfg.weekly_type == "Nearest" else 0
    years = bounds.select(F.explode(F.sequence(F.col("first_year") - more, F.col("last_year") + more)).alias("fw_year"))

    def begins(year: Column) -> Column:
        day = F.date_add(F.make_date(year - early, F.lit(cfg.fiscal_first_month), F.lit(1)), inside)
        return F.date_sub(day, D.weekday_number(day, cfg.first_day_of_week) - 1)

    return years.select("fw_year", begins(F.col("fw_year")).alias("fw_start"),
                        F.date_sub(begins(F.col("fw_year") + 1), 1).alias("fw_end"))


def weekly_months(years: DataFrame, weeks: tuple[int, int, int]) -> DataFrame:
    """One row per fiscal month: its year, number, first and last day, and those of its quarter and
    year.  Every month but the last has the weeks of the pattern; the last takes what remains."""
    starts, at = [], 0
    for month in range(1, 13):
        starts.append(F.struct(F.lit(month).alias("month"), F.lit(7 * at).alias("skip")))
        at += weeks[(month - 1) % 3]
    m = years.select("*", F.explode(F.array(*starts)).alias("p")).select(
        "fw_year", "fw_start", "fw_end", F.col("p.month").alias("fw_month_number"),
        F.date_add("fw_start", F.col("p.skip")).alias("m_start")).filter("m_start <= fw_end")
    m = m.withColumn("fw_quarter_number", F.expr("(fw_month_number + 2) div 3").cast("int"))
    year = Window.partitionBy("fw_year").orderBy("fw_month_number")
    m = m.withColumn("m_end", F.coalesce(F.date_sub(F.lead("m_start").over(year), 1), "fw_end"))
    quarter = Window.partitionBy("fw_year", "fw_quarter_number")
    return m.withColumns({"q_start": F.min("m_start").over(quarter), "q_end": F.max("m_end").over(quarter)})


def _before(months: DataFrame, what: str, number: Column, first: str, last: str) -> DataFrame:
    """Numbered periods as seen from the period after them: (`what`_no, first and last day)."""
    return months.select((number + 1).alias(f"{what}_no"), F.col(first).alias(f"{what}_first"),
                         F.col(last).alias(f"{what}_last")).distinct()


def weekly_calendar(bounds: DataFrame, cfg) -> DataFrame:
    """Fiscal weekly columns per date."""
    if cfg.quarter_week_type not in QUARTER_WEEK_TYPES:
        raise ValueError("quarter week type supports only 445, 454 and 544")
    months = weekly_months(weekly_years(bounds, cfg), QUARTER_WEEK_TYPES[cfg.quarter_week_type])
    year, quarter, month = F.col("fw_year"), F.col("fw_quarter_number"), F.col("fw_month_number")
    quarter_no, month_no = (year * 4 - 1 + quarter).cast("int"), (year * 12 - 1 + month).cast("int")
    days = months.withColumns({"quarter_no": quarter_no, "month_no": month_no, "year_no": year})
    for what, number, first, last in (("month", month_no, "m_start", "m_end"), ("quarter", quarter_no, "q_start", "q_end"),
                                      ("year", year, "fw_start", "fw_end")):
        days = days.join(_before(months, what, number, first, last), f"{what}_no", "left")
    now = bounds.select(F.to_date("today").alias("today"))
    at = months.join(now, F.col("today").between(F.col("m_start"), F.col("m_end"))).select(
        year.alias("now_year"), quarter_no.alias("now_quarter"), month_no.alias("now_month"), "today")
    days = days.join(F.broadcast(at), F.lit(True), "left")  # one row: where today is
    days = days.withColumn("date", F.explode(F.sequence("m_start", "m_end")))

    d, fdw = F.col("date"), cfg.first_day_of_week
    count = lambda a, b: F.datediff(F.col(b) if isinstance(b, str) else b, F.col(a)) + 1
    week = F.expr("(datediff(date, fw_start) + 7) div 7").cast("int")
    period = F.expr("(datediff(date, fw_start) + 28) div 28").cast("int")

    def same_day_before(what: str, first: str, last: str) -> Column:
        # the last day answers to the last day, any other to the same day or the last there is
        shifted = F.date_add(F.col(f"{what}_first"), F.datediff(d, F.col(first)))
        return F.when(d == F.col(last), F.col(f"{what}_last")).otherwise(F.least(shifted, F.col(f"{what}_last")))

    text = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])
    return days.select(
        "date", "fw_year", text("FW ", year).alias("fw_year_label"), count("fw_start", d).alias("fw_day_of_year"),
        week.alias("fw_week_number"), "fw_quarter_number", "fw_month_number", period.alias("fw_period_number"),
        F.col("quarter_no").alias("fw_year_quarter_number"), F.col("month_no").alias("fw_year_month_number"),
        text("FWQ", quarter).alias("fw_quarter"), text("FWQ", quarter, " ", year).alias("fw_quarter_year"),
        text("FWP", two(month)).alias("fw_month"), text("FWP", two(month), " ", year).alias("fw_month_year"),
        text("FWW", two(week)).alias("fw_week"), text("FWW", two(week), " ", year).alias("fw_week_year"),
        text("FWP", two(period)).alias("fw_period"),
        (D.year_week_number(d, fdw) + 1).alias("fw_year_week_number"),
        F.date_sub(d, D.weekday_number(d, fdw) - 1).alias("fw_start_of_week"),
        F.date_add(d, 7 - D.weekday_number(d, fdw)).alias("fw_end_of_week"),
        (D.year_week_number(d, fdw) - D.year_week_number("today", fdw)).alias("fw_relative_week_pos"),
        (F.col("month_no") - F.col("now_month")).alias("fw_relative_month_pos"),
        (F.col("quarter_no") - F.col("now_quarter")).alias("fw_relative_quarter_pos"),
        (year - F.col("now_year")).alias("fw_relative_year_pos"),
        F.col("m_start").alias("fw_start_of_month"), F.col("m_end").alias("fw_end_of_month"),
        F.col("q_start").alias("fw_start_of_quarter"), F.col("q_end").alias("fw_end_of_quarter"),
        F.col("fw_start").alias("fw_start_of_year"), F.col("fw_end").alias("fw_end_of_year"),
        count("m_start", "m_end").alias("fw_month_days"), count("q_start", "q_end").alias("fw_quarter_days"),
        count("fw_start", "fw_end").alias("fw_year_days"), count("m_start", d).alias("fw_day_of_month"),
        count("q_start", d).alias("fw_day_of_quarter"), F.date_sub(d, 7).alias("fw_date_previous_week"),
        same_day_before("month", "m_start", "m_end").alias("fw_date_previous_month"),
        same_day_before("quarter", "q_start", "q_end").alias("fw_date_previous_quarter"),
        same_day_before("year", "fw_start", "fw_end").alias("fw_date_previous_year"))
