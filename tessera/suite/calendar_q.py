"""Registered queries: the Date dimension, holidays and fiscal calendars.

Every calendar is derived from the data (years of the order dates, `today` =
latest order date) and joined with the daily sales it describes."""
from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.dates import easter, nth_weekday
from tessera.operators.calendar import CalendarConfig, calendar, year_bounds
from tessera.operators.holidays import holidays
from tessera.plans.sales import orders_fact
from tessera.sources.tables import load
from tessera.suite.common import FACT_SQL, rounded
from tessera.suite.registry import query


def _daily(spark, sf):
    f = orders_fact(load(spark, sf, "orders"), load(spark, sf, "lineitem"))
    return f.groupBy(F.col("order_date").alias("date")).agg(F.round(F.sum("l_extendedprice"), 2).alias("total_sales"))


def _cal(spark, sf, cfg=None):
    return calendar(spark, year_bounds(load(spark, sf, "orders"), "o_orderdate"), cfg)


def _with_sales(spark, sf, cal):
    return cal.join(_daily(spark, sf), "date", "left")


# SQL building blocks -----------------------------------------------------------------
CAL_CTE = f"""b AS (SELECT min(year(o_orderdate)) AS y0, max(year(o_orderdate)) AS y1,
              max(CAST(o_orderdate AS DATE)) AS today FROM orders),
alld AS (SELECT CAST(unnest(generate_series(make_date(y0 - 1, 1, 1), make_date(y1 + 1, 12, 31), INTERVAL 1 DAY)) AS DATE) AS d
         FROM b),
cal AS (SELECT alld.d, b.y0, b.y1, b.today FROM alld, b WHERE year(alld.d) BETWEEN b.y0 AND b.y1),
ds AS (SELECT CAST(o_orderdate AS DATE) AS d, round(sum(l_extendedprice), 2) AS total_sales
       FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1)"""

# Easter by Gauss's method (an independent formula from the one in the library).
EASTER_SQL = """(make_date(y, 3, 22) + CAST(((19 * (y % 19) + ((15 - (13 + 8 * (y // 100)) // 25 + y // 100 - y // 400) % 30)) % 30
  + (2 * (y % 4) + 4 * (y % 7) + 6 * ((19 * (y % 19) + ((15 - (13 + 8 * (y // 100)) // 25 + y // 100 - y // 400) % 30)) % 30)
     + ((4 + y // 100 - y // 400) % 7)) % 7) AS INTEGER)
  - CASE WHEN ((19 * (y % 19) + ((15 - (13 + 8 * (y // 100)) // 25 + y // 100 - y // 400) % 30)) % 30) = 29
              AND ((2 * (y % 4) + 4 * (y % 7) + 6 * 29 + ((4 + y // 100 - y // 400) % 7)) % 7) = 6 THEN 7
         WHEN ((19 * (y % 19) + ((15 - (13 + 8 * (y // 100)) // 25 + y // 100 - y // 400) % 30)) % 30) = 28
              AND ((2 * (y % 4) + 4 * (y % 7) + 6 * 28 + ((4 + y // 100 - y // 400) % 7)) % 7) = 6
              AND ((11 * ((15 - (13 + 8 * (y // 100)) // 25 + y // 100 - y // 400) % 30) + 11) % 30) < 19 THEN 7
         ELSE 0 END)"""

PT_HOLIDAYS_SQL = f"""yrs AS (SELECT unnest(generate_series(y0 - 1, y1 + 1)) AS y FROM b),
pt_raw AS (
  SELECT make_date(y, m, dd) AS d, name, 100 AS prio FROM yrs, (VALUES
    (1, 1, 'New Year''s Day'), (4, 25, 'Freedom Day'), (5, 1, 'Labour Day'), (6, 10, 'Portugal Day'),
    (8, 15, 'Assumption Day'), (10, 5, 'Republic Day'), (11, 1, 'All Saints'' Day'),
    (12, 1, 'Restoration of Independence'), (12, 8, 'Immaculate Conception'), (12, 25, 'Christmas Day')) r(m, dd, name)
  UNION ALL SELECT CAST({EASTER_SQL} - 2 AS DATE), 'Good Friday', 50 FROM yrs
  UNION ALL SELECT CAST({EASTER_SQL} + 60 AS DATE), 'Corpus Christi', 50 FROM yrs),
pt AS (SELECT d, arg_min(name, (prio, name)) AS holiday_name FROM pt_raw GROUP BY d)"""


# --- queries ------------------------------------------------------------------------------

@query("calendar_core", sql=f"""
WITH {CAL_CTE}
SELECT cal.d AS date, CAST(year(d) * 10000 + month(d) * 100 + day(d) AS INTEGER) AS date_key,
       CAST(year(d) AS VARCHAR) AS year, 'Q' || quarter(d) || ' ' AS quarter, 'Q' || quarter(d) || ' ' || year(d) AS quarter_year,
       CAST(year(d) * 4 - 1 + quarter(d) AS INTEGER) AS year_quarter_number, strftime(d, '%b') AS month,
       strftime(d, '%b') || ' ' || year(d) AS month_year, CAST(year(d) * 12 - 1 + month(d) AS INTEGER) AS year_month_number,
       CAST(dayofweek(d) + 1 AS INTEGER) AS week_day_number, strftime(d, '%a') AS week_day,
       CAST(day(d) AS INTEGER) AS day_of_month, ds.total_sales
FROM cal LEFT JOIN ds USING (d)""")
def q_calendar_core(spark, sf):
    c = _with_sales(spark, sf, _cal(spark, sf))
    return c.select("date", "date_key", "year", "quarter", "quarter_year", "year_quarter_number", "month", "month_year",
                    "year_month_number", "week_day_number", "week_day", "day_of_month", "total_sales")


@query("calendar_positions", sql=f"""
WITH {CAL_CTE}
SELECT d AS date,
  CAST(floor(date_diff('day', DATE '1900-12-30', d) / 7) - floor(date_diff('day', DATE '1900-12-30', today) / 7) AS INTEGER) AS relative_week_pos,
  CAST((year(d) * 12 + month(d)) - (year(today) * 12 + month(today)) AS INTEGER) AS relative_month_pos,
  CAST((year(d) * 4 + quarter(d)) - (year(today) * 4 + quarter(today)) AS INTEGER) AS relative_quarter_pos,
  CAST(year(d) - year(today) AS INTEGER) AS relative_year_pos, ds.total_sales
FROM cal LEFT JOIN ds USING (d)""")
def q_calendar_positions(spark, sf):
    c = _with_sales(spark, sf, _cal(spark, sf))
    return c.select("date", "relative_week_pos", "relative_month_pos", "relative_quarter_pos", "relative_year_pos",
                    "total_sales")


@query("calendar_bounds", sql=f"""
WITH {CAL_CTE}
SELECT d AS date, CAST(date_trunc('month', d) AS DATE) AS start_of_month, last_day(d) AS end_of_month,
  CAST(date_trunc('quarter', d) AS DATE) AS start_of_quarter,
  CAST(date_trunc('quarter', d) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE) AS end_of_quarter,
  make_date(year(d), 1, 1) AS start_of_year, make_date(year(d), 12, 31) AS end_of_year,
  CAST(day(last_day(d)) AS INTEGER) AS month_days,
  CAST(date_diff('day', date_trunc('quarter', d), date_trunc('quarter', d) + INTERVAL 3 MONTH) AS INTEGER) AS quarter_days,
  CAST(date_diff('day', make_date(year(d), 1, 1), make_date(year(d) + 1, 1, 1)) AS INTEGER) AS year_days,
  CAST(date_diff('day', date_trunc('quarter', d), d) + 1 AS INTEGER) AS day_of_quarter_number,
  CAST(dayofyear(d) AS INTEGER) AS day_of_year_number, ds.total_sales
FROM cal LEFT JOIN ds USING (d)""")
def q_calendar_bounds(spark, sf):
    c = _with_sales(spark, sf, _cal(spark, sf))
    return c.select("date", "start_of_month", "end_of_month", "start_of_quarter", "end_of_quarter", "start_of_year",
                    "end_of_year", "month_days", "quarter_days", "year_days", "day_of_quarter_number",
                    "day_of_year_number", "total_sales")


@query("calendar_previous", sql=f"""
WITH {CAL_CTE},
c2 AS (SELECT d, year(d) * 12 + month(d) AS ym, day(d) AS dm, day(last_day(d)) AS md FROM alld),
prev AS (SELECT x.d,
   (SELECT max(p.d) FROM c2 p WHERE p.ym = x.ym - 1 AND (p.dm <= x.dm OR x.dm = x.md)) AS pm,
   (SELECT max(p.d) FROM c2 p WHERE p.ym = x.ym - 3 AND (p.dm <= x.dm OR x.dm = x.md)) AS pq,
   (SELECT max(p.d) FROM c2 p WHERE p.ym = x.ym - 12 AND (p.dm <= x.dm OR x.dm = x.md)) AS py
   FROM c2 x WHERE x.d IN (SELECT d FROM cal))
SELECT prev.d AS date, CAST(prev.d - INTERVAL 7 DAY AS DATE) AS date_previous_week, pm AS date_previous_month,
       pq AS date_previous_quarter, py AS date_previous_year, s.total_sales AS sales_previous_year
FROM prev LEFT JOIN ds s ON s.d = prev.py""")
def q_calendar_previous(spark, sf):
    """Same day in the previous week/month/quarter/year (month ends map to month ends),
    with the sales of the same day a year earlier."""
    c = _cal(spark, sf)
    d = _daily(spark, sf).select(F.col("date").alias("date_previous_year"), F.col("total_sales").alias("sales_previous_year"))
    return c.join(d, "date_previous_year", "left").select(
        "date", "date_previous_week", "date_previous_month", "date_previous_quarter", "date_previous_year",
        "sales_previous_year")


@query("calendar_weeknum", sql=f"""
WITH {CAL_CTE}
SELECT d AS date, CAST(floor((dayofyear(d) - 1 + dayofweek(make_date(year(d), 1, 1))) / 7) + 1 AS INTEGER) AS week_number,
  'W' || lpad(CAST(CAST(floor((dayofyear(d) - 1 + dayofweek(make_date(year(d), 1, 1))) / 7) + 1 AS INTEGER) AS VARCHAR), 2, '0') AS week,
  'W' || lpad(CAST(CAST(floor((dayofyear(d) - 1 + dayofweek(make_date(year(d), 1, 1))) / 7) + 1 AS INTEGER) AS VARCHAR), 2, '0') || '-' || year(d) AS week_year,
  CAST(year(d) * 100 + floor((dayofyear(d) - 1 + dayofweek(make_date(year(d), 1, 1))) / 7) + 1 AS INTEGER) AS week_year_order,
  CAST(floor(date_diff('day', DATE '1900-12-30', d) / 7) AS INTEGER) AS year_week_number, ds.total_sales
FROM cal LEFT JOIN ds USING (d)""")
def q_calendar_weeknum(spark, sf):
    c = _with_sales(spark, sf, _cal(spark, sf))
    return c.select("date", "week_number", "week", "week_year", "week_year_order", "year_week_number", "total_sales")


@query("calendar_seq365", sql=f"""
WITH {CAL_CTE},
s AS (SELECT d, year(d) - CASE WHEN month(d) < 2 OR (month(d) = 2 AND day(d) < 29) THEN 1 ELSE 0 END AS yy FROM cal)
SELECT s.d AS date, CAST(date_diff('day', DATE '1899-12-30', s.d) - (yy // 4 - yy // 100 + yy // 400 - 460) AS INTEGER)
       AS sequential365_day_number, ds.total_sales
FROM s LEFT JOIN ds USING (d)""")
def q_calendar_seq365(spark, sf):
    c = _with_sales(spark, sf, _cal(spark, sf))
    return c.select("date", "sequential365_day_number", "total_sales")


@query("calendar_workdays", sql=f"""
WITH {CAL_CTE}, {PT_HOLIDAYS_SQL},
w AS (SELECT cal.d, (dayofweek(cal.d) BETWEEN 1 AND 5) AND pt.holiday_name IS NULL AS wd FROM cal LEFT JOIN pt ON pt.d = cal.d)
SELECT CAST(year(w.d) AS INTEGER) AS year_number, CAST(month(w.d) AS INTEGER) AS month_number,
       CAST(sum(CASE WHEN wd THEN 1 ELSE 0 END) AS BIGINT) AS working_days,
       CAST(sum(CASE WHEN wd THEN 0 ELSE 1 END) AS BIGINT) AS non_working_days,
       round(sum(CASE WHEN wd THEN ds.total_sales END), 2) AS working_day_sales,
       round(sum(CASE WHEN wd THEN NULL ELSE ds.total_sales END), 2) AS non_working_day_sales
FROM w LEFT JOIN ds USING (d) GROUP BY 1, 2""")
def q_calendar_workdays(spark, sf):
    """Working days (Mon-Fri, not a PT holiday) per month and the sales on each kind of day."""
    c = _with_sales(spark, sf, _cal(spark, sf))
    wd = F.col("is_working_day")
    r = c.groupBy("year_number", "month_number").agg(
        F.sum(F.when(wd, 1).otherwise(0)).cast("bigint").alias("working_days"),
        F.sum(F.when(wd, 0).otherwise(1)).cast("bigint").alias("non_working_days"),
        F.sum(F.when(wd, F.col("total_sales"))).alias("working_day_sales"),
        F.sum(F.when(~wd, F.col("total_sales"))).alias("non_working_day_sales"))
    return rounded(r)


def _holiday_sales(spark, sf, country):
    years = year_bounds(load(spark, sf, "orders"), "o_orderdate") \
        .select(F.explode(F.sequence(F.col("first_year") - 1, F.col("last_year") + 1)).alias("year"))
    h = holidays(spark, years, country)
    return h.join(_daily(spark, sf), "date", "left")


@query("holidays_pt", sql=f"""
WITH {CAL_CTE}, {PT_HOLIDAYS_SQL}
SELECT pt.d AS date, pt.holiday_name, ds.total_sales FROM pt LEFT JOIN ds USING (d)""")
def q_holidays_pt(spark, sf):
    return _holiday_sales(spark, sf, "PT").select("date", "holiday_name", "total_sales")


@query("holidays_se", sql=f"""
WITH {CAL_CTE}, yrs AS (SELECT unnest(generate_series(y0 - 1, y1 + 1)) AS y FROM b),
se AS (
  SELECT make_date(y, m, dd) AS d, name, prio FROM yrs, (VALUES
    (1, 1, 'New Year''s Day', 100), (1, 6, 'Epiphany', 100), (5, 1, 'Labour Day', 100), (6, 6, 'National Day', 100),
    (12, 25, 'Christmas Day', 100), (12, 26, 'Boxing Day', 100), (12, 24, 'Christmas Eve', 50), (12, 31, 'New Year''s Eve', 50)) r(m, dd, name, prio)
  UNION ALL SELECT CAST({EASTER_SQL} - 2 AS DATE), 'Good Friday', 50 FROM yrs
  UNION ALL SELECT CAST({EASTER_SQL} + 1 AS DATE), 'Easter Monday', 50 FROM yrs
  UNION ALL SELECT CAST({EASTER_SQL} + 39 AS DATE), 'Ascension Day', 50 FROM yrs
  UNION ALL SELECT d, 'Midsummer Eve', 50 FROM alld WHERE month(d) = 6 AND day(d) BETWEEN 19 AND 25 AND dayofweek(d) = 5)
SELECT se.d AS date, arg_min(se.name, (prio, se.name)) AS holiday_name, any_value(ds.total_sales) AS total_sales
FROM se LEFT JOIN ds USING (d) GROUP BY se.d""")
def q_holidays_se(spark, sf):
    """Swedish holidays (Easter and Midsummer move) and the sales of their days."""
    return _holiday_sales(spark, sf, "SE").select("date", "holiday_name", "total_sales")


@query("holidays_us", sql=f"""
WITH {CAL_CTE},
yd AS (SELECT d, year(d) AS y, month(d) AS m, dayofweek(d) AS w,
              row_number() OVER (PARTITION BY year(d), month(d), dayofweek(d) ORDER BY d) AS nth,
              row_number() OVER (PARTITION BY year(d), month(d), dayofweek(d) ORDER BY d DESC) AS nth_last
       FROM alld),
us AS (
  SELECT make_date(y, m, dd) AS d, name FROM (SELECT DISTINCT year(d) AS y FROM alld) t, (VALUES
    (1, 1, 'New Year''s Day'), (7, 4, 'Independence Day'), (11, 11, 'Veterans Day'), (12, 25, 'Christmas Day')) r(m, dd, name)
  UNION ALL SELECT d, 'Martin Luther King, Jr.' FROM yd WHERE m = 1 AND w = 1 AND nth = 3
  UNION ALL SELECT d, 'Presidents'' Day' FROM yd WHERE m = 2 AND w = 1 AND nth = 3
  UNION ALL SELECT d, 'Memorial Day' FROM yd WHERE m = 5 AND w = 1 AND nth_last = 1
  UNION ALL SELECT d, 'Labor Day' FROM yd WHERE m = 9 AND w = 1 AND nth = 1
  UNION ALL SELECT d, 'Columbus Day' FROM yd WHERE m = 10 AND w = 1 AND nth = 2
  UNION ALL SELECT d, 'Thanksgiving Day' FROM yd WHERE m = 11 AND w = 4 AND nth = 4
  UNION ALL SELECT CAST(d + INTERVAL 1 DAY AS DATE), 'Black Friday' FROM yd WHERE m = 11 AND w = 4 AND nth = 4
  UNION ALL SELECT make_date(y, 6, 19), 'Juneteenth' FROM (SELECT DISTINCT year(d) AS y FROM alld) t WHERE y >= 2021)
SELECT us.d AS date, us.name AS holiday_name, ds.total_sales FROM us LEFT JOIN ds USING (d)""")
def q_holidays_us(spark, sf):
    return _holiday_sales(spark, sf, "US").select("date", "holiday_name", "total_sales")


@query("holidays_gb_substitutes", sql=f"""
WITH {CAL_CTE}, yrs AS (SELECT unnest(generate_series(y0 - 1, y1 + 1)) AS y FROM b),
yd AS (SELECT d, year(d) AS y, month(d) AS m, dayofweek(d) AS w,
              row_number() OVER (PARTITION BY year(d), month(d), dayofweek(d) ORDER BY d) AS nth,
              row_number() OVER (PARTITION BY year(d), month(d), dayofweek(d) ORDER BY d DESC) AS nth_last FROM alld),
h AS (SELECT make_date(y, 1, 1) AS d, 'New Year''s Day' AS name, 0 AS later, true AS moves FROM yrs
      UNION ALL SELECT make_date(y, 12, 25), 'Christmas Day', 1, true FROM yrs
      UNION ALL SELECT make_date(y, 12, 26), 'Boxing Day', 0, true FROM yrs
      UNION ALL SELECT CAST({EASTER_SQL} - 2 AS DATE), 'Good Friday', 0, false FROM yrs
      UNION ALL SELECT CAST({EASTER_SQL} + 1 AS DATE), 'Easter Monday', 0, false FROM yrs
      UNION ALL SELECT d, 'May Day Bank Holiday', 0, false FROM yd WHERE m = 5 AND w = 1 AND nth = 1
      UNION ALL SELECT d, 'Spring Bank Holiday', 0, false FROM yd WHERE m = 5 AND w = 1 AND nth_last = 1
      UNION ALL SELECT d, 'Late Summer Bank Holiday', 0, false FROM yd WHERE m = 8 AND w = 1 AND nth_last = 1),
-- a weekend holiday takes a working day after it: Saturday and Sunday the Monday, one later where the rule says so
n AS (SELECT h.*, CASE WHEN dayofweek(d) = 6 THEN 2 + later WHEN dayofweek(d) = 0 THEN 1 + later ELSE 0 END AS ahead FROM h WHERE moves),
f AS (SELECT n.d, n.name, (SELECT min(k) FROM range(0, 12) r(k)
             WHERE k >= n.ahead AND dayofweek(CAST(n.d + CAST(k AS INTEGER) AS DATE)) BETWEEN 1 AND 5
               AND NOT EXISTS (SELECT 1 FROM h o WHERE o.d = n.d + CAST(k AS INTEGER) AND NOT (o.name = n.name AND o.d = n.d))) AS k FROM n),
s AS (SELECT CAST(d + CAST(k AS INTEGER) AS DATE) AS d, '(in lieu of ' || name || ')' AS name FROM f WHERE k > 0)
SELECT x.d AS date, x.name AS holiday_name, x.sub AS is_substitute, ds.total_sales
  FROM (SELECT d, name, false AS sub FROM h UNION ALL SELECT d, name, true FROM s) x LEFT JOIN ds ON x.d = ds.d""")
def q_holidays_gb(spark, sf):
    """England and Wales bank holidays with "(in lieu of …)" substitute days, over the order years."""
    return _holiday_sales(spark, sf, "GB").select("date", "holiday_name", "is_substitute", "total_sales")


@query("easter_dates", sql=f"""
WITH {CAL_CTE}, yrs AS (SELECT unnest(generate_series(y0, y1)) AS y FROM b),
e AS (SELECT y, CAST({EASTER_SQL} AS DATE) AS easter_sunday FROM yrs)
SELECT CAST(e.y AS INTEGER) AS year, e.easter_sunday,
       (SELECT round(sum(total_sales), 2) FROM ds WHERE ds.d BETWEEN e.easter_sunday - INTERVAL 6 DAY AND e.easter_sunday)
       AS holy_week_sales
FROM e""")
def q_easter_dates(spark, sf):
    """Easter Sunday of each order year and the sales of Holy Week (the 7 days ending on it)."""
    years = year_bounds(load(spark, sf, "orders"), "o_orderdate") \
        .select(F.explode(F.sequence("first_year", "last_year")).alias("year"))
    e = years.select(F.col("year").cast("int").alias("year"), easter(F.col("year")).alias("easter_sunday"))
    d = _daily(spark, sf)
    j = e.join(d, (d["date"] >= F.date_sub(e["easter_sunday"], 6)) & (d["date"] <= e["easter_sunday"]), "left")
    return rounded(j.groupBy("year", "easter_sunday").agg(F.sum("total_sales").alias("holy_week_sales")))


@query("nth_weekdays", sql=f"""
WITH {CAL_CTE},
ms AS (SELECT DISTINCT year(d) AS y, month(d) AS m FROM cal),
fm AS (SELECT ms.y, ms.m,
  (SELECT min(c.d) FROM cal c WHERE year(c.d) = ms.y AND month(c.d) = ms.m AND dayofweek(c.d) = 1) AS first_monday,
  (SELECT max(c.d) FROM cal c WHERE year(c.d) = ms.y AND month(c.d) = ms.m AND dayofweek(c.d) = 5) AS last_friday,
  (SELECT min(c.d) + INTERVAL 14 DAY FROM cal c WHERE year(c.d) = ms.y AND month(c.d) = ms.m AND dayofweek(c.d) = 3) AS third_wednesday
  FROM ms)
SELECT CAST(fm.y AS INTEGER) AS year, CAST(fm.m AS INTEGER) AS month, first_monday, last_friday,
       CAST(third_wednesday AS DATE) AS third_wednesday, a.total_sales AS first_monday_sales, z.total_sales AS last_friday_sales
FROM fm LEFT JOIN ds a ON a.d = fm.first_monday LEFT JOIN ds z ON z.d = fm.last_friday""")
def q_nth_weekdays(spark, sf):
    """First Monday, last Friday and third Wednesday of every month, with sales on the first two."""
    c = _cal(spark, sf).select(F.col("year_number").alias("year"), F.col("month_number").alias("month")).distinct()
    r = c.select("year", "month",
                 nth_weekday(F.col("year"), F.col("month"), 1, 1).alias("first_monday"),
                 nth_weekday(F.col("year"), F.col("month"), 5, -1).alias("last_friday"),
                 nth_weekday(F.col("year"), F.col("month"), 3, 3).alias("third_wednesday"))
    d = _daily(spark, sf)
    a = d.select(F.col("date").alias("first_monday"), F.col("total_sales").alias("first_monday_sales"))
    z = d.select(F.col("date").alias("last_friday"), F.col("total_sales").alias("last_friday_sales"))
    return r.join(a, "first_monday", "left").join(z, "last_friday", "left") \
        .select("year", "month", "first_monday", "last_friday", "third_wednesday", "first_monday_sales", "last_friday_sales")


@query("calendar_fiscal", sql=f"""
WITH {CAL_CTE},
fc AS (SELECT alld.d, year(alld.d) + CASE WHEN month(alld.d) >= 7 THEN 1 ELSE 0 END AS fy,
              (month(alld.d) - 7 + 12) % 12 + 1 AS fm FROM alld),
k AS (SELECT fc.* FROM fc, b WHERE fc.fy BETWEEN b.y0 AND b.y1)
SELECT CAST(fy AS INTEGER) AS fiscal_year_number, CAST(fm AS INTEGER) AS fiscal_month_number,
       CAST((fm + 2) // 3 AS INTEGER) AS fiscal_quarter_number, CAST(count(*) AS BIGINT) AS days,
       round(sum(ds.total_sales), 2) AS total_sales
FROM k LEFT JOIN ds USING (d) GROUP BY 1, 2, 3""")
def q_calendar_fiscal(spark, sf):
    """Sales by fiscal year (starting in July, named by the year it ends) and fiscal month;
    the calendar keeps the fiscal years of the data's range."""
    cfg = CalendarConfig(fiscal_first_month=7, calendar_range="FiscalGregorian")
    c = _with_sales(spark, sf, _cal(spark, sf, cfg))
    r = c.groupBy("fiscal_year_number", "fiscal_month_number", "fiscal_quarter_number").agg(
        F.count(F.lit(1)).alias("days"), F.sum("total_sales").alias("total_sales"))
    return rounded(r)


def _fw_cte(weekly: str, weeks: tuple = (4, 4, 5)) -> str:
    """Fiscal weeks found among all Sundays: a year begins on the last Sunday up to 1 January
    ("Last") or on the Sunday next to it ("Nearest"); its weeks are counted, and months are
    looked up by week."""
    which = ("(SELECT max(s) FROM sundays WHERE s <= make_date(y, 1, 1))" if weekly == "Last" else
             "(SELECT arg_min(s, abs(date_diff('day', s, make_date(y, 1, 1)))) FROM sundays)")
    month, rows = 0, []
    for m in range(12):
        n = weeks[m % 3] + (m == 11)
        rows += [f"({month + k + 1}, {m + 1})" for k in range(n)]
        month += n
    return f"""{CAL_CTE},
sundays AS (SELECT s FROM (SELECT CAST(unnest(generate_series(make_date(y0 - 2, 1, 1), make_date(y1 + 3, 1, 31), INTERVAL 1 DAY)) AS DATE) AS s
              FROM b) WHERE dayofweek(s) = 0),
starts AS (SELECT y, {which} AS s FROM (SELECT unnest(generate_series(y0 - 1, y1 + 2)) AS y FROM b)),
wk AS (SELECT starts.y, sundays.s AS sunday, row_number() OVER (PARTITION BY starts.y ORDER BY sundays.s) AS w
         FROM starts JOIN starts nx ON nx.y = starts.y + 1 JOIN sundays ON sundays.s >= starts.s AND sundays.s < nx.s),
lookup(w, m) AS (VALUES {", ".join(rows)}),
fw AS (SELECT wk.y, wk.w, m, CAST((m + 2) // 3 AS INTEGER) AS q, CAST(sunday + CAST(k AS INTEGER) AS DATE) AS d
         FROM wk JOIN lookup USING (w), range(7) r(k))"""


def _fw_sql(weekly: str, weeks: tuple = (4, 4, 5)) -> str:
    return f"""
WITH {_fw_cte(weekly, weeks)}
SELECT CAST(y AS INTEGER) AS fw_year, q AS fw_quarter_number, CAST(m AS INTEGER) AS fw_month_number,
       CAST((w - 1) // 4 + 1 AS INTEGER) AS fw_period_number, CAST(count(*) AS BIGINT) AS days, CAST(max(w) AS INTEGER) AS last_week,
       round(sum(ds.total_sales), 2) AS total_sales
FROM fw JOIN b ON y BETWEEN y0 AND y1 JOIN alld USING (d) LEFT JOIN ds USING (d) GROUP BY 1, 2, 3, 4"""


def _fw_query(spark, sf, cfg):
    c = _with_sales(spark, sf, _cal(spark, sf, cfg))
    r = c.groupBy("fw_year", "fw_quarter_number", "fw_month_number", "fw_period_number").agg(
        F.count(F.lit(1)).alias("days"), F.max("fw_week_number").alias("last_week"), F.sum("total_sales").alias("total_sales"))
    return rounded(r)


@query("calendar_445", sql=_fw_sql("Last"))
def q_calendar_445(spark, sf):
    """Sales by 4-4-5 fiscal weekly year/quarter/month/period (weeks from Sunday, year ends on
    the last Saturday of December)."""
    return _fw_query(spark, sf, CalendarConfig(weekly_type="Last", quarter_week_type="445", calendar_range="FiscalWeekly"))


@query("calendar_445_nearest", sql=_fw_sql("Nearest"))
def q_calendar_445_nearest(spark, sf):
    """Same with the year ending on the Saturday nearest the end of December."""
    return _fw_query(spark, sf, CalendarConfig(weekly_type="Nearest", quarter_week_type="445",
                                               calendar_range="FiscalWeekly"))


@query("calendar_454", sql=_fw_sql("Last", (4, 5, 4)))
def q_calendar_454(spark, sf):
    """Sales by 4-5-4 fiscal weekly year/quarter/month/period."""
    return _fw_query(spark, sf, CalendarConfig(weekly_type="Last", quarter_week_type="454", calendar_range="FiscalWeekly"))


@query("calendar_544", sql=_fw_sql("Nearest", (5, 4, 4)))
def q_calendar_544(spark, sf):
    """Sales by 5-4-4 fiscal weekly year/quarter/month/period, years beginning on the nearest Sunday."""
    return _fw_query(spark, sf, CalendarConfig(weekly_type="Nearest", quarter_week_type="544", calendar_range="FiscalWeekly"))


FW_PREVIOUS = ("fw_date_previous_month", "fw_date_previous_quarter", "fw_date_previous_year")


@query("calendar_fw_previous", sql=f"""
WITH {_fw_cte("Last")},
x AS (SELECT *, dense_rank() OVER (ORDER BY y, m) AS mno, dense_rank() OVER (ORDER BY y, q) AS qno,
             row_number() OVER (PARTITION BY y, m ORDER BY d) AS dm, row_number() OVER (PARTITION BY y, q ORDER BY d) AS dq,
             row_number() OVER (PARTITION BY y ORDER BY d) AS dy,
             count(*) OVER (PARTITION BY y, m) AS nm, count(*) OVER (PARTITION BY y, q) AS nq, count(*) OVER (PARTITION BY y) AS ny FROM fw),
t AS (SELECT x.* FROM x JOIN b ON x.d = b.today)
SELECT x.d AS date, 'FWQ' || x.q || ' ' || x.y AS fw_quarter_year, 'FWP' || lpad(CAST((x.w - 1) // 4 + 1 AS VARCHAR), 2, '0') AS fw_period,
       CAST(x.dm AS INTEGER) AS fw_day_of_month, CAST(x.dq AS INTEGER) AS fw_day_of_quarter, CAST(x.dy AS INTEGER) AS fw_day_of_year,
       CAST(x.nm AS INTEGER) AS fw_month_days, CAST(x.nq AS INTEGER) AS fw_quarter_days, CAST(x.ny AS INTEGER) AS fw_year_days,
       CAST(x.mno - t.mno AS INTEGER) AS fw_relative_month_pos, CAST(x.qno - t.qno AS INTEGER) AS fw_relative_quarter_pos,
       CAST(x.y - t.y AS INTEGER) AS fw_relative_year_pos,
       CAST(x.d - INTERVAL 7 DAY AS DATE) AS fw_date_previous_week,
       (SELECT max(p.d) FROM x p WHERE p.mno = x.mno - 1 AND (p.dm <= x.dm OR x.dm = x.nm)) AS fw_date_previous_month,
       (SELECT max(p.d) FROM x p WHERE p.qno = x.qno - 1 AND (p.dq <= x.dq OR x.dq = x.nq)) AS fw_date_previous_quarter,
       (SELECT max(p.d) FROM x p WHERE p.y = x.y - 1 AND (p.dy <= x.dy OR x.dy = x.ny)) AS fw_date_previous_year,
       ds.total_sales
FROM x JOIN b ON x.y BETWEEN b.y0 + 1 AND b.y1 CROSS JOIN t LEFT JOIN ds ON x.d = ds.d""")
def q_calendar_fw_previous(spark, sf):
    """Labels, positions, lengths and the same day in the previous week, month, quarter and year of the
    fiscal weekly calendar, for all fiscal years but the first of the data, with daily sales."""
    cfg = CalendarConfig(weekly_type="Last", quarter_week_type="445", calendar_range="FiscalWeekly")
    c = _with_sales(spark, sf, _cal(spark, sf, cfg))
    first = year_bounds(load(spark, sf, "orders"), "o_orderdate").select(F.col("first_year").alias("__first"))
    return c.join(F.broadcast(first), F.col("fw_year") > F.col("__first")).select(
        "date", "fw_quarter_year", "fw_period", "fw_day_of_month", "fw_day_of_quarter", "fw_day_of_year", "fw_month_days",
        "fw_quarter_days", "fw_year_days", "fw_relative_month_pos", "fw_relative_quarter_pos", "fw_relative_year_pos",
        "fw_date_previous_week", *FW_PREVIOUS, "total_sales")


@query("calendar_fiscal_positions", sql=f"""
WITH {CAL_CTE},
f AS (SELECT d, year(d) + CAST(month(d) >= 7 AS INTEGER) AS y, (month(d) + 5) % 12 + 1 AS m FROM alld),
x AS (SELECT *, (m + 2) // 3 AS q, dense_rank() OVER (ORDER BY y, m) AS mno, dense_rank() OVER (ORDER BY y, (m + 2) // 3) AS qno,
             row_number() OVER (PARTITION BY y, m ORDER BY d) AS dm, row_number() OVER (PARTITION BY y, (m + 2) // 3 ORDER BY d) AS dq,
             row_number() OVER (PARTITION BY y ORDER BY d) AS dy, count(*) OVER (PARTITION BY y, m) AS nm,
             count(*) OVER (PARTITION BY y, (m + 2) // 3) AS nq, count(*) OVER (PARTITION BY y) AS ny,
             min(d) OVER (PARTITION BY y, (m + 2) // 3) AS sq, max(d) OVER (PARTITION BY y, (m + 2) // 3) AS eq FROM f),
t AS (SELECT x.* FROM x JOIN b ON x.d = b.today)
SELECT x.d AS date, CAST(x.mno - t.mno AS INTEGER) AS fiscal_relative_month_pos, CAST(x.qno - t.qno AS INTEGER) AS fiscal_relative_quarter_pos,
       CAST(x.y - t.y AS INTEGER) AS fiscal_relative_year_pos, x.sq AS fiscal_start_of_quarter, x.eq AS fiscal_end_of_quarter,
       CAST(x.nm AS INTEGER) AS fiscal_month_days, CAST(x.nq AS INTEGER) AS fiscal_quarter_days, CAST(x.ny AS INTEGER) AS fiscal_year_days,
       CAST(x.dm AS INTEGER) AS fiscal_day_of_month, CAST(x.dq AS INTEGER) AS fiscal_day_of_quarter, CAST(x.dy AS INTEGER) AS fiscal_day_of_year,
       CAST(x.d - INTERVAL 7 DAY AS DATE) AS fiscal_date_previous_week,
       (SELECT max(p.d) FROM x p WHERE p.mno = x.mno - 1 AND (p.dm <= x.dm OR x.dm = x.nm)) AS fiscal_date_previous_month,
       (SELECT max(p.d) FROM x p WHERE p.mno = x.mno - 3 AND (p.dm <= x.dm OR x.dm = x.nm)) AS fiscal_date_previous_quarter,
       (SELECT max(p.d) FROM x p WHERE p.mno = x.mno - 12 AND (p.dm <= x.dm OR x.dm = x.nm)) AS fiscal_date_previous_year,
       ds.total_sales
FROM x JOIN b ON x.y BETWEEN b.y0 + 1 AND b.y1 CROSS JOIN t LEFT JOIN ds ON x.d = ds.d""")
def q_calendar_fiscal_positions(spark, sf):
    """Positions, bounds, lengths and the same day in previous periods of fiscal years starting in
    July, for all fiscal years but the first of the data, with daily sales."""
    cfg = CalendarConfig(fiscal_first_month=7, calendar_range="FiscalGregorian")
    c = _with_sales(spark, sf, _cal(spark, sf, cfg))
    first = year_bounds(load(spark, sf, "orders"), "o_orderdate").select(F.col("first_year").alias("__first"))
    names = [f"fiscal_{n}" for n in (
        "relative_month_pos", "relative_quarter_pos", "relative_year_pos", "start_of_quarter", "end_of_quarter", "month_days",
        "quarter_days", "year_days", "day_of_month", "day_of_quarter", "day_of_year", "date_previous_week",
        "date_previous_month", "date_previous_quarter", "date_previous_year")]
    return c.join(F.broadcast(first), F.col("fiscal_year_number") > F.col("__first")).select("date", *names, "total_sales")


@query("calendar_custom_periods", sql=f"""
WITH {CAL_CTE},
july AS (SELECT unnest(generate_series(y0, y1 + 2)) AS y FROM b),
per AS (SELECT y, (SELECT min(d) FROM (SELECT CAST(make_date(y - 1, 7, 1) + CAST(k AS INTEGER) AS DATE) AS d FROM range(7) r(k)) x
                    WHERE dayofweek(d) = 0) AS s FROM july),
days AS (SELECT p.y, p.s, alld.d FROM per p JOIN per n ON n.y = p.y + 1 JOIN alld ON alld.d >= p.s AND alld.d < n.s),
k AS (SELECT days.* FROM days, b WHERE y BETWEEN b.y0 AND b.y1)
SELECT CAST(y AS INTEGER) AS fw_year, CAST(count(*) AS BIGINT) AS days,
       CAST(max(date_diff('day', s, d) // 7 + 1) AS INTEGER) AS weeks, round(sum(ds.total_sales), 2) AS total_sales
FROM k LEFT JOIN ds USING (d) GROUP BY 1""")
def q_calendar_custom_periods(spark, sf):
    """Sales per custom fiscal year: explicit years in place of the weekly rule, here from the first
    Sunday of July, for all years of the data."""
    bounds = year_bounds(load(spark, sf, "orders"), "o_orderdate")
    years = bounds.select(F.explode(F.sequence("first_year", F.col("last_year") + 1)).alias("fw_year"))
    begins = lambda y: F.next_day(F.make_date(y - 1, F.lit(6), F.lit(30)), "Sun")
    periods = years.select("fw_year", begins(F.col("fw_year")).alias("fw_start"),
                           F.date_sub(begins(F.col("fw_year") + 1), 1).alias("fw_end"))
    cfg = CalendarConfig(weekly_type="Custom", custom_periods=periods, calendar_range="FiscalWeekly")
    c = _with_sales(spark, sf, _cal(spark, sf, cfg))
    r = c.groupBy("fw_year").agg(F.count(F.lit(1)).alias("days"), F.max("fw_week_number").alias("weeks"),
                                 F.sum("total_sales").alias("total_sales"))
    return rounded(r)
