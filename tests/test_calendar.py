"""Golden rows of the calendar and holidays (hand-derived, see FIXTURES.md)."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from tessera.functions.dates import easter
from tessera.operators.calendar import CalendarConfig, calendar, fixed_bounds
from tessera.operators.holidays import holidays

D = dt.date
GOLDEN = [
    # date, key, wdn, wd, yqn, ymn, wn, ywn, wyo, week_year, seq365, doy, doq, qdays, prev_m, prev_q, prev_y
    (D(2016, 2, 28), 20160228, 1, "Sun", 8064, 24193, 10, 6009, 201610, "W10-2016", 42400, 59, 59, 91,
     D(2016, 1, 28), D(2015, 11, 28), D(2015, 2, 28)),
    (D(2016, 2, 29), 20160229, 2, "Mon", 8064, 24193, 10, 6009, 201610, "W10-2016", 42400, 60, 60, 91,
     D(2016, 1, 31), D(2015, 11, 30), D(2015, 2, 28)),
    (D(2016, 12, 31), 20161231, 7, "Sat", 8067, 24203, 53, 6052, 201653, "W53-2016", 42706, 366, 92, 92,
     D(2016, 11, 30), D(2016, 9, 30), D(2015, 12, 31)),
    (D(2017, 1, 1), 20170101, 1, "Sun", 8068, 24204, 1, 6053, 201701, "W01-2017", 42707, 1, 1, 90,
     D(2016, 12, 1), D(2016, 10, 1), D(2016, 1, 1)),
    (D(2017, 2, 28), 20170228, 3, "Tue", 8068, 24205, 9, 6061, 201709, "W09-2017", 42765, 59, 59, 90,
     D(2017, 1, 31), D(2016, 11, 30), D(2016, 2, 29)),
    (D(2017, 3, 30), 20170330, 5, "Thu", 8068, 24206, 13, 6065, 201713, "W13-2017", 42795, 89, 89, 90,
     D(2017, 2, 28), D(2016, 12, 30), D(2016, 3, 30)),
    (D(2017, 4, 30), 20170430, 1, "Sun", 8069, 24207, 18, 6070, 201718, "W18-2017", 42826, 120, 30, 91,
     D(2017, 3, 31), D(2017, 1, 31), D(2016, 4, 30)),
    (D(2018, 12, 31), 20181231, 2, "Mon", 8075, 24227, 53, 6157, 201853, "W53-2018", 43436, 365, 92, 92,
     D(2018, 11, 30), D(2018, 9, 30), D(2017, 12, 31)),
]
COLS = ["date", "date_key", "week_day_number", "week_day", "year_quarter_number", "year_month_number",
        "week_number", "year_week_number", "week_year_order", "week_year", "sequential365_day_number",
        "day_of_year_number", "day_of_quarter_number", "quarter_days", "date_previous_month",
        "date_previous_quarter", "date_previous_year"]


@pytest.fixture(scope="module")
def cal(spark):
    return calendar(spark, fixed_bounds(spark, 2016, 2018, "2017-06-15")).cache()


def test_golden_rows(cal):
    want = {g[0]: g for g in GOLDEN}
    got = cal.filter(F.col("date").isin(list(want))).select(*COLS).collect()
    assert len(got) == len(GOLDEN)
    for r in got:
        assert tuple(r) == want[r["date"]]


def test_labels_and_range(cal):
    r = cal.filter(F.col("date") == D(2017, 1, 5)).select("year", "quarter", "quarter_year", "month_year", "week",
                                                           "day_type").first()
    assert tuple(r) == ("2017", "Q1 ", "Q1 2017", "Jan 2017", "W01", "Working day")
    assert cal.count() == 366 + 365 + 365
    assert cal.filter(F.col("date") == D(2017, 1, 1)).first()["day_type"] == "Non-working day"


def test_relative_positions(cal):
    r = cal.filter(F.col("date") == D(2016, 6, 15)).select("relative_month_pos", "relative_year_pos",
                                                            "relative_quarter_pos").first()
    assert tuple(r) == (-12, -1, -4)


def test_easter(spark):
    years = [2015, 2016, 2017, 2018, 2019, 2024, 2025]
    df = spark.createDataFrame([(y,) for y in years], "y int").select(easter(F.col("y")).alias("e"))
    got = sorted(r.e for r in df.collect())
    want = [D(2015, 4, 5), D(2016, 3, 27), D(2017, 4, 16), D(2018, 4, 1), D(2019, 4, 21), D(2024, 3, 31),
            D(2025, 4, 20)]
    assert got == want


def _hol(spark, country, years):
    y = spark.createDataFrame([(v,) for v in years], "year int")
    return {(r.date, r.holiday_name) for r in holidays(spark, y, country).collect()}


def test_holidays_pt_2017(spark):
    h = {d for d, _ in _hol(spark, "PT", [2017]) if d.year == 2017}
    want = {(1, 1), (4, 14), (4, 25), (5, 1), (6, 10), (6, 15), (8, 15), (10, 5), (11, 1), (12, 1), (12, 8), (12, 25)}
    assert h == {D(2017, m, d) for m, d in want}


def test_holidays_us_weekday_rules(spark):
    h = dict((d, n) for d, n in _hol(spark, "US", [2018]))
    assert h[D(2018, 1, 15)] == "Martin Luther King, Jr."
    assert h[D(2018, 2, 19)] == "Presidents' Day"
    assert h[D(2018, 5, 28)] == "Memorial Day"
    assert h[D(2018, 9, 3)] == "Labor Day"
    assert h[D(2018, 10, 8)] == "Columbus Day"
    assert h[D(2018, 11, 22)] == "Thanksgiving Day"
    assert h[D(2018, 11, 23)] == "Black Friday"


def test_juneteenth_substitutes(spark):
    h = _hol(spark, "US", [2020, 2021, 2022])
    names = {(d, n) for d, n in h if "Juneteenth" in n}
    assert names == {(D(2021, 6, 19), "Juneteenth"), (D(2021, 6, 18), "(in lieu of Juneteenth)"),
                     (D(2022, 6, 19), "Juneteenth"), (D(2022, 6, 20), "(in lieu of Juneteenth)")}


def test_gb_christmas_chains(spark):
    h = _hol(spark, "GB", [2016, 2017, 2021])
    assert (D(2016, 12, 27), "(in lieu of Christmas Day)") in h
    assert (D(2021, 12, 27), "(in lieu of Boxing Day)") in h
    assert (D(2021, 12, 28), "(in lieu of Christmas Day)") in h
    assert (D(2017, 1, 2), "(in lieu of New Year's Day)") in h
    assert not any(n.startswith("(in lieu") and d == D(2016, 12, 26) for d, n in h)


def test_midsummer(spark):
    h = _hol(spark, "SE", [2017, 2018])
    assert (D(2017, 6, 23), "Midsummer Eve") in h and (D(2018, 6, 22), "Midsummer Eve") in h


def test_unknown_country(spark):
    with pytest.raises(ValueError):
        holidays(spark, spark.createDataFrame([(2017,)], "year int"), "XX")


def test_fiscal_gregorian(spark):
    c = calendar(spark, fixed_bounds(spark, 2016, 2018, "2017-06-15"),
                 CalendarConfig(fiscal_first_month=7, include_fiscal=True))
    r = {x.date: (x.fiscal_year_number, x.fiscal_month_number) for x in
         c.filter(F.col("date").isin(D(2017, 6, 30), D(2017, 7, 1))).collect()}
    assert r == {D(2017, 6, 30): (2017, 12), D(2017, 7, 1): (2018, 1)}
    c0 = calendar(spark, fixed_bounds(spark, 2016, 2018, "2017-06-15"),
                  CalendarConfig(fiscal_first_month=7, fiscal_named_by_last_day=False, include_fiscal=True))
    r0 = {x.date: x.fiscal_year_number for x in c0.filter(F.col("date").isin(D(2017, 6, 30), D(2017, 7, 1))).collect()}
    assert r0 == {D(2017, 6, 30): 2016, D(2017, 7, 1): 2017}


@pytest.mark.parametrize("weekly,year,start,end,weeks", [
    ("Last", 2016, D(2015, 12, 27), D(2016, 12, 31), 53),
    ("Last", 2017, D(2017, 1, 1), D(2017, 12, 30), 52),
    ("Nearest", 2016, D(2016, 1, 3), D(2016, 12, 31), 52),
])
def test_fiscal_weekly_years(spark, weekly, year, start, end, weeks):
    c = calendar(spark, fixed_bounds(spark, 2016, 2017, "2017-06-15"),
                 CalendarConfig(weekly_type=weekly, calendar_range="FiscalWeekly"))
    r = c.filter(F.col("fw_year") == year).agg(F.min("date"), F.max("date"), F.max("fw_week_number")).first()
    assert tuple(r) == (start, end, weeks)


def test_445_months(spark):
    c = calendar(spark, fixed_bounds(spark, 2016, 2016, "2016-06-15"), CalendarConfig(calendar_range="FiscalWeekly"))
    m = {r.fw_week_number: (r.fw_month_number, r.fw_quarter_number, r.fw_period_number)
         for r in c.filter(F.col("fw_year") == 2016).select("fw_week_number", "fw_month_number", "fw_quarter_number",
                                                             "fw_period_number").distinct().collect()}
    assert [m[w][0] for w in (4, 5, 8, 9, 13, 14)] == [1, 2, 2, 3, 3, 4]
    assert m[53] == (12, 4, 14)


def test_bad_quarter_type(spark):
    with pytest.raises(ValueError):
        calendar(spark, fixed_bounds(spark, 2016, 2016, "2016-06-15"),
                 CalendarConfig(quarter_week_type="446", include_weekly=True))
