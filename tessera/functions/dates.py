"""Date helpers written as built-in Spark column expressions (whole-stage codegen).

Weekday numbering: ``dow0`` is 0 = Sunday … 6 = Saturday.  ``first_day`` of a
week uses the same numbering (0 = weeks start on Sunday, 1 = Monday, …).
"""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the calendar rules.
WEEK_ANCHOR_SUNDAY = "1900-12-30"   # a Sunday; continuous week index origin
DATE_SERIAL_ORIGIN = "1899-12-30"   # day 0 of the spreadsheet date serial


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def date_key(c) -> Column:
    """Integer ``yyyymmdd`` surrogate key of a date/timestamp (NULL stays NULL)."""
    c = _c(c)
    return (F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)).cast("int")


def boundary_diff(unit: str, start, end) -> Column:
    """Number of `unit` boundaries crossed from `start` to `end` (negative if reversed).

    Unlike ``timestampdiff`` this counts boundaries: 10:59 -> 11:01 is 1 hour.  Computed on
    wall-clock fields (days between the dates, then hour / minute / second differences), so
    the result does not depend on the session time zone or daylight-saving shifts.
    """
    a, b = _c(start), _c(end)
    u = unit.upper()
    days = F.datediff(F.to_date(b), F.to_date(a)).cast("bigint")
    if u == "DAY":
        return days
    hours = days * 24 + (F.hour(b) - F.hour(a))
    if u == "HOUR":
        return hours
    minutes = hours * 60 + (F.minute(b) - F.minute(a))
    if u == "MINUTE":
        return minutes
    if u == "SECOND":
        return minutes * 60 + (F.second(b) - F.second(a))
    raise ValueError(f"unsupported unit {unit!r}")


def dow0(c) -> Column:
    """0 = Sunday … 6 = Saturday."""
    return F.dayofweek(_c(c)) - 1


def weekday_number(c, first_day: int = 0) -> Column:
    """1-based position of the day inside a week starting on `first_day`."""
    return (F.pmod(dow0(c) - F.lit(first_day), F.lit(7)) + 1).cast("int")


def weeknum(c, first_day: int = 0) -> Column:
    """Week of year where week 1 holds 1 January and weeks start on `first_day`.

    Not ISO ``weekofyear``.
    """
    c = _c(c)
    jan1 = F.make_date(F.year(c), F.lit(1), F.lit(1))
    return (F.floor((F.dayofyear(c) - 1 + weekday_number(jan1, first_day) - 1) / 7) + 1).cast("int")


def year_week_number(c, first_day: int = 0) -> Column:
    """Continuous week index counted from the anchor Sunday shifted by `first_day`."""
    anchor = F.date_add(F.lit(WEEK_ANCHOR_SUNDAY).cast("date"), first_day)
    return F.floor(F.datediff(_c(c), anchor) / 7).cast("int")


def date_serial(c) -> Column:
    """Days since 1899-12-30 (spreadsheet serial)."""
    return F.datediff(_c(c), F.lit(DATE_SERIAL_ORIGIN).cast("date"))


def seq365(c) -> Column:
    """Leap-neutral sequential day number: 29 Feb shares 28 Feb's number, so the 29 Februaries up to
    the date are taken off the serial number."""
    c = _c(c)
    ends = F.transform(F.sequence(F.lit(1900), F.greatest(F.year(c), F.lit(1900))),
                       lambda y: F.last_day(F.make_date(y, F.lit(2), F.lit(1))))
    leap_days = F.filter(ends, lambda e: (F.dayofmonth(e) == 29) & (e <= c))
    return (date_serial(c) - F.size(leap_days)).cast("int")


def easter(year) -> Column:
    """Gregorian Easter Sunday of `year` (anonymous Gregorian computus)."""
    y = _c(year)
    a = F.pmod(y, F.lit(19))
    b = F.floor(y / 100)
    c = F.pmod(y, F.lit(100))
    d = F.floor(b / 4)
    e = F.pmod(b, F.lit(4))
    f = F.floor((b + 8) / 25)
    g = F.floor((b - f + 1) / 3)
    h = F.pmod(19 * a + b - d - g + 15, F.lit(30))
    i = F.floor(c / 4)
    k = F.pmod(c, F.lit(4))
    l_ = F.pmod(32 + 2 * e + 2 * i - h - k, F.lit(7))
    m = F.floor((a + 11 * h + 22 * l_) / 451)
    month = F.floor((h + l_ - 7 * m + 114) / 31)
    day = F.pmod(h + l_ - 7 * m + 114, F.lit(31)) + 1
    return F.make_date(y.cast("int"), month.cast("int"), day.cast("int"))


def nth_weekday(year, month, weekday, n, offset_days=0) -> Column:
    """The `n`-th (n > 0) or `-n`-th-from-last (n < 0) `weekday` (0 = Sunday) of a month,
    plus `offset_days`."""
    y, m, wd, n = _c(year), _c(month), F.lit(weekday) if isinstance(weekday, int) else _c(weekday), \
        F.lit(n) if isinstance(n, int) else _c(n)
    off = F.lit(offset_days) if isinstance(offset_days, int) else _c(offset_days)
    first = F.make_date(y.cast("int"), m.cast("int"), F.lit(1))
    last = F.last_day(first)
    fwd = F.date_add(first, (F.pmod(wd - dow0(first), F.lit(7)) + (n - 1) * 7).cast("int"))
    bwd = F.date_sub(last, (F.pmod(dow0(last) - wd, F.lit(7)) - (n + 1) * 7).cast("int"))
    return F.date_add(F.when(n > 0, fwd).otherwise(bwd), off.cast("int"))


def midsummer(year) -> Column:
    """Swedish Midsummer Day: the Saturday between 20 and 26 June."""
    june20 = F.make_date(_c(year).cast("int"), F.lit(6), F.lit(20))
    return F.date_add(june20, (6 - dow0(june20)).cast("int"))


def same_day_months_back(c, months: int) -> Column:
    """Same day `months` earlier; a month's last day maps to the earlier month's last day
    (2017-02-28 -> 2016-02-29 for 12 months, 2016-02-29 -> 2016-01-31 for 1 month)."""
    c = _c(c)
    back = F.add_months(c, -months)
    return F.when(c == F.last_day(c), F.last_day(back)).otherwise(back)
