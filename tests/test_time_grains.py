"""Quarter and year grain, and Date filters that cut periods, against plain sums over rows."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from tessera.plans.model import Measure, Model, Relationship
from tessera.plans.timeintel import with_time

ROWS = [("a", dt.date(2020, 1, 15), 10.0, 1), ("a", dt.date(2020, 2, 3), 5.0, 1), ("a", dt.date(2020, 3, 31), 7.0, 2), ("a", dt.date(2020, 6, 30), 1.0, 3),
        ("a", dt.date(2020, 12, 1), 2.0, 1), ("a", dt.date(2021, 1, 20), 4.0, 2), ("a", dt.date(2021, 3, 10), 8.0, 2), ("a", dt.date(2021, 3, 20), 6.0, None),
        ("b", dt.date(2021, 2, 28), 3.0, 9), ("b", dt.date(2020, 2, 29), 9.0, 9), (None, dt.date(2021, 5, 5), 20.0, 4)]


def model(spark):
    fact = lambda: spark.createDataFrame(ROWS, "g string, d date, v double, k int").withColumn(
        "key", F.date_format("d", "yyyyMMdd").cast("int"))
    date = lambda: spark.sql("SELECT explode(sequence(DATE '2020-01-01', DATE '2021-12-31')) AS date").withColumn(
        "key", F.date_format("date", "yyyyMMdd").cast("int")).withColumn("month_number", F.month("date"))
    rel = Relationship("r", "fact", "key", "date", "key")
    return Model({"fact": fact, "date": date}, [rel], {"total": Measure("total", "fact", "sum", "v"), "mean": Measure("mean", "fact", "avg", "v"),
                                                     "n": Measure("n", "fact", "count"), "who": Measure("who", "fact", "distinct", "k")},
                 date_columns={"fact": "d"})


def value(kind, rows):
    if not rows:
        return None
    if kind == "who":
        return len({r[3] for r in rows})
    if kind == "n":
        return len(rows)
    return sum(r[2] for r in rows) / (len(rows) if kind == "mean" else 1)


def plain(kind, months, keep=lambda d: True):
    """{(group, year, number in the year): (cur, mtd, ytd, py)} from the rows themselves."""
    days = [dt.date(2020, 1, 1) + dt.timedelta(days=i) for i in range(731)]
    periods = {}
    for d in filter(keep, days):
        periods.setdefault((d.year, (d.month - 1) // months + 1), []).append(d)
    out = {}
    for g in {r[0] for r in ROWS}:
        own = [r for r in ROWS if r[0] == g]
        first = min(r[1] for r in own)
        for (y, n), ds in periods.items():
            last, back = max(ds), {(d.replace(year=d.year - 1) if (d.month, d.day) != (2, 29) else dt.date(d.year - 1, 2, 28)) for d in ds}
            whole = len(ds) == len([d for d in days if (d.year, (d.month - 1) // months + 1) == (y, n)])
            if whole:
                back = {d for d in days if (d.year + 1, (d.month - 1) // months + 1) == (y, n)}
            at = lambda f: value(kind, [r for r in own if f(r[1])])
            got = (at(lambda d: d in set(ds)), at(lambda d: d <= last and (d.year, d.month) == (last.year, last.month)),
                   at(lambda d: d <= last and d.year == last.year), at(lambda d: d in back))
            if any(v is not None for v in got) and last >= first:
                out[g, y, n] = got
    return out


def got(spark, kind, grain, filters=None):
    rows = with_time(model(spark), kind, ("Current", "MTD", "YTD", "PY"), grain, ["fact.g"], filters).collect()
    return {(r["g"], r["year"], r[grain] if grain != "year" else 1): (r["cur"], r["mtd"], r["ytd"], r["py"]) for r in rows}


@pytest.mark.parametrize("grain, months", [("month", 1), ("quarter", 3), ("year", 12)])
@pytest.mark.parametrize("kind", ["total", "mean", "n", "who"])
def test_whole_periods(spark, kind, grain, months):
    assert got(spark, kind, grain) == plain(kind, months)


@pytest.mark.parametrize("grain, months", [("month", 1), ("quarter", 3), ("year", 12)])
@pytest.mark.parametrize("kind", ["mean", "who"])
def test_cut_periods(spark, kind, grain, months):
    lo, hi = dt.date(2020, 2, 2), dt.date(2021, 3, 15)
    want = plain(kind, months, lambda d: lo <= d <= hi and not (d.year == 2020 and d.month == 6))
    kept = F.col("date").between(F.lit(lo), F.lit(hi)) & ~((F.year("date") == 2020) & (F.month("date") == 6))
    have = got(spark, kind, grain, {"date.date": kept})
    assert set(have) == set(want)
    assert {k: v[:3] for k, v in have.items()} == {k: v[:3] for k, v in want.items()}


@pytest.mark.parametrize("grain, months", [("month", 1), ("quarter", 3), ("year", 12)])
def test_sketches_of_few_values_are_exact(spark, grain, months):
    rows = with_time(model(spark), "who", ("Current", "MTD", "YTD", "PY"), grain, ["fact.g"], sketch=12).collect()
    have = {(r["g"], r["year"], r[grain] if grain != "year" else 1): (r["cur"], r["mtd"], r["ytd"], r["py"]) for r in rows}
    assert have == plain("who", months)


def test_sketches_within_their_error_and_without_value_rows(spark, monkeypatch):
    from tessera.plans import timeintel
    big = model(spark).replace_table("fact", lambda: spark.range(60000).select(
        F.lit("a").alias("g"), F.expr("date_add(DATE '2020-01-01', CAST(id % 700 AS INT))").alias("d"), (F.col("id") * 7919 % 20011).cast("int").alias("k"))
        .withColumn("key", F.date_format("d", "yyyyMMdd").cast("int")))
    written = []
    real = timeintel.materialize
    monkeypatch.setattr(timeintel, "materialize", lambda df: (written.append(real(df)), written[-1])[1])
    near = {(r["year"], r["month"]): r for r in with_time(big, "who", ("Current", "YTD"), "month", sketch=12).collect()}
    assert [w.count() for w in written] == [23]  # a sketch a month
    exact = {(r["year"], r["month"]): r for r in with_time(big, "who", ("Current", "YTD"), "month").collect()}
    assert set(near) == set(exact)
    assert all(abs(near[p][c] - exact[p][c]) <= 4 * 1.04 / 64 * exact[p][c] for p in exact for c in ("cur", "ytd") if exact[p][c])
    cut = {"date.date": F.col("date") <= F.lit(dt.date(2020, 5, 10))}
    a, b = (with_time(big, "who", ("Current", "YTD"), "month", filters=cut, **k).orderBy("year", "month").collect() for k in ({}, {"sketch": 12}))
    assert len(a) == len(b) == 5 and all(abs(x["ytd"] - y["ytd"]) <= 4 * 1.04 / 64 * x["ytd"] for x, y in zip(a, b))
    with pytest.raises(ValueError):
        with_time(model(spark), "total", sketch=12)


def test_year_over_year_and_refused_grain(spark):
    r = {(x.year, x.quarter): (x.yoy, x.yoy_pct) for x in with_time(model(spark), "total", ("YOY", "YOY%"), "quarter").collect()}
    assert r[2021, 1] == (21.0 - 31.0, (21.0 - 31.0) / 31.0)
    with pytest.raises(ValueError):
        with_time(model(spark), "total", grain="week")


def test_order_by_metadata(spark):
    """Months by their number without a hand-written key, items by their ordinal, null groups first."""
    from tessera.plans.timeintel import items_long
    m = model(spark)
    date = m.tables["date"]
    named = lambda: date().withColumn("month", F.date_format("date", "MMM"))
    m = m.replace_table("date", named)
    m.sort_by = {"date.month": "month_number"}
    df = m.evaluate(["total"], ["date.month", "fact.g"])
    assert {f.name: f.metadata for f in df.schema.fields} == {
        "month": {"group": "date.month", "sort_by": "month_number"}, "g": {"group": "fact.g"}, "total": {}}
    rows = m.order(df.repartition(5), position="at").collect()
    months = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]
    assert [r["at"] for r in rows] == list(range(1, len(rows) + 1))
    assert [(r["month"], r["g"]) for r in rows] == sorted(((r["month"], r["g"]) for r in rows), key=lambda r: (months.index(r[0]), r[1] is not None, r[1] or ""))
    long = items_long(with_time(m, "total", ("Current", "PY", "YOY"), "year", ["fact.g"]), ["g", "year"], ("Current", "PY", "YOY"))
    got = [(r["g"], r["year"], r["time_calculation"]) for r in m.order(long.repartition(4)).collect()]
    assert got == [(g, y, i) for g in (None, "a", "b") for y in ((2021,) if g is None else (2020, 2021)) for i in ("Current", "PY", "YOY")]
    assert m.order(spark.range(2)).count() == 2
