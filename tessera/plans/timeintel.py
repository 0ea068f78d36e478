"""Time intelligence: calculation items applied to any measure.

Items (with their ordinal): Current 0, MTD 1, YTD 2, PY 3, YOY 4, YOY% 5.

Evaluation runs on a *spine* of calendar periods × the groups present in the
result, after the measure has been reduced to partial aggregates per
(group, period).  Running windows therefore see one row per period and group,
never fact rows.  Non-additive measures carry (sum, count) through the window;
distinct counts count the *first occurrence* of each value per (group, year or
month) and take a running sum of those.

* day grain: PY is the same day a year earlier (``add_months(d, -12)``);
* month, quarter and year grain: PY is the same period a year earlier; MTD is the month to date at
  the period's last date (at month grain: Current).
* a filter on Date that cuts periods: Current covers the kept dates, PY the same dates a year
  earlier, MTD and YTD run from the first of the month or year to the last kept date.
* YOY = Current − PY with BLANK as 0, BLANK only when both are BLANK.
* YOY% = DIVIDE(YOY, PY): NULL when PY is NULL or 0.
Periods where every requested item is NULL are dropped.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.plans.model import Model, align, distinct_count_with_blank, sketched, with_blank
from tessera.session import materialize

# Calculation items and their ordinals.
ITEMS = {"Current": 0, "MTD": 1, "YTD": 2, "PY": 3, "YOY": 4, "YOY%": 5}
MONTHS = {"month": 1, "quarter": 3, "year": 12}  # of a period
ITEM_COLUMN = {"Current": "cur", "MTD": "mtd", "YTD": "ytd", "PY": "py", "YOY": "yoy", "YOY%": "yoy_pct"}


def _null_safe_join(a: DataFrame, b: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    cond = None
    for k in keys:
        e = a[k].eqNullSafe(b[f"_r_{k}"])
        cond = e if cond is None else cond & e
    return a.join(b, cond, how).drop(*[f"_r_{k}" for k in keys])


def with_time(model: Model, measure: str, items=tuple(ITEMS), grain: str = "day",
              group_by: list[str] | None = None, filters: dict | None = None,
              date_column: str | None = None, sketch: int | None = None) -> DataFrame:
    """Apply calculation `items` to `measure` by 'day', 'month', 'quarter' or 'year'.

    Returns group columns, ``date`` (day grain) or ``year`` and ``month`` / ``quarter`` (none at year
    grain) and one column per item (cur, mtd, ytd, py, yoy, yoy_pct).

    Filters on Date choose which dates are shown; they do not cut the year to date or the year
    before, which look at all dates.  All other filters restrict the measure.  A measure that dates reach through a bridge (reviews, by the
    order dates of their customers) takes each bridge key once per period, and once per year or
    month in running values.

    With `sketch` (4 to 21) a distinct count is estimated from sketches of 2**sketch registers, one for
    each group and period, united for running values: no (period, value) rows are written, and the
    relative standard error is 1.04 / sqrt(2**sketch) (1.6 % at 12).  Not for measures that dates
    reach through a bridge.

    The day grain writes one row per group and day from the group's first date on: meant for groups
    of a dimension's attributes, not for millions of customers."""
    for it in items:
        if it not in ITEMS:
            raise ValueError(f"unknown calculation item {it!r}")
    if grain not in MONTHS and grain != "day":
        raise ValueError(f"grain must be 'day' or one of {tuple(MONTHS)}")
    group_by, filters = group_by or [], filters or {}
    shown = {r: c for r, c in filters.items() if r.split(".")[0] == "date"}
    filters = {r: c for r, c in filters.items() if r not in shown}
    m = model.measures[measure]
    if sketch is not None:
        m = sketched(m, sketch)
    gk = [f"g{i}" for i in range(len(group_by))]
    names = [g.rsplit(".", 1)[1] for g in group_by]
    day = grain == "day"
    if shown and not day and _cuts(model, shown, MONTHS[grain]):
        return _cut_periods(model, measure, items, grain, group_by, filters, shown, date_column, sketch)
    wide = 1 if day else MONTHS[grain]
    a_year = 12 // wide
    base = (lambda c: F.to_date(c)) if day else _month_number
    period = base if wide == 1 else (lambda c: F.floor(base(c) / wide))
    year = (lambda p: F.year(p)) if day else (lambda p: F.floor(p / a_year))
    month = (lambda p: F.year(p) * 12 + F.month(p)) if day else (lambda p: p)
    keys = gk + ["_p"]
    # rows come by day or month; a wider period takes its months, and its last one as the month to date
    coarse = (lambda rows: rows) if wide == 1 else (lambda rows: rows.withColumns(
        {"_last": F.pmod(F.col("_p"), F.lit(wide)) == wide - 1, "_p": F.floor(F.col("_p") / wide)}))

    # per (group, period): what it has itself (c0, c1), and what it adds to the year (y0, y1) and the
    # month (m0, m1) so far; small (groups x periods)
    dcol = date_column or model.date_columns[m.table]
    through = [] if date_column or not model.related_to_dates(m) else model.path("date", m.table, m)
    if len(through) > 1 and sketch is not None:
        raise ValueError(f"dates reach {measure} through a bridge: it cannot be sketched by period")
    if len(through) > 1:
        pairs, per_key = model.period_pairs(m, group_by, filters, base)
        pairs = coarse(materialize(pairs))
        parts = [_reduced(_first(rows, gk, over, "_k").join(per_key, F.col("_k") == F.col("_hk")), keys, m.kind, name)
                 for name, rows, over in (("c", pairs, None), ("y", pairs, year), ("m", _in_last(pairs), month))]
        part = materialize(_stacked(parts, keys))
    elif m.kind == "distinct":
        values = materialize(model.partials(m, group_by, filters, extra_home={"_p": base(F.col(dcol))}))
        values = coarse(values.withColumn("_vk", with_blank(F.col("_v"))))
        parts = [_first(rows, gk, over, "_vk").groupBy(*keys).agg(F.count(F.lit(1)).alias(f"{name}0"))
                 .withColumn(f"{name}1", F.lit(None).cast("bigint"))
                 for name, rows, over in (("c", values, None), ("y", values, year), ("m", _in_last(values), month))]
        part = materialize(_stacked(parts, keys))
    elif sketch is not None:
        part = coarse(model.partials(m, group_by, filters, extra_home={"_p": base(F.col(dcol))}))
        if wide > 1:  # one sketch a month; a wider period unites them
            part = part.groupBy(*keys).agg(F.hll_union_agg("_p0").alias("_p0"), F.count_if("_last").alias("_n"),
                                           F.hll_union_agg(F.when(F.col("_last"), F.col("_p0"))).alias("_l"))
            part = part.withColumn("m0", F.when(F.col("_n") > 0, F.col("_l")))
        part = materialize(part.select(*keys, F.col("_p0").alias("c0"), *["m0"] * (wide > 1)))
        one = F.lit(None).cast("bigint")
        part = part.withColumns({"y0": F.col("c0"), "m0": F.col("m0" if wide > 1 else "c0"), "c1": one, "y1": one, "m1": one})
    elif wide > 1:
        part = coarse(model.partials(m, group_by, filters, extra_home={"_p": base(F.col(dcol))}))
        both = ["_p0", "_p1"] if m.kind == "avg" else ["_p0"]
        part = part.groupBy(*keys).agg(*[F.sum(c).alias(f"{n}{c[-1]}") for n in "cy" for c in both],
                                       *[F.sum(F.when(F.col("_last"), F.col(c))).alias(f"m{c[-1]}") for c in both])
        part = materialize(part if m.kind == "avg" else part.withColumns({f"{n}1": F.lit(None).cast("bigint") for n in "cym"}))
    else:
        part = model.partials(m, group_by, filters, extra_home={"_p": base(F.col(dcol))})
        second = F.col("_p1") if m.kind == "avg" else F.lit(None).cast("bigint")
        part = materialize(part.select(*keys, *[F.col("_p0").alias(f"{n}0") for n in "cym"],
                                       *[second.alias(f"{n}1") for n in "cym"]))

    # spine: for every group, the calendar periods from its first period to the end of the
    # year after its last one (earlier or later periods would carry no item value), clipped
    # to the calendar; the group ranges come from the small partials table
    cal = model.table("date")
    bounds = cal.agg(F.min(period(F.col("date"))).alias("_lo"), F.max(period(F.col("date"))).alias("_hi"))
    ranges = part.groupBy(*gk).agg(F.min("_p").alias("_gmin"), F.max("_p").alias("_gmax"))
    last = F.make_date(F.year("_gmax") + 1, F.lit(12), F.lit(31)) if day else (F.floor(F.col("_gmax") / a_year) + 2) * a_year - 1
    spine = (ranges.join(F.broadcast(bounds), F.lit(True))  # one row
             .withColumns({"_lo": F.greatest("_lo", "_gmin"), "_hi": F.least(F.col("_hi"), last)}).filter("_lo <= _hi"))
    if not day:
        spine = spine.withColumns({c: F.col(c).cast("int") for c in ("_lo", "_hi")})
    spine = spine.select(*gk, F.explode(F.sequence("_lo", "_hi")).alias("_p"))
    s = _null_safe_join(spine, part.select(*[F.col(k).alias(f"_r_{k}") for k in keys],
                                           *[f"{n}{i}" for n in "cym" for i in "01"]), keys)
    s = s.withColumns({"_y": year(F.col("_p")), "_m": month(F.col("_p"))})

    value = (lambda a, b: F.try_divide(a, b.cast("double"))) if m.kind == "avg" else (lambda a, b: a)
    so_far = lambda *by: Window.partitionBy(*gk, *by).orderBy("_p").rowsBetween(Window.unboundedPreceding, 0)
    running = lambda n, w: value(F.sum(f"{n}0").over(w), F.sum(f"{n}1").over(w))
    if sketch is not None:
        value = lambda a, b: F.hll_sketch_estimate(a)
        running = lambda n, w: F.when(F.count(f"{n}0").over(w) > 0,
                                      F.hll_sketch_estimate(F.hll_union_agg(f"{n}0").over(w)))
    s = s.withColumns({"cur": value(F.col("c0"), F.col("c1")), "ytd": running("y", so_far("_y")),
                       "mtd": running("m", so_far("_y", "_m"))})
    base = s.select(*gk, "_p", "cur", "mtd", "ytd")
    if day:
        before = base.select(*[F.col(k).alias(f"_r_{k}") for k in gk], F.col("_p").alias("_r_pp"), F.col("cur").alias("py"))
        out = _null_safe_join(base.withColumn("pp", F.add_months("_p", -12)), before,
                              gk + ["pp"]).drop("pp")
    else:  # the spine has no gaps
        out = base.withColumn("py", F.lag("cur", a_year).over(Window.partitionBy(*gk).orderBy("_p")))
    out = _with_yoy(out)
    if shown:
        out = out.join(F.broadcast(model._filtered("date", shown).select(period(F.col("date")).alias("_p")).distinct()), "_p", "left_semi")
    cols = [ITEM_COLUMN[i] for i in items]
    out = out.filter(F.greatest(*[F.col(c).isNotNull() for c in cols]) if len(cols) > 1 else F.col(cols[0]).isNotNull())
    per = [F.col("_p").alias("date", metadata={"group": "date.date"})] if day else _named(grain)
    return out.select(*[F.col(g).alias(n, metadata=model.about(ref)) for g, n, ref in zip(gk, names, group_by)], *per, *cols)


def _month_number(c: Column) -> Column:
    return F.year(c) * 12 + F.month(c) - 1


def _named(grain: str) -> list[Column]:
    """The columns of a period that name it."""
    a_year = 12 // MONTHS[grain]
    out = [F.floor(F.col("_p") / a_year).cast("int").alias("year", metadata={"group": "year"})]
    return out if a_year == 1 else out + [
        (F.pmod(F.col("_p"), F.lit(a_year)) + 1).cast("int").alias(grain, metadata={"group": grain})]


def _with_yoy(out: DataFrame) -> DataFrame:
    """Adds yoy and yoy_pct from cur and py."""
    yoy = F.when(F.col("cur").isNull() & F.col("py").isNull(), F.lit(None)) \
        .otherwise(F.coalesce(F.col("cur"), F.lit(0)) - F.coalesce(F.col("py"), F.lit(0)))
    out = out.withColumn("yoy", yoy)
    return out.withColumn("yoy_pct", F.try_divide(F.col("yoy").cast("double"), F.col("py").cast("double")))


def _in_last(rows: DataFrame) -> DataFrame:
    """Rows of the last month of a period of several months."""
    return rows.filter("_last") if "_last" in rows.columns else rows


def _cuts(model: Model, shown: dict, months: int) -> bool:
    """True if filters on Date keep a part of a period only (the Date table is bounded)."""
    days = lambda df, name: df.groupBy(F.floor(_month_number(F.col("date")) / months).alias("_p")).agg(
        F.count(F.lit(1)).alias(name))
    kept = days(model._filtered("date", shown), "_kept")
    return not kept.join(days(model.table("date"), "_all"), "_p").filter("_kept < _all").isEmpty()


def _cut_periods(model: Model, measure: str, items, grain: str, group_by: list[str], filters: dict, shown: dict,
                 date_column: str | None, sketch: int | None) -> DataFrame:
    """``with_time`` by month, quarter or year where a Date filter keeps a part of a period.  Current and PY come
    from the rows of the kept dates (and of the same dates a year earlier); the running items are those of
    the last kept date at day grain."""
    m = model.measures[measure] if sketch is None else sketched(model.measures[measure], sketch)
    gk = [f"g{i}" for i in range(len(group_by))]
    names = [g.rsplit(".", 1)[1] for g in group_by]
    kept = model._filtered("date", shown).select("date", F.floor(_month_number(F.col("date")) / MONTHS[grain]).alias("_p"))
    kept = materialize(kept)  # calendar size
    through = [] if date_column or not model.related_to_dates(m) else model.path("date", m.table, m)
    day = F.to_date
    if len(through) > 1:
        rows, per_key = model.period_pairs(m, group_by, filters, day)
        rows = rows.withColumnRenamed("_p", "_d")
    else:
        rows = model.partials(m, group_by, filters, extra_home={"_d": day(F.col(date_column or model.date_columns[m.table]))})
    rows = materialize(rows)

    def over(dates: DataFrame, name: str) -> DataFrame:
        dates = dates.distinct().withColumnRenamed("date", "_date")
        here = rows.join(F.broadcast(dates), F.col("_d") == F.col("_date"))
        keys = gk + ["_p"]
        if len(through) > 1:
            here = here.select(*keys, "_k").distinct().join(per_key, F.col("_k") == F.col("_hk"))
        total = F.sum("_p0") if m.kind != "distinct" else distinct_count_with_blank(F.col("_v"))
        total = total if sketch is None else F.hll_sketch_estimate(F.hll_union_agg("_p0"))
        value = F.try_divide(F.sum("_p0"), F.sum("_p1").cast("double")) if m.kind == "avg" else total
        return here.groupBy(*keys).agg(value.alias(name))

    cur = over(kept, "cur")
    py = over(kept.select(F.add_months("date", -12).alias("date"), "_p"), "py")
    last = kept.groupBy("_p").agg(F.max("date").alias("_last"))
    running = with_time(model, measure, ("MTD", "YTD"), "day", group_by, filters, date_column, sketch)
    running = running.select(*[F.col(n).alias(g) for g, n in zip(gk, names)], "date", "mtd", "ytd")
    running = running.join(F.broadcast(last), F.col("date") == F.col("_last")).select(*gk, "_p", "mtd", "ytd")
    out = align(align(cur, py, gk + ["_p"]), running, gk + ["_p"])
    out = _with_yoy(out)
    cols = [ITEM_COLUMN[i] for i in items]
    out = out.filter(F.coalesce(*[F.col(c).cast("double") for c in cols]).isNotNull())
    return out.select(*[F.col(g).alias(n, metadata=model.about(ref)) for g, n, ref in zip(gk, names, group_by)], *_named(grain), *cols)


def _first(rows: DataFrame, gk: list[str], over, key: str) -> DataFrame:
    """(group, _p, key) rows; with `over` (year or month of a period) only the first period of each
    key in it."""
    if over is None:
        return rows.select(*gk, "_p", key).distinct()
    return rows.groupBy(*gk, over(F.col("_p")).alias("_o"), key).agg(F.min("_p").alias("_p"))


def _reduced(rows: DataFrame, keys: list[str], kind: str, name: str) -> DataFrame:
    second = F.sum("_p1") if kind == "avg" else F.lit(None).cast("bigint")
    return rows.groupBy(*keys).agg(F.sum("_p0").alias(f"{name}0"), second.alias(f"{name}1"))


def _stacked(parts: list[DataFrame], keys: list[str]) -> DataFrame:
    """Parts with columns c0, c1 / y0, y1 / m0, m1 as one row per key."""
    every = [c for p in parts for c in p.columns if c not in keys]
    types = {c: t for p in parts for c, t in p.dtypes}
    rows = None
    for p in parts:
        p = p.select(*keys, *[F.col(c) if c in p.columns else F.lit(None).cast(types[c]).alias(c) for c in every])
        rows = p if rows is None else rows.unionByName(p)
    return rows.groupBy(*keys).agg(*[F.max(c).alias(c) for c in every])


def items_long(df: DataFrame, id_cols: list[str], items=tuple(ITEMS)) -> DataFrame:
    """Stack item columns into (time_calculation, ordinal, value) rows, sortable by ordinal."""
    expr = ", ".join(f"'{it}', {ITEMS[it]}, cast(`{ITEM_COLUMN[it]}` as double)" for it in items)
    long = df.selectExpr(*[f"`{c}`" for c in id_cols],
                         f"stack({len(items)}, {expr}) as (time_calculation, ordinal, value)")
    return long.withColumn("time_calculation", F.col("time_calculation").alias(
        "time_calculation", metadata={"group": "time_calculation", "sort_by": "ordinal"}))
