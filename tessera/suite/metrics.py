"""Registered queries: model fact, measures, bridged filters, drill, formats,
time intelligence."""
from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.dates import boundary_diff
from tessera.functions.text import format_measure, length_profile
from tessera.plans.sales import orders_fact, sales_model
from tessera.plans.timeintel import items_long, with_time
from tessera.sources.tables import load
from tessera.suite.common import FACT_SQL, rounded
from tessera.suite.registry import query

F_ = FACT_SQL


# --- fact and plain measures ---------------------------------------------------

@query("orders_fact", sql=f"""
SELECT o_orderkey, l_linenumber, l_partkey, date_key, CAST(delivery_hours AS BIGINT) AS delivery_hours,
       l_extendedprice FROM {F_} f""")
def q_orders_fact(spark, sf):
    f = orders_fact(load(spark, sf, "orders"), load(spark, sf, "lineitem"))
    return f.select("o_orderkey", "l_linenumber", "l_partkey", "date_key", "delivery_hours", "l_extendedprice")


@query("sales_by_dim", sql=f"""
SELECT c.c_mktsegment, round(sum(f.l_extendedprice), 2) AS total_sales, count(*) AS total_orders,
       CAST(count(DISTINCT f.o_custkey) + max(CASE WHEN f.o_custkey IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS active_customers
FROM {F_} f LEFT JOIN customer c ON f.o_custkey = c.c_custkey GROUP BY 1""")
def q_sales_by_dim(spark, sf):
    m = sales_model(spark, sf)
    return rounded(m.evaluate(["total_sales", "total_orders", "active_customers"], ["customer.c_mktsegment"]))


@query("sales_by_month_ordered", sql=f"""
SELECT strftime(order_date, '%b') AS month, c.c_mktsegment, round(sum(f.l_extendedprice), 2) AS total_sales,
       CAST(row_number() OVER (ORDER BY min(month(order_date)), c.c_mktsegment NULLS FIRST) AS INTEGER) AS position
FROM {F_} f LEFT JOIN customer c ON f.o_custkey = c.c_custkey GROUP BY 1, 2""")
def q_sales_by_month_ordered(spark, sf):
    """Sales by the name of the month and segment, in the order that the model gives its columns: months by
    their number (from the column's metadata), segments by name."""
    m = sales_model(spark, sf)
    return m.order(rounded(m.evaluate(["total_sales"], ["date.month", "customer.c_mktsegment"])), position="position")


@query("sales_blank_member", sql=f"""
SELECT p.p_type, round(sum(f.l_extendedprice), 2) AS total_sales, count(*) AS total_orders
FROM {F_} f LEFT JOIN (SELECT * FROM part WHERE p_size > 10) p ON f.l_partkey = p.p_partkey GROUP BY 1""")
def q_sales_blank_member(spark, sf):
    """Parts of size <= 10 are missing from the dimension: their sales form the blank group."""
    m = sales_model(spark, sf)
    m = m.replace_table("part", lambda: load(spark, sf, "part").filter(F.col("p_size") > 10))
    return rounded(m.evaluate(["total_sales", "total_orders"], ["part.p_type"]))


def _bridge_sql(agg: str, name: str) -> str:
    return f"""
WITH b AS (SELECT DISTINCT p.p_type, f.o_custkey FROM {F_} f JOIN part p ON f.l_partkey = p.p_partkey)
SELECT b.p_type, {agg} AS {name} FROM b JOIN events e ON e.user_id = b.o_custkey GROUP BY 1"""


@query("avg_review_bridged", sql=_bridge_sql("round(avg(e.value), 4)", "average_review"))
def q_avg_review_bridged(spark, sf):
    return rounded(sales_model(spark, sf).evaluate(["average_review"], ["part.p_type"]), 4)


@query("total_reviews_bridged", sql=_bridge_sql("count(*)", "total_reviews"))
def q_total_reviews_bridged(spark, sf):
    return sales_model(spark, sf).evaluate(["total_reviews"], ["part.p_type"])


@query("avg_defect_bridged", sql=_bridge_sql(
    "round(avg(CASE WHEN e.event_type = 'error' THEN 1.0 ELSE 0.0 END), 4)", "avg_defect_ratio"))
def q_avg_defect_bridged(spark, sf):
    return rounded(sales_model(spark, sf).evaluate(["avg_defect_ratio"], ["part.p_type"]), 4)


@query("reviews_by_region_multihop", sql=f"""
WITH b AS (SELECT DISTINCT r.r_name, f.o_custkey FROM {F_} f
           JOIN customer c ON f.o_custkey = c.c_custkey
           JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey)
SELECT b.r_name, round(avg(e.value), 4) AS average_review, count(*) AS total_reviews
FROM b JOIN events e ON e.user_id = b.o_custkey GROUP BY 1""")
def q_reviews_by_region(spark, sf):
    return rounded(sales_model(spark, sf).evaluate(["average_review", "total_reviews"],
                                                   ["geo_customers.r_name"]), 4)


@query("sales_by_payment_type", sql=f"""
WITH b AS (SELECT DISTINCT event_type, user_id FROM events)
SELECT b.event_type AS payment_type, round(sum(f.l_extendedprice), 2) AS total_sales, count(*) AS total_orders
FROM {F_} f JOIN b ON f.o_custkey = b.user_id GROUP BY 1""")
def q_sales_by_payment_type(spark, sf):
    return rounded(sales_model(spark, sf).evaluate(["total_sales", "total_orders"], ["payments.payment_type"]))


@query("sales_by_region_bridge", sql=f"""
WITH b AS (SELECT DISTINCT r.r_name, c.c_custkey FROM customer c
           JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey)
SELECT b.r_name, round(sum(f.l_extendedprice), 2) AS total_sales,
       CAST(count(DISTINCT f.o_custkey) AS BIGINT) AS active_customers
FROM {F_} f JOIN b ON f.o_custkey = b.c_custkey GROUP BY 1""")
def q_sales_by_region_bridge(spark, sf):
    return rounded(sales_model(spark, sf).evaluate(["total_sales", "active_customers"], ["geo_customers.r_name"]))


@query("active_customers", sql=f"""
SELECT p.p_type, CAST(count(DISTINCT k) + max(CASE WHEN k IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS active_customers
FROM (SELECT *, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_custkey END AS k FROM {F_} x) f
LEFT JOIN part p ON f.l_partkey = p.p_partkey GROUP BY 1""")
def q_active_customers(spark, sf):
    """Distinct customers per part type; customers of pending orders are blanked, and the
    blank counts as one value (DISTINCTCOUNT semantics)."""
    m = sales_model(spark, sf)
    base = m.tables["orders"]
    m = m.replace_table("orders", lambda: base().withColumn(
        "o_custkey", F.when(F.col("o_orderstatus") == "P", F.lit(None)).otherwise(F.col("o_custkey"))))
    return m.evaluate(["active_customers"], ["part.p_type"])


@query("avg_delivery_hours", sql=f"""
SELECT s.s_nationkey, round(avg(f.delivery_hours), 4) AS avg_delivery_hours
FROM {F_} f LEFT JOIN supplier s ON f.l_suppkey = s.s_suppkey GROUP BY 1""")
def q_avg_delivery_hours(spark, sf):
    return rounded(sales_model(spark, sf).evaluate(["avg_delivery_hours"], ["supplier.s_nationkey"]), 4)


@query("event_hour_boundaries", sql="""
SELECT user_id, date_diff('hour', min(ts), max(ts)) AS hour_boundaries,
       date_sub('hour', min(ts), max(ts)) AS elapsed_hours
FROM events GROUP BY user_id""")
def q_event_hour_boundaries(spark, sf):
    e = load(spark, sf, "events").groupBy("user_id").agg(F.min("ts").alias("a"), F.max("ts").alias("b"))
    return e.select("user_id", boundary_diff("HOUR", "a", "b").alias("hour_boundaries"),
                    F.timestamp_diff("HOUR", F.col("a"), F.col("b")).alias("elapsed_hours"))


EVAL_FILTERS = {"part.p_type": ["ECONOMY", "SMALL"], "date.year_number": ("between", 1996, 1998)}


@query("evaluate_multi", sql=f"""
WITH f AS (SELECT f.* FROM {F_} f JOIN part p ON f.l_partkey = p.p_partkey
           WHERE p.p_type IN ('ECONOMY', 'SMALL') AND year(f.o_orderdate) BETWEEN 1996 AND 1998),
s AS (SELECT c.c_mktsegment, round(sum(l_extendedprice), 2) AS total_sales, count(*) AS total_orders,
             round(avg(delivery_hours), 4) AS avg_delivery_hours
      FROM f LEFT JOIN customer c ON f.o_custkey = c.c_custkey GROUP BY 1),
b AS (SELECT DISTINCT c.c_mktsegment, f.o_custkey FROM f JOIN customer c ON f.o_custkey = c.c_custkey),
r AS (SELECT b.c_mktsegment, round(avg(e.value), 4) AS average_review FROM b JOIN events e ON e.user_id = b.o_custkey
      GROUP BY 1)
SELECT coalesce(s.c_mktsegment, r.c_mktsegment) AS c_mktsegment, total_sales, total_orders, average_review,
       avg_delivery_hours
FROM s FULL JOIN r ON s.c_mktsegment IS NOT DISTINCT FROM r.c_mktsegment""")
def q_evaluate_multi(spark, sf):
    m = sales_model(spark, sf)
    r = m.evaluate(["total_sales", "total_orders", "average_review", "avg_delivery_hours"],
                   ["customer.c_mktsegment"], EVAL_FILTERS)
    return rounded(rounded(r, 2, ["total_sales"]), 4, ["average_review", "avg_delivery_hours"])


@query("metric_sql", sql=f"""
SELECT f.order_date AS date, round(sum(f.l_extendedprice), 2) AS total_sales
FROM {F_} f JOIN part p ON f.l_partkey = p.p_partkey
WHERE f.order_date BETWEEN DATE '1997-01-01' AND DATE '1997-12-31' AND p.p_type IN ('ECONOMY', 'STANDARD')
GROUP BY 1""")
def q_metric_sql(spark, sf):
    """Sales by date with BETWEEN and IN filters, ordered by date."""
    m = sales_model(spark, sf)
    r = m.evaluate(["total_sales"], ["date.date"],
                   {"date.date": ("between", "1997-01-01", "1997-12-31"), "part.p_type": ["ECONOMY", "STANDARD"]})
    return rounded(r).orderBy("date")


@query("sql_text_scan", sql="""
SELECT o_orderpriority, count(*) AS n, round(sum(o_totalprice), 2) AS total_price FROM orders
WHERE o_orderstatus IS NOT NULL AND o_orderstatus IN ('F', 'O') GROUP BY 1""")
def q_sql_text_scan(spark, sf):
    """Table scan by name + SQL text with a predicate on registered views."""
    load(spark, sf, "orders").createOrReplaceTempView("orders")
    return spark.sql("""SELECT o_orderpriority, count(*) AS n, round(sum(o_totalprice), 2) AS total_price
                        FROM orders WHERE o_orderstatus IS NOT NULL AND o_orderstatus IN ('F', 'O')
                        GROUP BY o_orderpriority""")


@query("drill_additive", sql=f"""
SELECT p.p_type, p.p_brand, CAST(GROUPING(p.p_type, p.p_brand) AS BIGINT) AS level,
       round(sum(f.l_extendedprice), 2) AS total_sales, count(*) AS total_orders
FROM {F_} f LEFT JOIN part p ON f.l_partkey = p.p_partkey GROUP BY ROLLUP (p.p_type, p.p_brand)""")
def q_drill_additive(spark, sf):
    m = sales_model(spark, sf)
    return rounded(m.drill(["total_sales", "total_orders"], "part", ["p_type", "p_brand"]))


@query("drill_distinct", sql=f"""
SELECT p.p_type, p.p_brand, CAST(GROUPING(p.p_type, p.p_brand) AS BIGINT) AS level,
       CAST(count(DISTINCT f.o_custkey) AS BIGINT) AS active_customers
FROM {F_} f LEFT JOIN part p ON f.l_partkey = p.p_partkey GROUP BY ROLLUP (p.p_type, p.p_brand)""")
def q_drill_distinct(spark, sf):
    m = sales_model(spark, sf)
    return m.drill(["active_customers"], "part", ["p_type", "p_brand"])


@query("default_summaries", sql=f"""
SELECT l_returnflag, round(sum(l_extendedprice), 2) AS sum_l_extendedprice, round(sum(l_tax), 2) AS sum_l_tax,
       round(sum(l_quantity), 2) AS sum_l_quantity FROM {F_} f GROUP BY 1""")
def q_default_summaries(spark, sf):
    return rounded(sales_model(spark, sf).summarize("orders", ["l_returnflag"]))


@query("fmt_currency", sql=f"""
SELECT c.c_mktsegment, 'R$ ' || format('{{:,}}', CAST(round(sum(f.l_extendedprice), 0) AS BIGINT)) AS total_sales_fmt,
       'R$' || format('{{:,.2f}}', round(avg(f.l_extendedprice), 2)) AS avg_price_fmt
FROM {F_} f LEFT JOIN customer c ON f.o_custkey = c.c_custkey GROUP BY 1""")
def q_fmt_currency(spark, sf):
    """Measures rendered with their display formats, in segment order."""
    m = sales_model(spark, sf)
    f = m.table("orders").join(load(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"), "left")
    r = f.groupBy("c_mktsegment").agg(F.sum("l_extendedprice").alias("s"), F.avg("l_extendedprice").alias("a"))
    return r.select("c_mktsegment", format_measure("s", '"R$" #,0').alias("total_sales_fmt"),
                    format_measure("a", '"R$"#,0.00').alias("avg_price_fmt")).orderBy("c_mktsegment")


@query("text_length_profile", sql="""
SELECT lang, count(*) AS n, round(avg(length(text)), 4) AS mean, round(stddev_samp(length(text)), 4) AS stddev,
       min(length(text)) AS min, quantile_disc(length(text), 0.25) AS q1, quantile_disc(length(text), 0.5) AS median,
       quantile_disc(length(text), 0.75) AS q3, max(length(text)) AS max
FROM documents WHERE text IS NOT NULL GROUP BY lang""")
def q_text_length_profile(spark, sf):
    p = length_profile(load(spark, sf, "documents"), "text", ["lang"])
    return rounded(p, 4).select("lang", F.col("n").cast("bigint").alias("n"), "mean", "stddev",
                                F.col("min").cast("bigint").alias("min"), F.col("q1").cast("bigint").alias("q1"),
                                F.col("median").cast("bigint").alias("median"), F.col("q3").cast("bigint").alias("q3"),
                                F.col("max").cast("bigint").alias("max"))


@query("clean_sales", sql=f"""
SELECT l_extendedprice AS sales, o_orderdate AS date FROM {F_} f
WHERE o_orderstatus = 'F' AND year(o_orderdate) >= 1996 AND NOT (year(o_orderdate) = 1996 AND month(o_orderdate) = 9)""")
def q_clean_sales(spark, sf):
    from tessera.operators.series import clean_sales
    f = orders_fact(load(spark, sf, "orders"), load(spark, sf, "lineitem"))
    return clean_sales(f, "o_orderdate", "l_extendedprice", from_year=1996, exclude_months=[(1996, 9)],
                       status_col="o_orderstatus", status="F")


# --- time intelligence ------------------------------------------------------------

def _ti_sql(val: str, kind: str, grain: str, items: list[str], group: str | None = None,
            joins: str = "", digits: int = 2) -> str:
    """Oracle for calculation items: spine of calendar periods x groups, windows, PY self-join."""
    g = "g" if group else "NULL"
    gsel = f"{group} AS g" if group else "NULL AS g"
    if grain == "day":
        per, spine_expr = "f.order_date", "unnest(generate_series(make_date(y0, 1, 1), make_date(y1, 12, 31), INTERVAL 1 DAY))"
        yr, mo, prev = "year(x.p)", "month(x.p)", "CAST(x.p - INTERVAL 12 MONTH AS DATE)"
        pcols = "CAST(p AS DATE) AS date"
    else:
        per, spine_expr = "year(f.order_date) * 12 + month(f.order_date) - 1", "unnest(generate_series(y0 * 12, y1 * 12 + 11))"
        yr, mo, prev = "x.p // 12", "x.p", "x.p - 12"
        pcols = "CAST(p // 12 AS INTEGER) AS year, CAST(p % 12 + 1 AS INTEGER) AS month"
    if kind == "sum":
        part, cur, run = "sum(v) AS s", "s", "sum(s)"
    elif kind == "count":
        part, cur, run = "count(*) AS s", "s", "sum(s)"
    else:
        part, cur, run = "sum(v) AS s, count(v) AS c", "s / c", None
    if run:
        ytd = f"{run} OVER (PARTITION BY g, {yr} ORDER BY x.p ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
        mtd = f"{run} OVER (PARTITION BY g, {yr}, {mo} ORDER BY x.p ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    else:
        w = lambda part_by: (f"sum(s) OVER (PARTITION BY {part_by} ORDER BY x.p ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"  # noqa: E731
                             f" / sum(c) OVER (PARTITION BY {part_by} ORDER BY x.p ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)")
        ytd, mtd = w(f"g, {yr}"), w(f"g, {yr}, {mo}")
    if grain == "month":
        mtd = cur
    rnd = {"cur": digits, "mtd": digits, "ytd": digits, "py": digits, "yoy": digits, "yoy_pct": 6}
    cols = {"Current": "cur", "MTD": "mtd", "YTD": "ytd", "PY": "py", "YOY": "yoy", "YOY%": "yoy_pct"}
    sel = [cols[i] for i in items]
    out = ", ".join(f"round({c}, {rnd[c]}) AS {c}" for c in sel)
    keep = " OR ".join(f"{c} IS NOT NULL" for c in sel)
    gout = f"g AS {group.split('.')[-1]}, " if group else ""
    return f"""
WITH f AS (SELECT {gsel}, {per} AS p, {val} AS v FROM {F_} f {joins}),
b AS (SELECT min(year(o_orderdate)) AS y0, max(year(o_orderdate)) AS y1 FROM orders),
gs AS (SELECT DISTINCT g FROM f),
sp AS (SELECT gs.g, x.p FROM gs, (SELECT {spine_expr} AS p FROM b) x),
d AS (SELECT g, p, {part} FROM f GROUP BY g, p),
x AS (SELECT sp.g, sp.p, d.* EXCLUDE (g, p) FROM sp LEFT JOIN d ON sp.g IS NOT DISTINCT FROM d.g AND sp.p = d.p),
y AS (SELECT x.g, x.p, {cur} AS cur, {mtd} AS mtd, {ytd} AS ytd FROM x),
z AS (SELECT y.*, q.cur AS py FROM y LEFT JOIN y q ON q.g IS NOT DISTINCT FROM y.g AND q.p = {prev.replace('x.p', 'y.p')}),
r AS (SELECT *, CASE WHEN cur IS NULL AND py IS NULL THEN NULL ELSE coalesce(cur, 0) - coalesce(py, 0) END AS yoy FROM z),
t AS (SELECT *, CASE WHEN py IS NULL OR py = 0 THEN NULL ELSE yoy / py END AS yoy_pct FROM r)
SELECT {gout}{pcols}, {out} FROM t WHERE {keep}""".replace("{g}", g)


def _ti(spark, sf, measure, items, grain, group=None, digits=2):
    m = sales_model(spark, sf)
    r = with_time(m, measure, items, grain, [group] if group else None)
    if "yoy_pct" in r.columns:
        r = rounded(r, 6, ["yoy_pct"])
    return rounded(r, digits, [c for c in r.columns if c != "yoy_pct"])


@query("ti_all", sql=_ti_sql("f.l_extendedprice", "sum", "day", ["Current", "MTD", "YTD", "PY", "YOY", "YOY%"]))
def q_ti_all(spark, sf):
    """Flagship: daily sales with every calculation item."""
    return _ti(spark, sf, "total_sales", ["Current", "MTD", "YTD", "PY", "YOY", "YOY%"], "day")


@query("ti_mtd", sql=_ti_sql("f.l_extendedprice", "sum", "day", ["MTD"]))
def q_ti_mtd(spark, sf):
    return _ti(spark, sf, "total_sales", ["MTD"], "day")


@query("ti_ytd", sql=_ti_sql("f.l_extendedprice", "sum", "month", ["YTD"], "c.c_mktsegment",
                             "LEFT JOIN customer c ON f.o_custkey = c.c_custkey"))
def q_ti_ytd(spark, sf):
    return _ti(spark, sf, "total_sales", ["YTD"], "month", "customer.c_mktsegment")


@query("ti_py", sql=_ti_sql("f.l_extendedprice", "sum", "month", ["Current", "PY"]))
def q_ti_py(spark, sf):
    return _ti(spark, sf, "total_sales", ["Current", "PY"], "month")


@query("ti_yoy", sql=_ti_sql("1", "count", "month", ["YOY"], "p.p_type",
                             "LEFT JOIN part p ON f.l_partkey = p.p_partkey"))
def q_ti_yoy(spark, sf):
    return _ti(spark, sf, "total_orders", ["YOY"], "month", "part.p_type")


@query("ti_yoy_pct", sql=_ti_sql("f.l_extendedprice", "sum", "day", ["PY", "YOY", "YOY%"]))
def q_ti_yoy_pct(spark, sf):
    return _ti(spark, sf, "total_sales", ["PY", "YOY", "YOY%"], "day")


@query("ti_ytd_average", sql=_ti_sql("f.delivery_hours", "avg", "month", ["Current", "YTD"], digits=4))
def q_ti_ytd_average(spark, sf):
    return _ti(spark, sf, "avg_delivery_hours", ["Current", "YTD"], "month", digits=4)


@query("ti_ytd_distinct", sql=f"""
WITH f AS (SELECT year(o_orderdate) AS y, month(o_orderdate) AS m, o_custkey AS k FROM {F_} x),
b AS (SELECT min(y) AS y0, max(y) AS y1 FROM f),
sp AS (SELECT unnest(generate_series(y0 * 12, y1 * 12 + 11)) AS p FROM b),
cur AS (SELECT y * 12 + m - 1 AS p, count(DISTINCT k) AS cur FROM f GROUP BY 1),
ytd AS (SELECT sp.p, (SELECT count(DISTINCT k) FROM f WHERE f.y = sp.p // 12 AND f.m - 1 <= sp.p % 12) AS ytd FROM sp)
SELECT CAST(ytd.p // 12 AS INTEGER) AS year, CAST(ytd.p % 12 + 1 AS INTEGER) AS month, cur.cur AS cur,
       CAST(CASE WHEN ytd.ytd = 0 THEN NULL ELSE ytd.ytd END AS BIGINT) AS ytd
FROM ytd LEFT JOIN cur ON cur.p = ytd.p WHERE cur.cur IS NOT NULL OR ytd.ytd > 0""")
def q_ti_ytd_distinct(spark, sf):
    """Year-to-date distinct customers by month: first occurrence per year, running count."""
    m = sales_model(spark, sf)
    return with_time(m, "active_customers", ["Current", "YTD"], "month")


@query("ti_items_long", sql=_ti_sql("f.l_extendedprice", "sum", "month", ["Current", "MTD", "YTD", "PY", "YOY", "YOY%"])
       .replace("SELECT CAST(p // 12 AS INTEGER) AS year,", "SELECT CAST(p // 12 AS INTEGER) AS year,", 1)
       .rsplit("SELECT", 1)[0] + """SELECT year, month, time_calculation, ordinal, round(value, 6) AS value FROM (
  SELECT CAST(p // 12 AS INTEGER) AS year, CAST(p % 12 + 1 AS INTEGER) AS month, cur, mtd, ytd, py, yoy, yoy_pct FROM t
  WHERE cur IS NOT NULL OR mtd IS NOT NULL OR ytd IS NOT NULL OR py IS NOT NULL OR yoy IS NOT NULL OR yoy_pct IS NOT NULL)
UNPIVOT (value FOR time_calculation IN (cur AS 'Current', mtd AS 'MTD', ytd AS 'YTD', py AS 'PY', yoy AS 'YOY',
                                        yoy_pct AS 'YOY%'))
JOIN (VALUES ('Current', 0), ('MTD', 1), ('YTD', 2), ('PY', 3), ('YOY', 4), ('YOY%', 5)) o(tc, ordinal)
  ON o.tc = time_calculation""")
def q_ti_items_long(spark, sf):
    """Monthly sales with every calculation item stacked as rows (time_calculation, ordinal,
    value), ordered by the item's ordinal."""
    m = sales_model(spark, sf)
    wide = with_time(m, "total_sales", ["Current", "MTD", "YTD", "PY", "YOY", "YOY%"], "month")
    long = items_long(wide, ["year", "month"])
    return rounded(long.filter(F.col("value").isNotNull()), 6).orderBy("year", "month", "ordinal")


@query("drill_average", sql=f"""
SELECT p.p_type, p.p_brand, CAST(GROUPING(p.p_type, p.p_brand) AS BIGINT) AS level,
       round(avg(f.delivery_hours), 4) AS avg_delivery_hours, round(sum(f.l_extendedprice), 2) AS total_sales
FROM {F_} f LEFT JOIN part p ON f.l_partkey = p.p_partkey GROUP BY ROLLUP (p.p_type, p.p_brand)""")
def q_drill_average(spark, sf):
    """Average delivery hours rolled up over the product hierarchy from (sum, count) partials."""
    m = sales_model(spark, sf)
    r = m.drill(["avg_delivery_hours", "total_sales"], "part", ["p_type", "p_brand"])
    return rounded(rounded(r, 4, ["avg_delivery_hours"]), 2, ["total_sales"])


@query("ti_mtd_distinct", sql=f"""
WITH f AS (SELECT CAST(o_orderdate AS DATE) AS d, o_custkey AS k FROM {F_} x),
b AS (SELECT min(year(d)) AS y0, max(year(d)) AS y1 FROM f),
sp AS (SELECT CAST(unnest(generate_series(make_date(y0, 1, 1), make_date(y1, 12, 31), INTERVAL 1 DAY)) AS DATE) AS d FROM b),
cur AS (SELECT d, count(DISTINCT k) AS cur FROM f GROUP BY d),
mtd AS (SELECT sp.d, (SELECT count(DISTINCT k) FROM f WHERE f.d BETWEEN date_trunc('month', sp.d) AND sp.d) AS mtd FROM sp)
SELECT mtd.d AS date, cur.cur AS cur, CAST(CASE WHEN mtd.mtd = 0 THEN NULL ELSE mtd.mtd END AS BIGINT) AS mtd
FROM mtd LEFT JOIN cur ON cur.d = mtd.d WHERE cur.cur IS NOT NULL OR mtd.mtd > 0""")
def q_ti_mtd_distinct(spark, sf):
    """Month-to-date distinct customers by day (first occurrence per month, running count),
    checked against a direct range count."""
    m = sales_model(spark, sf)
    return with_time(m, "active_customers", ["Current", "MTD"], "day")


# --- filters on Date, and measures that dates reach through a bridge -----------------------------

def _shown_sql(sql: str, where: str) -> str:
    """The unfiltered time-intelligence SQL with only some periods shown."""
    return f"SELECT * FROM ({sql}) shown WHERE {where}"


@query("ti_py_year_filter", sql=_shown_sql(_ti_sql("f.l_extendedprice", "sum", "month", ["Current", "PY", "YOY"]), "year = 1997"))
def q_ti_py_year_filter(spark, sf):
    """Sales of one year's months beside the year before: the filter does not cut the year before."""
    return rounded(with_time(sales_model(spark, sf), "total_sales", ["Current", "PY", "YOY"], "month",
                             filters={"date.year_number": 1997}))


@query("ti_ytd_month_filter", sql=_shown_sql(_ti_sql("f.l_extendedprice", "sum", "month", ["YTD"], "c.c_mktsegment",
       "LEFT JOIN customer c ON f.o_custkey = c.c_custkey WHERE c.c_mktsegment IN ('BUILDING', 'MACHINERY')"), "month = 6"))
def q_ti_ytd_month_filter(spark, sf):
    """Sales from January to June of every year in two segments: a Date filter that picks the months
    shown beside a filter that restricts the measure."""
    return rounded(with_time(sales_model(spark, sf), "total_sales", ["YTD"], "month", ["customer.c_mktsegment"],
                             {"date.month_number": 6, "customer.c_mktsegment": ["BUILDING", "MACHINERY"]}))


@query("ti_mtd_day_filter", sql=_shown_sql(_ti_sql("f.l_extendedprice", "sum", "day", ["Current", "MTD"]),
                                           "date BETWEEN DATE '1998-03-10' AND DATE '1998-04-05'"))
def q_ti_mtd_day_filter(spark, sf):
    """Days shown from the middle of a month: month to date still begins on its first day."""
    return rounded(with_time(sales_model(spark, sf), "total_sales", ["Current", "MTD"], "day",
                             filters={"date.date": ("between", "1998-03-10", "1998-04-05")}))


@query("ti_py_quarter", sql=f"""
WITH f AS (SELECT year(o_orderdate) * 12 + month(o_orderdate) - 1 AS mo, l_extendedprice AS v FROM {F_} x),
b AS (SELECT min(mo) // 3 AS lo, (max(mo) // 12 + 1) * 4 - 1 AS hi FROM f),
sp AS (SELECT unnest(generate_series(lo, hi)) AS q FROM b),
r AS (SELECT q, (SELECT sum(v) FROM f WHERE mo // 3 = q) AS cur, (SELECT sum(v) FROM f WHERE mo = q * 3 + 2) AS mtd,
             (SELECT sum(v) FROM f WHERE mo // 12 = q // 4 AND mo <= q * 3 + 2) AS ytd, (SELECT sum(v) FROM f WHERE mo // 3 = q - 4) AS py FROM sp)
SELECT CAST(q // 4 AS INTEGER) AS year, CAST(q % 4 + 1 AS INTEGER) AS quarter, round(cur, 2) AS cur, round(mtd, 2) AS mtd, round(ytd, 2) AS ytd,
       round(py, 2) AS py, round(CASE WHEN cur IS NULL AND py IS NULL THEN NULL ELSE coalesce(cur, 0) - coalesce(py, 0) END, 2) AS yoy
FROM r WHERE coalesce(cur, mtd, ytd, py) IS NOT NULL""")
def q_ti_py_quarter(spark, sf):
    """Sales by quarter: month and year to date at the quarter's end, the same quarter a year earlier."""
    return rounded(with_time(sales_model(spark, sf), "total_sales", ["Current", "MTD", "YTD", "PY", "YOY"], "quarter"))


@query("ti_year_distinct", sql=f"""
WITH f AS (SELECT c.c_mktsegment AS g, year(o_orderdate) AS y, month(o_orderdate) AS m, o_custkey AS k FROM {F_} x
             LEFT JOIN customer c ON x.o_custkey = c.c_custkey),
b AS (SELECT g, min(y) AS lo, least(max(y) + 1, (SELECT max(y) FROM f)) AS hi FROM f GROUP BY g),
sp AS (SELECT g, unnest(generate_series(lo, hi)) AS y FROM b),
r AS (SELECT sp.g, sp.y, count(DISTINCT f.k) AS cur, count(DISTINCT f.k) FILTER (f.m = 12) AS mtd FROM sp LEFT JOIN f ON f.g = sp.g AND f.y = sp.y GROUP BY ALL),
z AS (SELECT g, y, nullif(cur, 0) AS cur, nullif(mtd, 0) AS mtd, lag(nullif(cur, 0)) OVER (PARTITION BY g ORDER BY y) AS py FROM r)
SELECT g AS c_mktsegment, CAST(y AS INTEGER) AS year, cur, mtd, cur AS ytd, py FROM z WHERE coalesce(cur, mtd, py) IS NOT NULL""")
def q_ti_year_distinct(spark, sf):
    """Active customers of each segment and year: a customer counts once a year; the month to date is December's."""
    return with_time(sales_model(spark, sf), "active_customers", ["Current", "MTD", "YTD", "PY"], "year", ["customer.c_mktsegment"])


@query("ti_ytd_distinct_sketch", sql=f"""
WITH f AS (SELECT year(o_orderdate) AS y, month(o_orderdate) AS m, o_custkey AS k FROM {F_} x),
p AS (SELECT DISTINCT y, m FROM f)
SELECT CAST(p.y AS INTEGER) AS year, CAST(p.m AS INTEGER) AS month, (SELECT count(DISTINCT k) FROM f WHERE f.y = p.y AND f.m = p.m) AS cur,
       (SELECT count(DISTINCT k) FROM f WHERE f.y = p.y AND f.m <= p.m) AS ytd, true AS within_bound FROM p""")
def q_ti_ytd_distinct_sketch(spark, sf):
    """Active customers by month and year to date from mergeable sketches beside the exact counts: the estimates
    stay within four standard errors (6.5 % with 4,096 registers, one customer at least)."""
    m = sales_model(spark, sf)
    exact = with_time(m, "active_customers", ["Current", "YTD"], "month")
    near = with_time(m, "active_customers", ["Current", "YTD"], "month", sketch=12).select(
        F.col("year").alias("_y"), F.col("month").alias("_m"), F.col("cur").alias("_c"), F.col("ytd").alias("_t"))
    off = lambda a, b: F.abs(F.col(a) - F.col(b)) <= F.greatest(F.lit(1.0), 4 * 1.04 / 64 * F.col(a))
    j = exact.join(near, (F.col("year") == F.col("_y")) & (F.col("month") == F.col("_m"))).filter(F.col("cur").isNotNull())
    return j.select("year", "month", "cur", "ytd", (off("cur", "_c") & off("ytd", "_t")).alias("within_bound"))


_CUT_SQL = f"""
WITH f AS (SELECT CAST(o_orderdate AS DATE) AS d, l_extendedprice AS v, o_custkey AS k FROM {F_} x),
kept AS (SELECT CAST(unnest(generate_series(DATE '1997-12-20', DATE '1998-04-05', INTERVAL 1 DAY)) AS DATE) AS d),
p AS (SELECT year(d) AS y, month(d) AS m, max(d) AS last FROM kept GROUP BY 1, 2),
r AS (SELECT y, m,
  (SELECT {{a}} FROM f WHERE d IN (SELECT d FROM kept WHERE year(d) = y AND month(d) = m)) AS cur,
  (SELECT {{a}} FROM f WHERE d <= last AND d >= make_date(y, m, 1)) AS mtd, (SELECT {{a}} FROM f WHERE d <= last AND d >= make_date(y, 1, 1)) AS ytd,
  (SELECT {{a}} FROM f WHERE d IN (SELECT CAST(d - INTERVAL 1 YEAR AS DATE) FROM kept WHERE year(d) = y AND month(d) = m)) AS py FROM p)
SELECT CAST(y AS INTEGER) AS year, CAST(m AS INTEGER) AS month, {{cols}} FROM r"""


@query("ti_ytd_cut_month", sql=_CUT_SQL.format(a="sum(v)", cols=", ".join(f"round({c}, 2) AS {c}" for c in ("cur", "mtd", "ytd", "py"))))
def q_ti_ytd_cut_month(spark, sf):
    """Sales by month under a Date filter that begins and ends inside a month: kept dates, the same dates a year
    earlier, and running values at the last kept date."""
    return rounded(with_time(sales_model(spark, sf), "total_sales", ["Current", "MTD", "YTD", "PY"], "month",
                             filters={"date.date": ("between", "1997-12-20", "1998-04-05")}))


@query("ti_cut_month_distinct", sql=_CUT_SQL.format(a="count(DISTINCT k)", cols="cur, mtd, ytd, py"))
def q_ti_cut_month_distinct(spark, sf):
    """Active customers under the same filter."""
    return with_time(sales_model(spark, sf), "active_customers", ["Current", "MTD", "YTD", "PY"], "month",
                     filters={"date.date": ("between", "1997-12-20", "1998-04-05")})


_BRIDGED_SQL = f"""f AS (SELECT DISTINCT {{g}} AS g, CAST(o_orderdate AS DATE) AS d, o_custkey AS k FROM {F_} x
         LEFT JOIN customer c ON x.o_custkey = c.c_custkey),
e AS (SELECT user_id AS k, sum(value) AS s, count(value) AS n, count(*) AS rows FROM events GROUP BY user_id)"""


@query("ti_ytd_avg_review_bridged", sql=f"""
WITH {_BRIDGED_SQL.replace('{g}', 'c.c_mktsegment')},
p AS (SELECT DISTINCT g, year(d) AS y, month(d) AS m, k FROM f),
ms AS (SELECT y, m FROM (SELECT DISTINCT y FROM p) a, range(1, 13) r(m)), gs AS (SELECT DISTINCT g FROM p),
upto AS (SELECT DISTINCT gs.g, ms.y, ms.m, p.k FROM gs, ms JOIN p ON p.y = ms.y AND p.m <= ms.m WHERE p.g IS NOT DISTINCT FROM gs.g),
ytd AS (SELECT g, y, m, sum(s) / sum(n) AS v FROM upto JOIN e USING (k) GROUP BY g, y, m),
cur AS (SELECT g, y, m, sum(s) / sum(n) AS v FROM p JOIN e USING (k) GROUP BY g, y, m)
SELECT ytd.g AS c_mktsegment, CAST(ytd.y AS INTEGER) AS year, CAST(ytd.m AS INTEGER) AS month, round(cur.v, 4) AS cur,
       round(ytd.v, 4) AS ytd
FROM ytd LEFT JOIN cur ON cur.g IS NOT DISTINCT FROM ytd.g AND cur.y = ytd.y AND cur.m = ytd.m
WHERE cur.v IS NOT NULL OR ytd.v IS NOT NULL""")
def q_ti_ytd_avg_review_bridged(spark, sf):
    """Average review by the order months of the reviewing customers, in the month and in the year
    so far (each customer's reviews once a year), by segment."""
    return rounded(with_time(sales_model(spark, sf), "average_review", ["Current", "YTD"], "month",
                             ["customer.c_mktsegment"]), 4)


@query("ti_mtd_reviews_bridged", sql=f"""
WITH {_BRIDGED_SQL.replace('{g}', '1')},
b AS (SELECT min(year(d)) AS y0, max(year(d)) AS y1 FROM f),
days AS (SELECT CAST(unnest(generate_series(make_date(y0, 1, 1), make_date(y1, 12, 31), INTERVAL 1 DAY)) AS DATE) AS d FROM b),
upto AS (SELECT DISTINCT days.d, f.k FROM days JOIN f ON f.d <= days.d AND f.d >= date_trunc('month', days.d)),
mtd AS (SELECT d, sum(rows) AS v FROM upto JOIN e USING (k) GROUP BY d),
cur AS (SELECT d, sum(rows) AS v FROM f JOIN e USING (k) GROUP BY d)
SELECT mtd.d AS date, CAST(cur.v AS BIGINT) AS cur, CAST(mtd.v AS BIGINT) AS mtd FROM mtd LEFT JOIN cur ON cur.d = mtd.d""")
def q_ti_mtd_reviews_bridged(spark, sf):
    """Reviews of the customers who ordered on a day, and in the month so far (each customer once)."""
    return with_time(sales_model(spark, sf), "total_reviews", ["Current", "MTD"], "day")


@query("evaluate_unrelated_group", sql=f"""
WITH r AS (SELECT avg(value) AS average_review, count(*) AS total_reviews FROM events
            WHERE user_id IN (SELECT o_custkey FROM {F_} x JOIN part ON l_partkey = p_partkey WHERE p_type = 'ECONOMY'))
SELECT event_type AS payment_type, round(average_review, 4) AS average_review, total_reviews
FROM r, (SELECT DISTINCT event_type FROM events) t""")
def q_evaluate_unrelated_group(spark, sf):
    """A group column that does not filter the measure: the total repeats for each of its values."""
    m = sales_model(spark, sf)
    m = m.without("R7")
    return rounded(m.evaluate(["average_review", "total_reviews"], ["payments.payment_type"], {"part.p_type": "ECONOMY"}), 4)


@query("evaluate_two_bridges", sql=f"""
WITH c AS (SELECT c_custkey, n_name AS cn, r_name AS cr FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
s AS (SELECT s_suppkey, n_name AS sn, r_name AS sr FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
SELECT cr AS r_name, sn AS n_name, round(sum(l_extendedprice), 2) AS total_sales, count(*) AS total_orders,
       count(DISTINCT o_custkey) AS active_customers
FROM {F_} f JOIN c ON f.o_custkey = c.c_custkey JOIN s ON f.l_suppkey = s.s_suppkey GROUP BY 1, 2""")
def q_evaluate_two_bridges(spark, sf):
    """Sales by customer region and supplier nation, each reached over its own bridge."""
    return rounded(sales_model(spark, sf).evaluate(["total_sales", "total_orders", "active_customers"],
                                                   ["geo_customers.r_name", "geo_sellers.n_name"]))


@query("text_profile_blank_lang", sql="""
WITH d AS (SELECT nullif(lang, 'fr') AS lang, length(text) AS n FROM documents WHERE text IS NOT NULL)
SELECT lang, count(*) AS n, round(avg(n), 4) AS mean, round(stddev_samp(n), 4) AS stddev, min(n) AS min,
       quantile_disc(n, 0.25) AS q1, quantile_disc(n, 0.5) AS median, quantile_disc(n, 0.75) AS q3, max(n) AS max
FROM d GROUP BY lang""")
def q_text_profile_blank_lang(spark, sf):
    """Length profile where one language is unknown: its texts form a group with a null label."""
    d = load(spark, sf, "documents").withColumn("lang", F.when(F.col("lang") != "fr", F.col("lang")))
    p = rounded(length_profile(d, "text", ["lang"]), 4)
    return p.select("lang", *[F.col(c) if c in ("mean", "stddev") else F.col(c).cast("bigint").alias(c)
                              for c in p.columns if c != "lang"])
