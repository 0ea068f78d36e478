"""Metric-layer semantics: bridged (no fan-out) averages, DISTINCTCOUNT blanks, YOY, resample."""
import datetime as dt

from pyspark.sql import functions as F

from tessera.operators.series import resample
from tessera.plans.model import Measure, Model, Relationship, distinct_count_with_blank


def _toy_model(spark):
    items = spark.createDataFrame([(1, 10), (1, 10), (1, 10), (2, 10)], "order_id long, product long")
    products = spark.createDataFrame([(10, "cat")], "product long, category string")
    reviews = spark.createDataFrame([(1, 4.0), (2, 2.0)], "order_id long, score double")
    rels = [Relationship("R5", "orders", "product", "products", "product"),
            Relationship("R6", "orders", "order_id", "reviews", "order_id", "many:many")]
    ms = {"avg_review": Measure("avg_review", "reviews", "avg", "score", crossfilter_both=("R6",)),
          "n_items": Measure("n_items", "orders", "count")}
    return Model({"orders": lambda: items, "products": lambda: products, "reviews": lambda: reviews}, rels, ms)


def test_bridged_average_no_fanout(spark):
    m = _toy_model(spark)
    r = m.evaluate(["avg_review", "n_items"], ["products.category"]).first()
    assert r.avg_review == 3.0          # a fan-out join would give 3.5
    assert r.n_items == 4


def test_distinct_count_blank(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,)], "v string")
    assert df.agg(distinct_count_with_blank(F.col("v")).alias("n")).first().n == 2


def test_distinct_drill_copies_no_pair_for_a_level(spark):
    """Distinct counts at every level, with NULL values, NULL members and one very common customer; the rows
    that Spark copies for the roll-up are members, not (member, value) pairs."""
    parts = [(0, "a", "x"), (1, "a", "y"), (2, "b", "x"), (3, "b", None), (4, None, "x")]
    items = [(i % 6, [None, 7, 7, i % 11, i % 13][i % 5]) for i in range(400)] + [(2, 7)] * 300 + [(None, 99)]
    rels = [Relationship("R5", "orders", "part", "parts", "part")]
    m = Model({"orders": lambda: spark.createDataFrame(items, "part long, customer long"),
               "parts": lambda: spark.createDataFrame(parts, "part long, kind string, brand string")}, rels,
              {"n": Measure("n", "orders", "distinct", "customer"), "rows": Measure("rows", "orders", "count")})
    known = {p: (k, b) for p, k, b in parts}
    want = {}
    for p, c in items:
        k, b = known.get(p, (None, None))
        for key in ((k, b, 0), (k, None, 1), (None, None, 3)):
            want.setdefault(key, set()).add(c)
    want = {k: len(v) for k, v in want.items()}
    out = m.drill(["n"], "parts", ["kind", "brand"])
    assert {(r.kind, r.brand, r.level): r.n for r in out.collect()} == want and out.count() == len(want)
    both = m.drill(["n", "rows"], "parts", ["kind", "brand"])
    assert {(r.kind, r.brand, r.level): r.n for r in both.collect()} == want
    assert dict(out.dtypes)["n"] == "bigint" and m.drill(["n"], "parts", ["kind", "brand"], {"orders.part": [-1]}).count() == 0
    plan = out._jdf.queryExecution().optimizedPlan().toString().splitlines()
    below = plan[next(i for i, x in enumerate(plan) if "Expand" in x) + 1:]
    assert next(x for x in below if "Aggregate" in x).count("sum(") == 3
    dealt = next(i for i, x in enumerate(below) if "RepartitionByExpression" in x)  # between the joins and the pairs
    assert "_task" in below[dealt] and not [x for x in below[:dealt] if "Join" in x] and [x for x in below[dealt:] if "Join" in x]


def test_resample_synthetic(spark):
    rows = [(dt.datetime(2017, 1, 1, 23, 50), 1.0), (dt.datetime(2017, 1, 2, 0, 10), 2.0),
            (dt.datetime(2017, 1, 5), 3.0), (dt.datetime(2017, 1, 16), 4.0), (dt.datetime(2017, 2, 3), 5.0)]
    df = spark.createDataFrame(rows, "ts timestamp, v double")
    day = resample(df, "ts", "v", "D")
    assert day.count() == 34 and day.filter("y = 0").count() == 29
    wk = {r.ds: r.y for r in resample(df, "ts", "v", "W").collect()}
    assert len(wk) == 6
    assert wk[dt.date(2017, 1, 1)] == 1 and wk[dt.date(2017, 1, 8)] == 5 and wk[dt.date(2017, 1, 15)] == 0
    assert wk[dt.date(2017, 1, 22)] == 4 and wk[dt.date(2017, 2, 5)] == 5
    mo = {r.ds: r.y for r in resample(df, "ts", "v", "M").collect()}
    assert mo == {dt.date(2017, 1, 31): 10.0, dt.date(2017, 2, 28): 5.0}
    assert sum(mo.values()) == sum(v for _, v in rows)


def test_yoy_semantics(spark):
    from tessera.operators.calendar import calendar, fixed_bounds
    from tessera.plans.timeintel import with_time
    d = dt.datetime
    sales = spark.createDataFrame([(d(2017, 1, 1), 5.0), (d(2016, 1, 2), 5.0), (d(2016, 1, 4), 0.0),
                                   (d(2017, 1, 4), 3.0)], "ts timestamp, v double")
    m = Model({"sales": lambda: sales, "date": lambda: calendar(spark, fixed_bounds(spark, 2016, 2017, "2017-01-01"))},
              [], {"s": Measure("s", "sales", "sum", "v")}, date_columns={"sales": "ts"})
    r = {x.date: x for x in with_time(m, "s", ["Current", "PY", "YOY", "YOY%"], "day").collect()}
    assert (r[dt.date(2017, 1, 1)].yoy, r[dt.date(2017, 1, 1)].yoy_pct) == (5.0, None)
    assert r[dt.date(2017, 1, 2)].yoy == -5.0
    assert dt.date(2017, 1, 3) not in r
    assert r[dt.date(2017, 1, 4)].yoy == 3.0 and r[dt.date(2017, 1, 4)].yoy_pct is None


def test_eager_aggregation_path_matches(spark):
    """With broadcasts disabled the many:1 evaluation pre-aggregates the fact per key;
    results must equal the direct join path."""
    import __spark_entry__
    from conftest import SF_SMALL
    q = __spark_entry__.queries()["sales_by_dim"]
    direct = sorted(tuple(r) for r in q(spark, SF_SMALL).collect())
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        eager = sorted(tuple(r) for r in q(spark, SF_SMALL).collect())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert eager == direct


def _scans(df, table):
    """Parquet scans of a table in the plan that ran."""
    df.write.format("noop").mode("overwrite").save()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [x for x in plan.splitlines() if "Scan parquet" in x and f"/{table}.parquet" in x]


def test_date_filters_reach_the_fact_scan(spark):
    import __spark_entry__ as E
    from conftest import SF_SMALL
    for key in ("metric_sql", "evaluate_multi"):
        lines = E.queries()[key](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString().splitlines()
        assert any("o_orderdate" in x and ">=" in x and "<" in x for x in lines), key
    scan = _scans(E.queries()["metric_sql"](spark, SF_SMALL), "orders")
    assert any("GreaterThanOrEqual(o_orderdate" in x for x in scan)


def test_fact_is_read_once_for_all_kinds_of_measures(spark):
    import __spark_entry__ as E
    from conftest import SF_SMALL
    assert len(_scans(E.queries()["sales_by_dim"](spark, SF_SMALL), "lineitem")) == 1


def test_fact_is_read_once_a_home_table(spark):
    """Measures of orders and of reviews, grouped and filtered through orders: one read for either."""
    import __spark_entry__ as E
    from conftest import SF_SMALL
    assert len(_scans(E.queries()["evaluate_multi"](spark, SF_SMALL), "lineitem")) == 2
    assert len(_scans(E.queries()["avg_review_bridged"](spark, SF_SMALL), "lineitem")) == 1


def test_groups_outside_the_calendar_have_no_spine(spark):
    from conftest import SF_SMALL
    from tessera.plans.sales import sales_model
    from tessera.plans.timeintel import with_time
    m = sales_model(spark, SF_SMALL)
    late = m.replace_table("payments", lambda: spark.createDataFrame(
        [(1, dt.datetime(2150, 5, 1))], "user_id long, ts timestamp"))
    late.measures = dict(late.measures, n=Measure("n", "payments", "count"))
    assert with_time(late, "n", ["Current", "YTD"], "month", date_column="ts").count() == 0
