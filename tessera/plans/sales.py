"""The sales model bound to the driver's star schema.

| model table      | driver tables                                                   |
|------------------|-----------------------------------------------------------------|
| orders (item grain) | orders ⋈ lineitem on the order key; price = l_extendedprice, |
|                  | approval/purchase = o_orderdate, delivered = l_shipdate          |
| customer, supplier, part | as is (part.p_type = category)                          |
| reviews          | events: user_id ↔ o_custkey, review_score = value,               |
|                  | defect_score = 1 for 'error' events else 0                       |
| payments         | events: payment_type = event_type, payment_value = value         |
| geo_customers / geo_sellers | nation ⋈ region                                       |
| date             | the calendar over the order years (derived from the data)        |
| sales_forecast   | output of the forecasting job (optional)                         |
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.dates import boundary_diff, date_key
from tessera.operators.calendar import CalendarConfig, calendar, year_bounds
from tessera.plans.model import Measure, Model, Relationship
from tessera.session import materialize
from tessera.sources.tables import load

# Date dimensions already materialised, keyed by (Spark application, checkpoint folder, data
# folder, config): a new or restarted session never sees another application's tables.
# `refresh_dates` forgets them.
_DATE_TABLES: dict = {}

# The model's relationships and measures.
RELATIONSHIPS = [
    Relationship("R1", "customer", "c_nationkey", "geo_customers", "n_nationkey", "many:many"),
    Relationship("R2", "orders", "o_custkey", "customer", "c_custkey", "many:1", both=True),
    Relationship("R3", "orders", "date_key", "date", "date_key", "many:1"),
    Relationship("R4", "orders", "l_suppkey", "supplier", "s_suppkey", "many:1"),
    Relationship("R5", "orders", "l_partkey", "part", "p_partkey", "many:1"),
    Relationship("R6", "orders", "o_custkey", "reviews", "user_id", "many:many"),
    Relationship("R7", "orders", "o_custkey", "payments", "user_id", "many:many"),
    Relationship("R8", "supplier", "s_nationkey", "geo_sellers", "n_nationkey", "many:many"),
    Relationship("R9", "orders", "o_custkey", "leads", "c_custkey", "many:many"),
    Relationship("R10", "sales_forecast", "date_key", "date", "date_key", "many:1"),
]
MEASURES = [
    Measure("total_sales", "orders", "sum", "l_extendedprice", format='"R$" #,0'),
    Measure("total_orders", "orders", "count", format="0"),
    Measure("average_review", "reviews", "avg", "review_score", crossfilter_both=("R6",)),
    Measure("total_reviews", "reviews", "count", crossfilter_both=("R6",), format="0"),
    Measure("active_customers", "orders", "distinct", "o_custkey", format="0"),
    Measure("avg_delivery_hours", "orders", "avg", "delivery_hours"),
    Measure("total_sales_forecast", "sales_forecast", "sum", "predicted_sales", format='"R$"#,0.00'),
    Measure("avg_defect_ratio", "reviews", "avg", "defect_score", crossfilter_both=("R6",)),
]
SUMMARIZE_BY = {"orders.l_extendedprice": "sum", "orders.l_tax": "sum", "orders.l_quantity": "sum",
                "payments.payment_value": "sum", "orders.l_linenumber": "none"}
HIERARCHIES = {"part.segment": ["p_type", "p_brand"]}
SORT_BY = {"date.month": "month_number", "date.month_year": "year_month_number", "date.quarter": "quarter_number",
           "date.quarter_year": "year_quarter_number", "date.week_day": "week_day_number", "date.week": "week_number",
           "date.week_year": "week_year_order"}
DATE_COLUMNS = {"orders": "o_orderdate", "reviews": "ts", "payments": "ts", "sales_forecast": "date"}


def orders_fact(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """Item-grain fact: inner join of orders and their line items, plus the
    calculated date key (of the approval/order date) and the number of hour
    boundaries between ordering and delivery."""
    f = orders.join(lineitem, orders["o_orderkey"] == lineitem["l_orderkey"], "inner")
    return f.withColumns({
        "date_key": date_key("o_orderdate"),
        "order_date": F.to_date("o_orderdate"),
        "delivery_hours": boundary_diff("HOUR", "o_orderdate", "l_shipdate"),
    })


def reviews_table(events: DataFrame) -> DataFrame:
    return events.withColumns({
        "review_score": F.col("value"),
        "defect_score": (F.col("event_type") == "error").cast("double"),
    })


def payments_table(events: DataFrame) -> DataFrame:
    return events.select("event_id", "user_id", F.col("event_type").alias("payment_type"),
                         F.col("value").alias("payment_value"), "ts")


def geo_table(nation: DataFrame, region: DataFrame) -> DataFrame:
    return nation.join(region, nation["n_regionkey"] == region["r_regionkey"]).select("n_nationkey", "n_name", "r_name")


def refresh_dates() -> None:
    """Forget the Date tables built so far, after the orders have changed."""
    _DATE_TABLES.clear()


def sales_model(spark: SparkSession, sf_dir: str, cfg: CalendarConfig | None = None,
                forecast: DataFrame | None = None) -> Model:
    t = lambda n: load(spark, sf_dir, n)

    wider: list[DataFrame] = []  # the Date table that covers the forecast too, once built

    def date_dim() -> DataFrame:
        """The Date dimension is a calculated table: built once from the order years and
        materialised (checkpointed), as a model refresh would import it."""
        bounds = year_bounds(t("orders"), "o_orderdate")
        if wider:
            return wider[0]
        if forecast is not None:  # the years of the second fact too; `today` stays that of the orders
            more = year_bounds(forecast, "date").select("first_year", "last_year", F.lit(None).cast("date").alias("today"))
            bounds = bounds.unionByName(more).agg(F.min("first_year").alias("first_year"),
                                                  F.max("last_year").alias("last_year"), F.max("today").alias("today"))
            wider.append(materialize(calendar(spark, bounds, cfg)))
            return wider[0]
        key = (spark.sparkContext.applicationId, spark.conf.get("spark.checkpoint.dir", ""), sf_dir, repr(cfg))
        if key not in _DATE_TABLES:
            _DATE_TABLES[key] = materialize(calendar(spark, bounds, cfg))
        return _DATE_TABLES[key]

    def leads() -> DataFrame:
        return t("customer").select("c_custkey", "c_mktsegment")

    tables = {
        "orders": lambda: orders_fact(t("orders"), t("lineitem")),
        "customer": lambda: t("customer"),
        "supplier": lambda: t("supplier"),
        "part": lambda: t("part"),
        "reviews": lambda: reviews_table(t("events")),
        "payments": lambda: payments_table(t("events")),
        "geo_customers": lambda: geo_table(t("nation"), t("region")),
        "geo_sellers": lambda: geo_table(t("nation"), t("region")),
        "leads": leads,
        "date": date_dim,
    }
    if forecast is not None:
        tables["sales_forecast"] = lambda: forecast
    return Model(tables, RELATIONSHIPS, {m.name: m for m in MEASURES}, SUMMARIZE_BY, HIERARCHIES,
                 DATE_COLUMNS, SORT_BY)
