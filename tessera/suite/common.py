"""Shared helpers for registered queries and their SQL oracles."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# SQL fragment: the item-grain sales fact, as the oracle writes it.
FACT_SQL = """(SELECT o.*, l.*, CAST(o.o_orderdate AS DATE) AS order_date,
        CAST(year(o.o_orderdate) * 10000 + month(o.o_orderdate) * 100 + day(o.o_orderdate) AS INTEGER) AS date_key,
        date_diff('hour', o.o_orderdate, l.l_shipdate) AS delivery_hours
   FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey)"""


def rounded(df: DataFrame, digits: int = 2, only: list[str] | None = None) -> DataFrame:
    """Round every double/float column (sum order varies between engines)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)) and (only is None or f.name in only):
            cols.append(F.round(F.col(f.name), digits).alias(f.name))
        else:
            cols.append(F.col(f"`{f.name}`"))
    return df.select(*cols)
