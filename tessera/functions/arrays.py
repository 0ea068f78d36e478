"""Array / struct helpers for nested service responses and chat messages."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def first_translation(response: Column | str, field: str = "text") -> Column:
    """`response` is an array of results, each holding an array of translations (structs
    with `field`): flatten the arrays, project `field` through them and take the first
    (NULL when there is none)."""
    r = F.col(response) if isinstance(response, str) else response
    texts = F.flatten(F.transform(r, lambda x: x["translations"]))
    return F.try_element_at(F.transform(texts, lambda t: t[field]), F.lit(1))


def non_empty(arr: Column | str) -> Column:
    """True for an array with elements; false for an empty or NULL one."""
    a = F.col(arr) if isinstance(arr, str) else arr
    return F.coalesce(F.size(a) > 0, F.lit(False))
