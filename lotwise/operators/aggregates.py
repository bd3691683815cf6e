"""Aggregates shared by several operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def nested_in_order(columns: list[str], order: list[Column]) -> Column:
    """Rows of a group as an array of structs, sorted by ``order`` inside the aggregate."""
    keyed = F.struct(F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)]).alias("order"), *columns)
    return F.transform(
        F.array_sort(F.collect_list(keyed)),
        lambda item: F.struct(*[item[c].alias(c) for c in columns]),
    )
