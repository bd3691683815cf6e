"""Totals over several groupings of the same dimensions at once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def subtotals(
    df: DataFrame, dims: Sequence[str], value: str, distinct: str, cube: bool = False
) -> DataFrame:
    """Rows, sum, mean, least and greatest ``value`` and distinct ``distinct`` per subtotal.

    A rollup has the groups of all dimensions, of all but the last, and so on to the grand
    total; a cube has those of every subset. ``level`` tells them apart, a bit for each
    dimension that is summed over, so a null dimension is no subtotal. Rows are summed by all
    dimensions and ``distinct`` once; only those sums are repeated for each grouping, and
    their distinct values counted, so the table is read once and a hot group is
    combined before the shuffle. Nulls of ``distinct`` and ``value`` are not counted.
    """
    fine = df.groupBy(*dims, distinct).agg(
        F.count(F.lit(1)).alias("_rows"),
        F.count(value).alias("_values"),
        F.sum(value).alias("_sum"),
        F.min(value).alias("_min"),
        F.max(value).alias("_max"),
    )
    grouped = fine.cube(*dims) if cube else fine.rollup(*dims)
    return grouped.agg(
        F.grouping_id().cast("int").alias("level"),
        F.sum("_rows").alias("n"),
        F.sum("_sum").alias("total"),
        (F.sum("_sum") / F.sum("_values")).alias("mean"),
        F.min("_min").alias("low"),
        F.max("_max").alias("high"),
        F.count_distinct(distinct).alias("n_distinct"),
    )
