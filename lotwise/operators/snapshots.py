"""Differences between two states of a table, with repeated rows counted.

Rows are equal if all their columns are; nulls equal nulls and NaN equals NaN. Both states are
grouped together in one shuffle that counts equal rows before it, so copies cost nothing and
no group of equal rows is held anywhere. Columns of a map type can't be compared.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def row_counts(old: DataFrame, new: DataFrame) -> DataFrame:
    """Each different row with how often either state has it: ``n_old`` and ``n_new``."""
    if set(old.columns) != set(new.columns):
        raise ValueError(f"columns of one state only: {sorted(set(old.columns) ^ set(new.columns))}")
    columns = [F.col(f"`{c}`") for c in old.columns]
    states = old.select(*columns, F.lit(False).alias("_new")).unionByName(
        new.select(*columns, F.lit(True).alias("_new"))
    )
    return states.groupBy(*columns).agg(
        F.count_if(~F.col("_new")).alias("n_old"), F.count_if(F.col("_new")).alias("n_new")
    )


def _repeated(counts: DataFrame, n: Column) -> DataFrame:
    columns = [F.col(f"`{c}`") for c in counts.columns if c not in ("n_old", "n_new")]
    times = F.explode(F.sequence(F.lit(1), n)).alias("_i")
    return counts.where(n > 0).select(*columns, times).drop("_i")


def bag_except(a: DataFrame, b: DataFrame) -> DataFrame:
    """The rows of ``a`` without those of ``b``: each copy in ``b`` takes one away."""
    return _repeated(row_counts(a, b), F.col("n_old") - F.col("n_new"))


def bag_intersect(a: DataFrame, b: DataFrame) -> DataFrame:
    """The rows that both have, as often as the one that has them less often."""
    return _repeated(row_counts(a, b), F.least("n_old", "n_new"))


def row_changes(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows that one state has more often: with ``change`` 'added' or 'gone' and the copies ``n``."""
    counts = row_counts(old, new).where("n_old <> n_new")
    more = F.col("n_new") > F.col("n_old")
    return counts.select(
        *[F.col(f"`{c}`") for c in old.columns],
        F.when(more, "added").otherwise("gone").alias("change"),
        F.abs(F.col("n_new") - F.col("n_old")).alias("n"),
    )


def key_changes(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys whose rows differ: 'added', 'gone' or 'changed', and the rows that came and went.

    A key whose rows only came or only went, beside others that stayed, is changed too.
    """
    counts = row_counts(old, new)
    by_key = counts.groupBy(*keys).agg(
        F.sum("n_old").alias("rows_old"),
        F.sum("n_new").alias("rows_new"),
        F.sum(F.greatest(F.col("n_old") - F.col("n_new"), F.lit(0))).alias("n_gone"),
        F.sum(F.greatest(F.col("n_new") - F.col("n_old"), F.lit(0))).alias("n_added"),
    )
    change = F.when(F.col("rows_old") == 0, "added").when(F.col("rows_new") == 0, "gone").otherwise("changed")
    return by_key.where("n_gone > 0 OR n_added > 0").select(*keys, change.alias("change"), "n_gone", "n_added")


def change_counts(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """How many keys were added, went, changed or stayed as they were."""
    counts = row_counts(old, new)
    same = F.max(F.when(F.col("n_old") != F.col("n_new"), 1).otherwise(0)) == 0
    by_key = counts.groupBy(*keys).agg(
        same.alias("same"), F.sum("n_old").alias("rows_old"), F.sum("n_new").alias("rows_new")
    )
    kind = (
        F.when(F.col("same"), "same")
        .when(F.col("rows_old") == 0, "added")
        .when(F.col("rows_new") == 0, "gone")
        .otherwise("changed")
    )
    return by_key.groupBy(kind.alias("change")).agg(F.count(F.lit(1)).alias("n_keys"))
