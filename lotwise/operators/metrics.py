"""Analysis of long metric tables: ratios, growth, pivots, labels."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotwise.functions.scalars import rate


def union_tagged(tables: Mapping[str, DataFrame], tag: str = "engine") -> DataFrame:
    """Stack tables, each row tagged with the name of its table; absent columns are null."""
    tagged = [df.withColumn(tag, F.lit(name)) for name, df in tables.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def coalesce_scaled(a: Column, b: Column, scale: float = 100.0) -> Column:
    """One measure from two alternative columns, scaled."""
    return F.coalesce(a, b) * scale


def map_labels(col: Column, labels: Mapping[str, str]) -> Column:
    """Display label of a code; unknown codes give null."""
    pairs = [F.lit(x) for item in labels.items() for x in item]
    return F.try_element_at(F.create_map(*pairs), col)


def normalize_names(col: Column, remove: Sequence[str] = ("_spark", "_sparksql", "sql")) -> Column:
    """Delete each of the substrings in turn."""
    return reduce(lambda c, part: F.replace(c, F.lit(part), F.lit("")), remove, col)


def throughput(df: DataFrame, records: str, megabytes: str, seconds: str) -> DataFrame:
    """Add records and megabytes per second; 0 where no time passed."""
    return df.withColumns(
        {
            "records_per_sec": rate(F.col(records), F.col(seconds)),
            "mb_per_sec": rate(F.col(megabytes), F.col(seconds)),
        }
    )


def _per_size(df: DataFrame, keys: Sequence[str], dim: str, value: str) -> DataFrame:
    """Least value per group and size; a hash aggregate that leaves few rows."""
    known = df.where(F.col(value).isNotNull() & F.col(dim).isNotNull())
    return known.groupBy(*keys, dim).agg(F.min(value).alias(value))


def _with_first(df: DataFrame, keys: Sequence[str], order: str, value: str) -> DataFrame:
    """Add the smallest ``order`` of the group and the value there.

    An aggregate joined back, not a window: it combines before the shuffle, and the
    join can split a hot group while a window would sort it in one task.
    """
    first = _per_size(df, keys, order, value).groupBy(*keys).agg(F.min(F.struct(order, value)).alias("_first"))
    return (
        df.join(first, list(keys))
        .withColumns({"first_order": F.col(f"_first.{order}"), "first_value": F.col(f"_first.{value}")})
        .drop("_first")
    )


def ratio_to_first(df: DataFrame, keys: Sequence[str], order: str, value: str) -> DataFrame:
    """Speedup against the smallest size: ideal = size ratio, actual = time there / time."""
    return _with_first(df, keys, order, value).select(
        *df.columns,
        (F.col(order) / F.col("first_order")).alias("ideal_speedup"),
        F.try_divide("first_value", value).alias("actual_speedup"),
    )


def ratio_to_baseline(
    df: DataFrame, keys: Sequence[str], dim: str, base: float, value: str
) -> DataFrame:
    """Speedup, ideal speedup and efficiency against the rows with ``dim = base``.

    Groups without a baseline are dropped.
    """
    at_base = df.where((F.col(dim) == base) & F.col(value).isNotNull())
    baseline = at_base.groupBy(*keys).agg(F.min(value).alias("_base"))
    speedup = F.try_divide("_base", value)
    ideal = F.col(dim) / F.lit(float(base))
    return df.join(baseline, list(keys)).select(
        *df.columns,
        speedup.alias("speedup"),
        ideal.alias("ideal_speedup"),
        (speedup / ideal * 100).alias("efficiency_pct"),
    )


def growth(df: DataFrame, keys: Sequence[str], dim: str, value: str) -> DataFrame:
    """Growth of data and of time against the smallest size, and their quotient."""
    data = F.col(dim) / F.col("first_order")
    time = F.try_divide(value, "first_value")
    return _with_first(df, keys, dim, value).select(
        *df.columns,
        data.alias("dataset_growth"),
        time.alias("time_growth"),
        (time / data).alias("scaling_factor"),
    )


def scaling_verdict(
    df: DataFrame, keys: Sequence[str], dim: str, value: str, three_way: bool = True
) -> DataFrame:
    """Per group: largest against smallest size, and how time grew with it.

    Groups with a single size are dropped. Without ``three_way`` equal growth counts
    as super-linear.
    """
    ends = _per_size(df, keys, dim, value).groupBy(*keys).agg(
        F.min(F.struct(dim, value)).alias("small"), F.max(F.struct(dim, value)).alias("large")
    )
    ratios = ends.where(F.col(f"large.{dim}") > F.col(f"small.{dim}")).select(
        *keys,
        (F.col(f"large.{dim}") / F.col(f"small.{dim}")).alias("size_ratio"),
        F.try_divide(F.col(f"large.{value}"), F.col(f"small.{value}")).alias("time_ratio"),
    )
    verdict = F.when(F.col("time_ratio") < F.col("size_ratio"), "SUB-linear").when(
        (F.col("time_ratio") > F.col("size_ratio")) | F.lit(not three_way), "SUPER-linear"
    )
    return ratios.withColumn("verdict", verdict.otherwise("linear"))


def pivot_mean(
    df: DataFrame,
    rows: Sequence[str],
    col: str,
    values: str | Sequence[str],
    categories: Sequence,
    prefix: str = "",
    zero: bool = False,
) -> DataFrame:
    """Mean per row group, one column per category; absent cells null, or 0 with ``zero``.

    Several ``values`` give one column ``<category>_<value>`` each. The categories are
    named by the caller, so no extra pass looks for them.
    """
    values = [values] if isinstance(values, str) else list(values)
    means = [F.avg(v).alias(v) for v in values]
    wide = df.groupBy(*rows).pivot(col, list(categories)).agg(*means)
    cells = [str(c) if len(values) == 1 else f"{c}_{v}" for c in categories for v in values]
    named = wide.withColumnsRenamed({cell: f"{prefix}{cell}" for cell in cells})
    return named.fillna(0, subset=[f"{prefix}{cell}" for cell in cells]) if zero else named
