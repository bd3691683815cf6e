"""Price and year statistics per make and model."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lotwise.functions.scalars import bracketed, two_decimals
from lotwise.operators.aggregates import nested_in_order

YEARS = (1900, 2025)


def valid_listings(
    df: DataFrame,
    keys: Sequence[str] = ("make_name", "model_name"),
    price: str = "price",
    year: str = "year",
    years: tuple[int, int] = YEARS,
) -> DataFrame:
    """Rows with every key present, a positive number as price and a year in range."""
    return df.where(listing_rule(keys, price, year, years))


def listing_rule(
    keys: Sequence[str] = ("make_name", "model_name"),
    price: str = "price",
    year: str = "year",
    years: tuple[int, int] = YEARS,
) -> Column:
    rule = (F.col(price) > 0) & ~F.isnan(price) & F.col(year).between(*years)
    for key in keys:
        rule = rule & F.col(key).isNotNull() & (F.col(key) != "")
    return rule


def group_profile(
    df: DataFrame,
    keys: Sequence[str] = ("make_name", "model_name"),
    value: str = "price",
    set_col: str = "year",
) -> DataFrame:
    """Per group: n, min, max and mean of ``value``, sorted distinct ``set_col``.

    Aggregates by (keys, set_col) first. That step is a plain hash aggregate whose
    partial results stay small, and it spreads a hot group over its set values; the
    second step sees one row per distinct value only.
    """
    keys = list(keys)
    fine = df.groupBy(*keys, set_col).agg(
        F.count(F.lit(1)).alias("n"),
        F.min(value).alias("low"),
        F.max(value).alias("high"),
        F.count(value).alias("with_value"),
        F.sum(value).alias("total"),
    )
    return (
        fine.groupBy(*keys)
        .agg(
            F.sum("n").alias("n"),
            F.min("low").alias(f"min_{value}"),
            F.max("high").alias(f"max_{value}"),
            F.sum("with_value").alias("with_value"),
            F.sum("total").alias("total"),
            F.sort_array(F.collect_list(set_col)).alias(f"{set_col}s"),
        )
        .select(
            *keys,
            "n",
            f"min_{value}",
            f"max_{value}",
            F.try_divide("total", "with_value").alias(f"avg_{value}"),
            f"{set_col}s",
        )
    )


def capped_set(
    df: DataFrame, keys: Sequence[str] = ("make_name", "model_name"), col: str = "city", n: int = 5
) -> DataFrame:
    """Per group: the first ``n`` distinct non-blank values of ``col`` in order.

    A group without any value has no row. Values are made distinct before they
    meet, and each task passes on no more than ``n`` of them per group.
    """
    keys = list(keys)
    distinct = df.where(F.col(col) != "").select(*keys, col).distinct()
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(col))
    first = distinct.withColumn("place", place).where(F.col("place") <= n)
    plural = f"{col[:-1]}ies" if col.endswith("y") else f"{col}s"
    return first.groupBy(*keys).agg(F.sort_array(F.collect_list(col)).alias(plural))


def nest_children(
    df: DataFrame, parent: str, children: Sequence[str], order: Sequence[Column], name: str
) -> DataFrame:
    """One row per ``parent`` with its child rows as an ordered array of structs."""
    return df.groupBy(parent).agg(
        F.count(F.lit(1)).alias(f"n_{name}"), nested_in_order(list(children), list(order)).alias(name)
    )


MODEL_FIELDS = ["model_name", "n", "min_price", "max_price", "avg_price", "years"]


def make_rollup(stats: DataFrame, by_count: bool = False) -> DataFrame:
    """Models nested per make, by name or by falling count and then name."""
    order = [F.col("model_name")]
    if by_count:
        order.insert(0, -F.col("n"))
    fields = MODEL_FIELDS + [c for c in ("cities",) if c in stats.columns]
    return nest_children(stats, "make_name", fields, order, "models")


def with_cities(stats: DataFrame, cities: DataFrame) -> DataFrame:
    """Add the city lists to model statistics; no cities gives an empty list."""
    empty = F.array().cast("array<string>")
    return stats.join(cities, ["make_name", "model_name"], "left").withColumn(
        "cities", F.coalesce("cities", empty)
    )


def model_text(model: Column, with_city_list: bool = False) -> Column:
    """One model of the make report as text."""
    pieces = [
        F.lit("Model: "), model["model_name"],
        F.lit(", Count: "), model["n"].cast("string"),
        F.lit(", MinPrice: "), two_decimals(model["min_price"]),
        F.lit(", MaxPrice: "), two_decimals(model["max_price"]),
        F.lit(", AvgPrice: "), two_decimals(model["avg_price"]),
        F.lit(", Years: "), bracketed(model["years"]),
    ]
    if with_city_list:
        pieces += [F.lit(", TopCities: "), bracketed(model["cities"], quote=True)]
    return F.concat(*pieces)


def make_report(rollup: DataFrame, with_city_list: bool = False) -> DataFrame:
    """Rows (make_name, line); write them ordered by ``make_name``."""
    models = F.transform("models", lambda model: model_text(model, with_city_list))
    line = F.concat(
        F.lit("Make: "), F.col("make_name"),
        F.lit("\tModels: ["), F.array_join(models, "; "), F.lit("]"),
    )
    return rollup.select("make_name", line.alias("line"))
