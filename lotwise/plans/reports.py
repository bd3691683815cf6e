"""The two flagship reports, from typed listings to report lines."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotwise.functions.scalars import (
    BAND_CUTS,
    days_or_default,
    first_nonblank,
    norm_key,
    num,
    price_band,
    whole,
)
from lotwise.functions.words import STOP_WORDS
from lotwise.operators.bands import band_profile, city_year_report, complete_bands, valid_market
from lotwise.operators.models import (
    capped_set,
    group_profile,
    make_report,
    make_rollup,
    valid_listings,
    with_cities,
)
from lotwise.schema import MARKET_REPORT_COLUMNS, PRICE_REPORT_COLUMNS, project


def typed_price_listings(raw: DataFrame, with_city: bool = False) -> DataFrame:
    """Text columns to the types of the price report."""
    names = PRICE_REPORT_COLUMNS + (["city"] if with_city else [])
    typed = project(raw, names).withColumns(
        {
            "make_name": norm_key(F.col("make_name")),
            "model_name": norm_key(F.col("model_name")),
            "price": num(F.col("price")),
            "year": whole(F.col("year")),
        }
    )
    return typed.withColumn("city", norm_key(F.col("city"))) if with_city else typed


def typed_market_listings(raw: DataFrame, days_default: int | None = None) -> DataFrame:
    """Text columns to the types of the market report, with one text column."""
    return project(raw, MARKET_REPORT_COLUMNS).select(
        norm_key(F.col("city")).alias("city"),
        whole(F.col("year")).alias("year"),
        num(F.col("price")).alias("price"),
        days_or_default(F.col("daysonmarket"), days_default).alias("daysonmarket"),
        first_nonblank(F.col("description_cleaned"), F.col("description")).alias("text"),
    )


def price_report(listings: DataFrame, cities: bool = False) -> DataFrame:
    """Rows (make_name, line) from typed listings; ``cities`` adds them, models by count."""
    valid = valid_listings(listings)
    stats = group_profile(valid)
    if cities:
        stats = with_cities(stats, capped_set(valid))
    return make_report(make_rollup(stats, by_count=cities), with_city_list=cities)


def market_profile(
    listings: DataFrame,
    cuts: tuple[float, ...] = BAND_CUTS,
    closed: str = "right",
    k: int = 3,
    stop: Iterable[str] = STOP_WORDS,
    **tokenizing,
) -> DataFrame:
    """Per (city, year): all bands with count, mean days and top words.

    ``punct`` and ``min_len`` are passed on to the tokenizer.
    """
    banded = valid_market(listings).withColumn("band", price_band(F.col("price"), cuts, closed=closed))
    return complete_bands(band_profile(banded, k=k, stop=stop, **tokenizing))


def market_report(listings: DataFrame, **options) -> DataFrame:
    """Rows (city, year, line) from typed listings."""
    return city_year_report(market_profile(listings, **options))
