"""Raw listings to the cleaned table."""

from __future__ import annotations

import fnmatch
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotwise.functions.scalars import (
    first_number,
    norm_key,
    num,
    parse_list,
    rpm,
    strip_tags,
    strip_unit,
    to_bool,
    to_date_lenient,
    whole,
)
from lotwise.operators.cleaning import (
    date_parts,
    dedupe_latest,
    drop_sparse,
    fill_like,
    fill_when,
    flag_missing,
    impute_median,
    impute_mode,
    lacks_text,
    unify_columns,
)
from lotwise.operators.profiling import is_missing, numeric_columns, text_columns
from lotwise.schema import CLEANED_COLUMNS
from lotwise.session import materialize

# Raw columns by the way they are typed.
INCH_COLUMNS = "back_legroom front_legroom height length wheelbase width".split()
GALLON_COLUMNS = ["fuel_tank_volume"]
BOOLEAN_COLUMNS = (
    "fleet frame_damaged franchise_dealer has_accidents isCab is_certified is_cpo is_new is_oemcpo "
    "salvage theft_title"
).split()
NUMBER_COLUMNS = (
    "city_fuel_economy engine_displacement highway_fuel_economy horsepower latitude longitude mileage "
    "owner_count price savings_amount seller_rating"
).split()
INTEGER_COLUMNS = ["daysonmarket", "year"]


@dataclass(frozen=True)
class CleanConfig:
    """What to clean and how; columns the table lacks are skipped."""

    sparse_threshold: float = 0.7
    key: str = "vin"
    tie: tuple[str, ...] = ("listing_id",)
    never_median: tuple[str, ...] = ("price", "vin", "listing_id", "sp_id")
    never_mode: tuple[str, ...] = (
        "vin", "listing_id", "sp_id", "description", "description_cleaned", "main_picture_url"
    )
    never_flag: tuple[str, ...] = ("price", "vin", "listing_id")
    keys_to_normalize: tuple[str, ...] = ("make_name", "model_name", "city")
    color_pattern: str = "*color*"
    impute: bool = True
    impute_first: bool = False
    median_accuracy: int | None = None
    inch: tuple[str, ...] = field(default=tuple(INCH_COLUMNS))
    gallon: tuple[str, ...] = field(default=tuple(GALLON_COLUMNS))
    boolean: tuple[str, ...] = field(default=tuple(BOOLEAN_COLUMNS))
    number: tuple[str, ...] = field(default=tuple(NUMBER_COLUMNS))
    integer: tuple[str, ...] = field(default=tuple(INTEGER_COLUMNS))


def typed_listings(raw: DataFrame, config: CleanConfig = CleanConfig()) -> DataFrame:
    """Type, extract and derive columns: one projection over the raw table."""
    have = set(raw.columns)
    out = {}
    for names, convert in (
        (config.inch, lambda c: strip_unit(c, " in")),
        (config.gallon, lambda c: strip_unit(c, " gal")),
        (config.boolean, to_bool),
        (config.number, num),
        (config.integer, whole),
        (config.keys_to_normalize, norm_key),
    ):
        out.update({n: convert(F.col(n).cast("string")) for n in names if n in have})
    if "major_options" in have:
        options = parse_list(F.col("major_options"))
        out |= {"major_options_list": options, "num_major_options": F.size(options)}
    if "power" in have:
        out |= {"horsepower_extracted": first_number(F.col("power")), "horsepower_rpm": rpm(F.col("power"))}
    if "torque" in have:
        out |= {"torque_value": first_number(F.col("torque")), "torque_rpm": rpm(F.col("torque"))}
    if "maximum_seating" in have:
        out["seats"] = first_number(F.col("maximum_seating"), "int")
    if "engine_cylinders" in have:
        out["cylinders"] = first_number(F.col("engine_cylinders"), "int")
    if "description" in have:
        out["description_cleaned"] = strip_tags(F.col("description"))
    if "listed_date" in have:
        out["listed_date"] = to_date_lenient(F.col("listed_date"))
    typed = raw.withColumns(out)
    return date_parts(typed, "listed_date", "listed") if "listed_date" in have else typed


def consistent_listings(df: DataFrame, config: CleanConfig = CleanConfig()) -> DataFrame:
    """One row per key, and columns that contradict each other repaired."""
    have = set(df.columns)
    if {config.key, "listed_date"} <= have:
        df = dedupe_latest(df, config.key, "listed_date", [c for c in config.tie if c in have])
    if {"franchise_dealer", "franchise_make", "make_name"} <= have:
        wrong = F.col("franchise_dealer") & lacks_text(F.col("franchise_make"))
        df = fill_when(df, wrong, "franchise_make", F.col("make_name"))
    if {"listing_color", "exterior_color"} <= have:
        df = unify_columns(df, "unified_color", "listing_color", "exterior_color")
    return df


def columns_with_gaps(df: DataFrame, names: list[str]) -> list[str]:
    """Those of ``names`` that have a null, NaN or empty value anywhere; one aggregate."""
    if not names:
        return []
    texts = set(text_columns(df))

    def gap(name: str):
        missing = is_missing(df, name)
        return missing | (F.col(name) == "") if name in texts else missing

    found = [F.when(F.count_if(gap(n)) > 0, F.lit(n)) for n in names]
    return list(df.agg(F.array_compact(F.array(*found)).alias("names")).first()["names"])


def in_file_order(df: DataFrame) -> DataFrame:
    """Columns of the cleaned table in its order, then any others."""
    known = [c for c in CLEANED_COLUMNS if c in df.columns]
    return df.select(*known, *[c for c in df.columns if c not in set(known)])


def clean_listings(
    raw: DataFrame, config: CleanConfig = CleanConfig(), folder: str | None = None
) -> DataFrame:
    """Drop sparse columns, type, de-duplicate, repair, then flag and fill the gaps.

    With ``impute_first`` gaps are filled before duplicates go and columns are repaired.
    The table before imputation is written to the shared folder once: the statistics
    passes read single columns of it instead of repeating the de-duplication. Every column
    with a gap gets a flag, whether it is filled or not, except those of ``never_flag``.
    """
    kept = drop_sparse(raw, config.sparse_threshold)
    typed = typed_listings(kept, config)
    if not config.impute:
        return in_file_order(consistent_listings(typed, config))
    if config.impute_first:
        return in_file_order(consistent_listings(without_gaps(typed, config, folder), config))
    return in_file_order(without_gaps(consistent_listings(typed, config), config, folder))


def without_gaps(typed: DataFrame, config: CleanConfig, folder: str | None) -> DataFrame:
    """Flag every column with gaps and fill those that the configuration fills."""
    table = materialize(typed, "listings", folder)
    gaps = columns_with_gaps(table, numeric_columns(table) + text_columns(table))
    numbers = [c for c in numeric_columns(table) if c in gaps]
    texts = [c for c in text_columns(table) if c in gaps]
    flags = [[c for c in names if c not in config.never_flag] for names in (numbers, texts)]
    flagged = flag_missing(flag_missing(table, flags[0]), flags[1], blank=True)
    medians = [c for c in numbers if c not in config.never_median]
    colors = [c for c in texts if fnmatch.fnmatchcase(c, config.color_pattern)]
    modes = [c for c in texts if c not in config.never_mode and c not in colors]
    filled = impute_median(flagged, medians, exclude=(), accuracy=config.median_accuracy)
    return fill_like(impute_mode(filled, modes), config.color_pattern)
