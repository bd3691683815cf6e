"""Column sets of the listing tables and schema checks."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Columns of the cleaned table in file order, without the flags.
CLEANED_DATA_COLUMNS = (
    "vin back_legroom body_type city city_fuel_economy daysonmarket dealer_zip description "
    "engine_cylinders engine_displacement engine_type exterior_color fleet frame_damaged "
    "franchise_dealer franchise_make front_legroom fuel_tank_volume fuel_type has_accidents "
    "height highway_fuel_economy horsepower interior_color isCab is_new latitude length "
    "listed_date listing_color listing_id longitude main_picture_url major_options make_name "
    "maximum_seating mileage model_name owner_count power price salvage savings_amount "
    "seller_rating sp_id sp_name theft_title torque transmission transmission_display trimId "
    "trim_name wheel_system wheel_system_display wheelbase width year major_options_list "
    "num_major_options horsepower_extracted horsepower_rpm torque_value torque_rpm seats "
    "cylinders listed_year listed_month listed_day listed_dayofweek description_cleaned"
).split()

# Columns that carry a <name>_missing flag, in file order.
FLAGGED_COLUMNS = (
    "back_legroom city_fuel_economy engine_displacement front_legroom fuel_tank_volume height "
    "highway_fuel_economy horsepower length mileage owner_count seller_rating sp_id wheelbase "
    "width horsepower_extracted horsepower_rpm torque_value torque_rpm seats cylinders "
    "body_type description engine_cylinders engine_type exterior_color franchise_make fuel_type "
    "interior_color main_picture_url major_options maximum_seating power torque transmission "
    "transmission_display trimId trim_name wheel_system wheel_system_display description_cleaned"
).split()

CLEANED_COLUMNS = (
    CLEANED_DATA_COLUMNS + [f"{name}_missing" for name in FLAGGED_COLUMNS] + ["unified_color"]
)

FILTERED_SCHEMA = T.StructType(
    [
        T.StructField("city", T.StringType()),
        T.StructField("daysonmarket", T.IntegerType()),
        T.StructField("description", T.StringType()),
        T.StructField("make_name", T.StringType()),
        T.StructField("model_name", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("description_cleaned", T.StringType()),
    ]
)

PRICE_REPORT_COLUMNS = ["make_name", "model_name", "price", "year"]
MARKET_REPORT_COLUMNS = ["city", "year", "price", "daysonmarket", "description", "description_cleaned"]


def text_schema(columns: Iterable[str]) -> T.StructType:
    """All-string schema for reading raw CSV without inference."""
    return T.StructType([T.StructField(name, T.StringType()) for name in columns])


def require_columns(df: DataFrame, columns: Iterable[str], on_missing: str = "error") -> list[str]:
    """Names from ``columns`` that ``df`` has; absent ones raise unless ``on_missing='ignore'``.

    Runs on the schema alone, before any job starts.
    """
    if on_missing not in ("error", "ignore"):
        raise ValueError(f"on_missing must be 'error' or 'ignore', not {on_missing!r}")
    wanted = list(dict.fromkeys(columns))
    have = set(df.columns)
    absent = [name for name in wanted if name not in have]
    if absent and on_missing == "error":
        raise ValueError(f"missing columns: {', '.join(absent)}")
    return [name for name in wanted if name in have]


def project(df: DataFrame, columns: Iterable[str], on_missing: str = "error") -> DataFrame:
    """Keep ``columns`` only; the scan below reads nothing else."""
    return df.select(*require_columns(df, columns, on_missing))
