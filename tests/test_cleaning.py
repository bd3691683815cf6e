"""Cleaning a raw listing table, and single cleaning operators."""

from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from lotwise.operators import cleaning as C
from lotwise.operators import profiling as P
from lotwise.plans.clean import CleanConfig, clean_listings
from lotwise.schema import CLEANED_COLUMNS, text_schema

RAW = [
    dict(vin="A", listing_id="1", make_name=" Fiat ", price="10", year="2000", listed_date="2020-01-01",
         franchise_dealer="True", franchise_make=None, power="100 hp @ 5,000 RPM", height="50 in",
         listing_color=None, exterior_color="red", major_options="['x', 'y']", fuel_type="gas"),
    dict(vin="A", listing_id="2", make_name="Fiat", price=None, year="2001", listed_date="2020-06-01",
         franchise_dealer="True", franchise_make=None, power=None, height="--",
         listing_color="BLUE", exterior_color=None, major_options=None, fuel_type=None),
    dict(vin="B", listing_id="3", make_name="Kia", price="30", year="2003.0", listed_date="oops",
         franchise_dealer="False", franchise_make="Kia", power="200 hp", height="70 in",
         listing_color=None, exterior_color=None, major_options="bad", fuel_type="gas"),
    dict(vin="C", listing_id="4", make_name="Kia", price="40", year="2004", listed_date="2019-01-01",
         franchise_dealer=None, franchise_make="Kia", power="300 hp", height="61 in",
         listing_color="RED", exterior_color="x", major_options="[]", fuel_type="diesel"),
]


@pytest.fixture(scope="module")
def raw(spark):
    names = list(RAW[0]) + ["sparse"]
    return spark.createDataFrame([tuple(r.values()) + (None,) for r in RAW], text_schema(names))


def test_clean_listings(raw):
    rows = {r.vin: r for r in clean_listings(raw).collect()}
    assert set(rows) == {"A", "B", "C"}
    a, b, c = rows["A"], rows["B"], rows["C"]
    assert "sparse" not in a.asDict()
    # The later listing of A stays; its dealer gets the make, its gaps are flagged and filled.
    assert a.listing_id == "2" and a.listed_date == datetime.date(2020, 6, 1)
    assert a.make_name == "fiat" and a.franchise_make == "fiat"
    assert a.price is None and "price_missing" not in a.asDict()
    assert (a.height, a.height_missing, b.height_missing) == (65.5, 1, 0)
    assert (a.horsepower_extracted, a.horsepower_extracted_missing) == (250.0, 1)
    assert (a.fuel_type, a.fuel_type_missing) == ("diesel", 1)
    assert (a.unified_color, b.unified_color, c.unified_color) == ("BLUE", "Unknown", "RED")
    assert (b.listing_color, b.exterior_color) == ("Unknown", "Unknown")
    assert b.listed_date is None and b.listed_year_missing == 1
    assert (a.franchise_dealer, b.franchise_dealer, c.franchise_dealer) == (True, False, False)
    assert (a.num_major_options, b.major_options_list, c.major_options_list) == (0, [], [])


def test_columns_come_in_file_order(raw):
    names = clean_listings(raw).columns
    places = [CLEANED_COLUMNS.index(c) for c in names if c in CLEANED_COLUMNS]
    assert places == sorted(places) and len(places) > 20
    assert set(raw.columns) - {"sparse"} <= set(names)


def test_clean_without_imputation(raw):
    rows = {r.vin: r for r in clean_listings(raw, CleanConfig(impute=False)).collect()}
    assert rows["A"].height is None and rows["A"].fuel_type is None


def test_dedupe_with_hot_key(spark):
    df = spark.range(9_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"),
        F.when(F.col("id") % 2 == 0, F.col("id")).alias("d"),
        "id",
    )
    out = C.dedupe_latest(df, "k", "d", ["id"])
    assert out.count() == out.select("k").distinct().count() == 6_001
    assert out.where("k = 'hot'").first().id == 8_994


def test_mode_ties_go_to_the_smallest(spark):
    df = spark.createDataFrame([("b",), ("a",), ("",), (None,)], "x string")
    assert [r.x for r in C.impute_mode(df, ["x"]).collect()] == ["b", "a", "a", "a"]


def test_median_skips_price(spark):
    df = spark.createDataFrame([(1.0, 1.0), (3.0, None), (None, 2.0)], "x double, price double")
    assert [tuple(r) for r in C.impute_median(df, ["x", "price"]).collect()] == [
        (1.0, 1.0), (3.0, None), (2.0, 2.0),
    ]


def test_sparse_threshold_is_exclusive(spark):
    df = spark.createDataFrame([(i, 1 if i > 6 else None, 1 if i > 7 else None) for i in range(10)],
                               "id int, seventy int, eighty int")
    assert C.drop_sparse(df, 0.7).columns == ["id", "seventy"]


def test_nan_counts_as_missing(spark):
    df = spark.createDataFrame([(float("nan"), "x"), (1.0, None)], "a double, b string")
    rows = {r.column: (r.missing, r.pct) for r in P.missing_report(df).collect()}
    assert rows == {"a": (1, 50.0), "b": (1, 50.0)}


def test_unique_counts_of_an_empty_column(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "a int, b string")
    assert [tuple(r) for r in P.unique_counts(df).collect()] == [("a", 2), ("b", 0)]
    assert {r.column: r.n_unique for r in P.unique_counts(df, approx=True).collect()} == {"a": 2, "b": 0}


def test_duplicates_ignore_null_keys(spark):
    df = spark.createDataFrame([("a",), ("a",), ("a",), ("b",), (None,), (None,)], "k string")
    assert tuple(P.duplicate_report(df, "k").first()) == (1, 2)


def test_cleaned_keys_are_unique(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    out = C.dedupe_latest(orders, "o_custkey", "o_orderdate", ["o_orderkey"])
    assert out.count() == orders.select("o_custkey").distinct().count()


def test_rows_without_a_key_are_no_copies(spark):
    rows = [("a", 1), ("a", 2), (None, 1), (None, 2), ("", 1), (" ", 1)]
    df = spark.createDataFrame(rows, "vin string, day int")
    assert C.dedupe_latest(df, "vin", "day", []).count() == 5
    assert C.dedupe_latest(df, "vin", "day", [], null_key="collapse").count() == 4


def test_descriptions_are_not_made_up(spark, tmp_path):
    rows = [(str(i), None if i < 3 else "same text", "1") for i in range(9)]
    raw = spark.createDataFrame(rows, "vin string, description string, price string")
    cleaned = clean_listings(raw, folder=str(tmp_path))
    assert cleaned.where("description_cleaned = 'same text'").count() == 6
    assert cleaned.agg(F.sum("description_missing"), F.sum("description_cleaned_missing")).first() == (3, 3)
    first = clean_listings(raw, CleanConfig(impute_first=True), str(tmp_path))
    assert sorted(first.columns) == sorted(cleaned.columns) and first.count() == 9


def test_profiles_of_floats_and_gaps(spark):
    rows = [(0.0, None, "a"), (-0.0, None, "b"), (float("nan"), None, "b")]
    df = spark.createDataFrame(rows, "x double, gone string, s string")
    assert {r.column: r.n_unique for r in P.unique_counts(df).collect()} == {"x": 1, "gone": 0, "s": 2}
    texts = {r.column: tuple(r)[1:] for r in P.describe_text(df, ["gone", "s"]).collect()}
    assert texts == {"gone": (0, 0, None, 0), "s": (3, 2, "b", 2)}
