"""Both reports on a five-row sample, and their properties on the given tables."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from lotwise.operators import bands, models
from lotwise.plans.reports import (
    market_profile,
    market_report,
    price_report,
    typed_market_listings,
    typed_price_listings,
)
from lotwise.schema import FILTERED_SCHEMA, text_schema
from lotwise.sources.listings_csv import read_listings_csv
from lotwise.sources.sinks import write_report
from workload.jobs import banded_l, market_l, valid_l

SAMPLE = """city,daysonmarket,description,make_name,model_name,price,year,description_cleaned
Turin,12,blue hatchback,Fiat,Panda,19999.99,2011,blue hatchback with blue seats
Turin,18,red hatchback,Fiat,Panda,20000,2011,red roof and red seats
Turin,7,old,Fiat,Panda,4000.01,2009,
Lyon,90,estate car,Renault,Megane,50000,2017,wide estate wide boot
Lyon,30,coupe,Renault,Alpine,50000.01,2017,quick coupe
"""


@pytest.fixture(scope="module")
def sample(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("sample") / "listings.csv"
    path.write_text(SAMPLE)
    return read_listings_csv(spark, str(path), FILTERED_SCHEMA.names)


def test_price_report_of_the_sample(sample):
    rows = price_report(typed_price_listings(sample)).orderBy("make_name").collect()
    assert [r.line for r in rows] == [
        "Make: fiat\tModels: [Model: panda, Count: 3, MinPrice: 4000.01, MaxPrice: 20000.00, "
        "AvgPrice: 14666.67, Years: [2009, 2011]]",
        "Make: renault\tModels: [Model: alpine, Count: 1, MinPrice: 50000.01, MaxPrice: 50000.01, "
        "AvgPrice: 50000.01, Years: [2017]; Model: megane, Count: 1, MinPrice: 50000.00, "
        "MaxPrice: 50000.00, AvgPrice: 50000.00, Years: [2017]]",
    ]


def test_price_report_with_cities(sample):
    rows = price_report(typed_price_listings(sample, with_city=True), cities=True).collect()
    line = {r.make_name: r.line for r in rows}["fiat"]
    assert line.endswith("Years: [2009, 2011], TopCities: ['turin']]")


def test_market_profile_of_the_sample(sample):
    rows = market_profile(typed_market_listings(sample)).collect()
    filled = {
        (r.city, r.year): [(b.band, b.n, b.avg_days, b.top_words) for b in r.bands if b.n] for r in rows
    }
    assert filled == {
        ("turin", 2009): [("basso", 1, 7.0, ["old"])],
        ("turin", 2011): [
            ("basso", 1, 12.0, ["blue", "hatchback", "seats"]),
            ("medio", 1, 18.0, ["red", "roof", "seats"]),
        ],
        ("lyon", 2017): [
            ("medio", 1, 90.0, ["wide", "boot", "estate"]),
            ("alto", 1, 30.0, ["coupe", "quick"]),
        ],
    }


def test_market_profile_with_other_words(sample):
    rows = market_profile(typed_market_listings(sample), stop=[], min_len=4, k=1).collect()
    words = {(r.city, b.band): b.top_words for r in rows for b in r.bands if b.n and r.year != 2009}
    assert words[("turin", "medio")] == ["roof"]


def test_market_report_line(sample):
    lines = {(r.city, r.year): r.line for r in market_report(typed_market_listings(sample)).collect()}
    assert lines[("turin", 2009)] == (
        "City: turin, Year: 2009\tReportFasce: ["
        "FasciaPrezzo: basso, NumAuto: 1, AvgDaysOnMarket: 7.00, TopWords: ['old']; "
        "FasciaPrezzo: medio, NumAuto: 0, AvgDaysOnMarket: 0.00, TopWords: []; "
        "FasciaPrezzo: alto, NumAuto: 0, AvgDaysOnMarket: 0.00, TopWords: []]"
    )


def raw_rows(spark, rows):
    return spark.createDataFrame(rows, text_schema(FILTERED_SCHEMA.names))


def test_invalid_rows_are_dropped(spark):
    def row(**changes):
        good = dict(
            city="Rome", daysonmarket="3", description="d", make_name="Fiat", model_name="Uno",
            price="100.5", year="2000.0", description_cleaned="",
        )
        return tuple((good | changes).values())

    for bad in ("NaN", "0", "-1", "", None, "5d"):
        assert typed_valid(spark, row(price=bad)) == (0, 0)
    for year, kept in (("1899", 0), ("1900", 1), ("2025", 1), ("2026", 0), ("x", 0), (None, 0)):
        assert typed_valid(spark, row(year=year)) == (kept, kept)
    assert typed_valid(spark, row(make_name="  ")) == (0, 1)
    assert typed_valid(spark, row(model_name=None)) == (0, 1)
    assert typed_valid(spark, row(city=" ")) == (1, 0)
    assert typed_valid(spark, row(daysonmarket="-1")) == (1, 0)
    assert typed_valid(spark, row(daysonmarket="")) == (1, 0)


def typed_valid(spark, row):
    raw = raw_rows(spark, [row])
    return (
        models.valid_listings(typed_price_listings(raw)).count(),
        bands.valid_market(typed_market_listings(raw)).count(),
    )


def test_missing_days_default(spark):
    raw = raw_rows(spark, [("Rome", None, "d", "Fiat", "Uno", "1", "2000", "")])
    assert bands.valid_market(typed_market_listings(raw)).count() == 0
    assert bands.valid_market(typed_market_listings(raw, days_default=0)).count() == 1


def test_mean_does_not_depend_on_partitioning(spark):
    prices = spark.range(100_000).select(
        F.lit("m").alias("make_name"),
        F.lit("x").alias("model_name"),
        (F.col("id") % 997 / 100 + 0.01).alias("price"),
        (F.col("id") % 20 + 2000).cast("int").alias("year"),
    )
    means = [models.group_profile(prices.repartition(n)).first().avg_price for n in (1, 3, 7, 16)]
    assert means == pytest.approx([means[0]] * 4, rel=1e-12)


def test_mean_of_huge_and_tiny_prices(spark):
    df = spark.createDataFrame(
        [
            ("m", "x", 1e300, 2000), ("m", "x", 3e300, 2001), ("m", "y", 9e14, 2000), ("m", "y", 9e14, 2000),
            ("m", "z", 4e-5, 2000), ("m", "z", 4e-5, 2001), ("m", "w", 1.23456789, 2000),
        ],
        "make_name string, model_name string, price double, year int",
    )
    means = {r.model_name: r.avg_price for r in models.group_profile(df).collect()}
    assert means == {"x": 2e300, "y": 9e14, "z": 4e-5, "w": 1.23456789}


def test_counts_add_up(spark, sf_dir):
    valid = valid_l(spark, sf_dir)
    stats = models.group_profile(valid)
    rollup = models.make_rollup(stats)
    total = valid.count()
    assert stats.agg(F.sum("n")).first()[0] == total
    nested = rollup.select(F.explode("models").alias("m")).agg(F.sum("m.n"), F.count("*")).first()
    assert tuple(nested) == (total, stats.count())
    grid = bands.band_grid(banded_l(spark, sf_dir))
    assert grid.agg(F.sum("n")).first()[0] == market_l(spark, sf_dir).count()
    assert grid.count() == 3 * grid.select("city", "year").distinct().count()


def test_models_are_in_order(spark, sf_dir):
    stats = models.group_profile(valid_l(spark, sf_dir))
    for row in models.make_rollup(stats).collect():
        names = [m.model_name for m in row.models]
        assert names == sorted(names)
    for row in models.make_rollup(stats, by_count=True).collect():
        keys = [(-m.n, m.model_name) for m in row.models]
        assert keys == sorted(keys)


@pytest.mark.parametrize("single_file", [False, True])
def test_report_is_written_in_order(spark, sf_dir, tmp_path, single_file):
    report = price_report(valid_l(spark, sf_dir))
    path = tmp_path / "report"
    write_report(report, str(path), ["make_name"], single_file=single_file)
    parts = sorted(path.glob("part-*"))
    lines = [line for part in parts for line in part.read_text().splitlines()]
    assert lines == sorted(r.line for r in report.collect())
    assert not single_file or len(parts) == 1
