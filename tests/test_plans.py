"""What the physical plans must and must not contain."""

from __future__ import annotations

import re

import pytest

from lotwise.operators.models import valid_listings
from workload import all_queries

QUERIES = all_queries()


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_workers_and_no_cross_joins(name, spark, sf_dir):
    text = plan(QUERIES[name](spark, sf_dir))
    for banned in ("EvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert banned not in text


@pytest.mark.parametrize(
    ("name", "columns"),
    [
        ("model_stats", {"l_partkey", "l_linenumber", "l_extendedprice", "l_shipdate"}),
        ("band_grid", {"l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice", "l_shipdate"}),
        ("duplicate_report", {"o_custkey"}),
        ("band_profile", {"doc_id", "lang", "source", "n_chars", "text"}),
    ],
)
def test_scans_read_only_the_needed_columns(name, columns, spark, sf_dir):
    text = plan(QUERIES[name](spark, sf_dir))
    read = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    found = [{part.split(":")[0] for part in schema.split(",")} for schema in read]
    assert columns in found


def test_price_filter_reaches_the_scan(spark, sf_dir):
    parts = spark.read.parquet(f"{sf_dir}/part.parquet")
    valid = valid_listings(parts, ["p_brand"], "p_retailprice", "p_size")
    assert "GreaterThan(p_retailprice,0.0)" in plan(valid)


def test_samples_and_stop_words_take_one_scan(spark, sf_dir):
    assert plan(QUERIES["bernoulli_sizes"](spark, sf_dir)).count("FileScan") == 1
    words = plan(QUERIES["stopword_filter"](spark, sf_dir))
    assert "BroadcastHashJoin" in words and "SortMergeJoin" not in words


@pytest.mark.parametrize("name", ["top_words", "band_profile", "model_cities", "dedupe_latest"])
def test_ranks_are_limited_before_the_shuffle(name, spark, sf_dir):
    assert plan(QUERIES[name](spark, sf_dir)).count("WindowGroupLimit") == 2


def test_model_stats_uses_hash_aggregates(spark, sf_dir):
    text = plan(QUERIES["model_stats"](spark, sf_dir))
    assert "SortAggregate" not in text
    assert text.count("partial_") > 0


def test_market_report_reads_the_text_once(spark, sf_dir):
    text = plan(QUERIES["city_year_report"](spark, sf_dir))
    assert text.count("FileScan") == 1
