"""Stored sketches and tables in buckets."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from lotwise.operators import sketches
from lotwise.sources import buckets
from tests.test_plans import plan
from workload import all_queries


def test_united_sketches_equal_a_sketch_of_the_whole(spark):
    df = spark.range(30_000).selectExpr("id % 7 AS day", "id % 9000 AS a", "CAST(id % 50 AS DOUBLE) AS b", "CAST(id AS STRING) AS c")
    cols = ["a", "b", "c"]
    whole = sketches.distinct_estimates(sketches.distinct_sketches(df, [], cols), cols).first()
    days = sketches.distinct_sketches(df, ["day"], cols)
    union = sketches.distinct_estimates(sketches.united(days, [], cols), cols).first()
    assert union.n_rows == whole.n_rows == 30_000
    for c, n in (("a", 9000), ("b", 50), ("c", 30_000)):
        assert abs(union[c] - n) <= sketches.error_bound() * n
        assert abs(union[c] - whole[c]) <= sketches.error_bound() * n


def test_gaps_and_zeros_of_sketches(spark):
    rows = [(1, 0.0, None), (1, -0.0, None), (1, float("nan"), None), (1, None, None), (2, 5.0, "x")]
    df = spark.createDataFrame(rows, "k int, a double, b string")
    made = sketches.distinct_estimates(sketches.distinct_sketches(df, ["k"], ["a", "b"]), ["a", "b"])
    assert sorted(map(tuple, made.collect())) == [(1, 4, 1, 0), (2, 1, 1, 1)]
    assert sketches.distinct_sketches(df.limit(0), ["k"], ["a"]).count() == 0


def test_uniting_sketches_reads_no_rows(spark, sf_dir, tmp_path):
    df = spark.read.parquet(f"{sf_dir}/orders.parquet")
    sketches.distinct_sketches(df, ["o_orderstatus"], ["o_custkey"]).write.parquet(str(tmp_path / "s"))
    text = plan(sketches.united(spark.read.parquet(str(tmp_path / "s")), [], ["o_custkey"]))
    assert text.count("FileScan") == 1 and "o_orderstatus" not in text


@pytest.mark.parametrize("name", ["bucketed_join", "bucketed_latest"])
def test_tables_in_buckets_need_no_shuffle(name, spark, sf_dir):
    text = plan(all_queries()[name](spark, sf_dir))
    assert "Exchange" not in text and "SelectedBucketsCount: 8 out of 8" in text


def test_bucketed_table_keeps_all_rows(spark, tmp_path):
    rng = random.Random(2)
    rows = [(rng.choice([None, 1, 1, 1, 2, 3]), rng.randint(0, 9), f"v{i}") for i in range(500)]
    df = spark.createDataFrame(rows, "k int, t int, v string")
    made = buckets.bucketed(df, ["k"], 4, ["t"], folder=str(tmp_path))
    assert sorted(map(str, made.collect())) == sorted(map(str, df.collect()))
    best = buckets.latest_in_buckets(made, ["k"], [F.desc("t"), F.asc("v")])
    want = {k: min((-t, v) for x, t, v in rows if x == k) for k in (None, 1, 2, 3)}
    assert {r.k: (-r.t, r.v) for r in best.collect()} == want
    assert buckets.bucketed(df.limit(0), ["k"], 4, folder=str(tmp_path)).count() == 0
