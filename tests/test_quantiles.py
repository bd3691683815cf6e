"""Exact quantiles against numpy."""

from __future__ import annotations

import numpy as np
import pytest

from lotwise.operators import quantiles as module
from lotwise.operators.quantiles import medians, quantiles

PROBS = [0.0, 0.01, 0.25, 0.5, 0.75, 0.999, 1.0]


def check(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    got = {r.prob: r.value for r in quantiles(df, ["v"], PROBS).collect()}
    for p in PROBS:
        assert got[p] == pytest.approx(np.quantile(values, p), rel=1e-12, abs=1e-12), p


@pytest.mark.parametrize("n", [1, 2, 3, 4, 10, 1001])
def test_small_and_mixed_signs(spark, n):
    check(spark, np.random.default_rng(n).normal(0, 1000, n))


def test_ties_outliers_and_zero(spark):
    check(spark, [0.0] * 50 + [5.0] * 51 + [1e300, -1e300, 1e-300, -0.0])


def test_gap_between_the_two_middle_values(spark):
    check(spark, [1.0, 1e9])
    check(spark, [-1e9, -1.0, 1.0, 1e9])


def test_crowded_values(spark):
    """All values within one bin, and then within one slice."""
    check(spark, 1e6 + np.random.default_rng(1).random(2000))
    check(spark, 1e6 + np.arange(500) * 2**-30)


def test_gaps_are_left_out(spark):
    df = spark.createDataFrame(
        [(1.0, None, 1), (float("nan"), None, 2), (None, None, 4), (3.0, None, None)],
        "a double, b double, c int",
    )
    rows = medians(df, ["a", "b", "c"]).collect()
    assert [tuple(r) for r in rows] == [(2.0, None, 2.0)]


def test_infinite_and_tiny_values(spark):
    inf = float("inf")
    df = spark.createDataFrame([(inf, 1e-12 * i) for i in range(1, 6)], "a double, b double")
    assert tuple(medians(df, ["a", "b"]).first()) == (inf, 3e-12)


@pytest.mark.parametrize(("size", "spread", "counted"), [(8, 0.0, 10**6), (8, 0.01, 20), (64, 0.2, 50), (8, 0.0, 0)])
def test_exact_whatever_the_sketch_says(spark, monkeypatch, size, spread, counted):
    for name, value in (("SKETCH_SIZE", size), ("SPREAD", spread), ("COUNTED_ROWS", counted)):
        monkeypatch.setattr(module, name, value)
    rng = np.random.default_rng(5)
    check(spark, rng.normal(0, 1, 3000))
    check(spark, [7.0] * 3000 + rng.normal(7, 1, 1500).tolist())
    check(spark, [1.0] * 1000)


def jobs_of(spark, run):
    tracker, group = spark.sparkContext.statusTracker(), f"jobs-{id(run)}"
    spark.sparkContext.setJobGroup(group, group)
    run()
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(tracker.getJobIdsForGroup(group))


def test_few_jobs(spark):
    df = spark.range(10_000).selectExpr("CAST(id AS DOUBLE) AS a", "CAST(id % 7 AS INT) AS b")
    assert jobs_of(spark, lambda: quantiles(df, ["a", "b"], [0.25, 0.5, 0.75])) <= 6


def test_approximate_median_takes_one_scan(spark):
    df = spark.range(1001).selectExpr("CAST(id AS DOUBLE) AS a")
    approximate = medians(df, ["a"], accuracy=1000)
    assert abs(approximate.first().a - 500) <= 2
