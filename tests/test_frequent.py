"""Most frequent values against plain counting."""

from __future__ import annotations

import random
from collections import Counter

import pytest

from lotwise.operators import frequent
from tests.test_plans import plan


def plain(values):
    counts = Counter(str(v) for v in values if v is not None and v != "" and v == v)
    if not counts:
        return None
    n = max(counts.values())
    return min(v for v, m in counts.items() if m == n), n


def check(spark, columns, kinds):
    names = [f"c{i}" for i in range(len(columns))]
    df = spark.createDataFrame(list(zip(*columns)), ", ".join(f"{n} {k}" for n, k in zip(names, kinds)))
    got = {r.column: (r.top, r.n) for r in frequent.most_frequent(df, names).collect()}
    want = {n: plain(c) for n, c in zip(names, columns)}
    assert got == {n: w for n, w in want.items() if w}


@pytest.mark.parametrize("capacity", [8192, 32])
def test_skewed_flat_and_tied_columns(spark, monkeypatch, capacity):
    monkeypatch.setattr(frequent, "CAPACITY", capacity)
    monkeypatch.setattr(frequent, "CANDIDATES", 8)
    rng = random.Random(1)
    n = 4000
    skewed = [f"v{min(int(rng.expovariate(0.1)), 300)}" for _ in range(n)]
    flat = [f"x{i}" for i in range(n)]  # every value once: nothing is certain
    tied = [rng.choice(["b", "a"]) for _ in range(n - 2)] + ["b", "b"]
    tied = ["a", "b"] * (n // 2)
    gaps = [None, ""] * (n // 2)
    numbers = [i % 9 if i % 3 else None for i in range(n)]
    many_ties = [f"t{i % 50:02}" for i in range(n)]
    check(spark, [skewed, flat, tied, gaps, numbers, many_ties], ["string"] * 4 + ["int", "string"])


def test_late_heavy_value(spark, monkeypatch):
    """A value that comes after the table is full of others."""
    monkeypatch.setattr(frequent, "CAPACITY", 64)
    values = [f"u{i}" for i in range(3000)] + ["late"] * 1000
    check(spark, [values], ["string"])


def test_empty_table(spark):
    df = spark.createDataFrame([], "a string, b int")
    assert frequent.most_frequent(df, ["a", "b"]).collect() == []


def test_certain_values_are_not_shuffled(spark):
    df = spark.range(1000).selectExpr("CAST(id % 3 AS STRING) AS a")
    assert "Exchange" not in plan(frequent.most_frequent(df, ["a"]))
