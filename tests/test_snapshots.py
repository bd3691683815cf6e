"""Differences of table states and subtotals against plain counting."""

from __future__ import annotations

import math
import random
from collections import Counter

import pytest

from lotwise.operators import snapshots
from lotwise.operators.subtotals import subtotals
from tests.test_plans import plan

SCHEMA = "k int, `a b` string, x double"


def states(seed):
    rng = random.Random(seed)
    row = lambda: (rng.choice([1, 2, 3, 4, 5, None]), rng.choice(["u", "", None]), rng.choice([0.0, 1.5, None, math.nan]))
    old = [row() for _ in range(60)] + [(9, "gone", 1.0)] * 40
    new = [*old[:30], *[row() for _ in range(25)], (8, "new", 2.0), (8, "new", 2.0)]
    return old, new


def counts(rows):
    return Counter(map(repr, map(tuple, rows)))


@pytest.fixture(scope="module")
def both(spark):
    old, new = states(4)
    return old, new, spark.createDataFrame(old, SCHEMA), spark.createDataFrame(new, SCHEMA)


def test_bags(both):
    old, new, a, b = both
    assert counts(snapshots.bag_except(a, b).collect()) == counts(old) - counts(new)
    assert counts(snapshots.bag_except(b, a).collect()) == counts(new) - counts(old)
    assert counts(snapshots.bag_intersect(a, b).collect()) == counts(old) & counts(new)
    assert counts(snapshots.bag_except(a, a).collect()) == Counter()
    # columns in another order are the same table
    assert counts(snapshots.bag_except(a, b.select("x", "a b", "k")).collect()) == counts(old) - counts(new)


def test_row_changes(both):
    old, new, a, b = both
    got = Counter()
    for *row, change, n in snapshots.row_changes(a, b).collect():
        got[repr(tuple(row)), change] += n
    want = Counter({(r, "gone"): n for r, n in (counts(old) - counts(new)).items()})
    assert got == want + Counter({(r, "added"): n for r, n in (counts(new) - counts(old)).items()})


def test_key_changes(both):
    old, new, a, b = both
    want, kinds = {}, Counter()
    for k in {r[0] for r in old + new}:
        o, n = counts(r for r in old if r[0] == k), counts(r for r in new if r[0] == k)
        kind = "same" if o == n else "added" if not o else "gone" if not n else "changed"
        kinds[kind] += 1
        if kind != "same":
            want[k] = (kind, (o - n).total(), (n - o).total())
    assert {r[0]: tuple(r)[1:] for r in snapshots.key_changes(a, b, ["k"]).collect()} == want
    assert {r[0]: r[1] for r in snapshots.change_counts(a, b, ["k"]).collect()} == kinds


def test_states_without_rows_or_with_other_columns(both):
    old, _, a, b = both
    assert counts(snapshots.bag_except(a, b.limit(0)).collect()) == counts(old)
    assert snapshots.row_changes(a.limit(0), b.limit(0)).count() == 0
    assert {r.change for r in snapshots.key_changes(a.limit(0), b, ["k"]).collect()} == {"added"}
    with pytest.raises(ValueError, match="x"):
        snapshots.row_counts(a, b.drop("x"))


def test_equal_rows_are_counted_before_the_shuffle(both):
    text = plan(snapshots.row_changes(both[2], both[3]))
    assert text.count("Exchange") == 1 and text.count("partial_") > 0 and "Join" not in text


ROWS = [("a", 1, 2.0, "x"), ("a", 1, 4.0, "x"), ("a", None, None, "y"), (None, 1, 1.0, None), ("b", 2, 0.5, "x"), ("b", 2, 0.5, "x")]


@pytest.mark.parametrize("cube", [False, True])
def test_subtotals(spark, cube):
    df = spark.createDataFrame(ROWS, "d string, e int, v double, c string")
    want = {}
    for level in [0, 1, 2, 3] if cube else [0, 1, 3]:
        for d, e, _, _ in ROWS:
            group = (None if level & 2 else d, None if level & 1 else e)
            rows = [r for r in ROWS if (level & 2 or r[0] == d) and (level & 1 or r[1] == e)]
            values = [r[2] for r in rows if r[2] is not None]
            total = sum(values) if values else None
            want[(*group, level)] = (
                len(rows),
                total,
                total / len(values) if values else None,
                min(values, default=None),
                max(values, default=None),
                len({r[3] for r in rows} - {None}),
            )
    got = subtotals(df, ["d", "e"], "v", "c", cube=cube).collect()
    assert {tuple(r)[:3]: tuple(r)[3:] for r in got} == want and len(got) == len(want)


def test_subtotals_read_the_table_once(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/part.parquet")
    text = plan(subtotals(df, ["p_brand", "p_type"], "p_retailprice", "p_size"))
    assert text.count("FileScan") == 1 and "Join" not in text
