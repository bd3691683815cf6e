"""Exact quantiles in two scans whose work spreads over the cluster.

The built-in exact percentile keeps every distinct value of a column in one task. Here the
first scan makes a mergeable sketch of each column, which says between which two values a wanted
rank lies, within its error. The second scan counts what is below those two and the values
between them one by one, a small share of the rows. Where that share is still large, further
sketches of what lies between narrow it down, a scan each. A bracket that turns out not to hold
its rank, which sketches allow with a small chance, is widened, so the answer never
depends on the sketch. The scans run when a function is called; a few numbers come back.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Values a sketch keeps; its ranks are off by about 2.4 / SKETCH_SIZE ** 0.94 of the rows.
SKETCH_SIZE = 4096
#: Half of a bracket, as a share of the rows sketched: about four times that error.
SPREAD = 0.004
#: Steps of the shares at which a sketch is asked for closer ends.
GRID = 512
#: Rows between the ends of a bracket that are counted one by one.
COUNTED_ROWS = 4_000_000


@dataclass(frozen=True)
class Target:
    """A wanted rank of a column and the values it is between."""

    column: str
    prob: float
    rank: float
    low: float
    high: float
    n: int
    inside: int
    misses: int = 0
    settled: bool = False


def _numbers(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """The columns as doubles; NaN counts as missing."""
    doubles = [F.col(f"`{c}`").cast("double") for c in cols]
    return df.select(*[F.when(~F.isnan(v), v).alias(f"c{i}") for i, v in enumerate(doubles)])


def _at(sketch: Column, shares: Sequence[float]) -> Column:
    """The values of a sketch at these shares of its rows."""
    ranks = [F.lit(min(1.0, max(0.0, float(x)))) for x in shares]
    return F.kll_sketch_get_quantile_double(sketch, F.array(*ranks))


def _row(df: DataFrame, measures: Sequence[Column], made) -> tuple:
    """One aggregate of ``df`` and expressions of its columns m0, m1 and so on."""
    sums = df.agg(*[m.alias(f"m{i}") for i, m in enumerate(measures)])
    return sums.select(*[e.alias(f"e{i}") for i, e in enumerate(made)]).first()


def _bracketed(numbers: DataFrame, cols: Sequence[str], probs: Sequence[float]) -> list[Target]:
    """A target for each column with numbers and each probability, after the first scan."""
    measures, made = [], []
    for i in range(len(cols)):
        n, sketch = F.col(f"m{2 * i}"), F.col(f"m{2 * i + 1}")
        measures += [F.count(f"c{i}"), F.kll_sketch_agg_double(f"c{i}", F.lit(SKETCH_SIZE))]
        made += [n, F.when(n > 0, _at(sketch, [p + d for p in probs for d in (-SPREAD, SPREAD)]))]
    row = _row(numbers, measures, made)
    targets = []
    for i, c in enumerate(cols):
        n, ends = row[2 * i], row[2 * i + 1]
        for j, p in enumerate(probs):
            if n:
                low, high = ends[2 * j], ends[2 * j + 1]
                targets.append(Target(c, p, p * (n - 1), low, high, n, int(2 * SPREAD * n)))
    return targets


def _narrowed(numbers: DataFrame, cols: Sequence[str], targets: list[Target]) -> list[Target]:
    """The same targets with closer ends, after a scan that sketches what lies between."""
    measures, made = [], []
    for i, t in enumerate(targets):
        v = F.col(f"c{cols.index(t.column)}")
        inside = F.when((v >= t.low) & (v <= t.high), v)
        measures += [F.count_if(v < t.low), F.count(inside), F.kll_sketch_agg_double(inside, F.lit(SKETCH_SIZE))]
        below, n, sketch = (F.col(f"m{3 * i + k}") for k in range(3))
        made += [below, n, F.when(n > 0, _at(sketch, [k / GRID for k in range(GRID + 1)]))]
    row = _row(numbers, measures, made)
    out = []
    for i, t in enumerate(targets):
        below, n, values = row[3 * i : 3 * i + 3]
        if not below <= math.floor(t.rank) <= math.ceil(t.rank) < below + n:
            out.append(_widened(t))
            continue
        share = (t.rank - below) / n
        first = max(0, math.floor((share - SPREAD) * GRID))
        last = min(GRID, math.ceil((share + SPREAD) * GRID))
        inside = (last - first) * n // GRID
        # Where one value makes up most of a bracket, closer ends don't shrink it any more.
        settled = inside > 0.7 * t.inside
        out.append(replace(t, low=values[first], high=values[last], inside=inside, settled=settled))
    return out


def _widened(t: Target) -> Target:
    """A bracket that missed its rank, opened on both sides; at the second miss all values count."""
    again = t.misses > 0
    return replace(t, low=float("-inf"), high=float("inf"), inside=t.n, misses=t.misses + 1, settled=again)


def _is_wide(t: Target) -> bool:
    return t.inside > COUNTED_ROWS and t.low < t.high and not t.settled


def _counted(numbers: DataFrame, cols: Sequence[str], targets: list[Target]) -> list[tuple | None]:
    """Per target the values at the ranks next to it, None if the bracket lacks one; one scan.

    A value below the bracket is counted as null, so a task passes on one row for all of them.
    """
    each = []
    for i, t in enumerate(targets):
        v = F.col(f"c{cols.index(t.column)}")
        each.append(F.when(v <= t.high, F.struct(F.lit(i).alias("i"), F.when(v >= t.low, v).alias("v"))))
    found = numbers.select(F.explode(F.array_compact(F.array(*each))).alias("s")).select("s.i", "s.v")
    counts = found.groupBy("i", "v").agg(F.count(F.lit(1)).alias("n"))
    upto = Window.partitionBy("i").orderBy(F.asc_nulls_first("v"))
    upto = upto.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = counts.withColumn("before", F.sum("n").over(upto) - F.col("n"))
    ranks = F.array(*[F.lit(t.rank) for t in targets])
    rank = F.element_at(ranks, F.col("i") + 1)

    def at(place: Column) -> Column:
        here = (F.col("before") <= place) & (place < F.col("before") + F.col("n"))
        return F.max(F.when(here, F.col("v")))

    rows = before.groupBy("i").agg(at(F.floor(rank)).alias("low"), at(F.ceil(rank)).alias("high")).collect()
    ends: list[tuple | None] = [None] * len(targets)
    for i, low, high in rows:
        if low is not None and high is not None:
            ends[i] = (low, high)
    return ends


def quantile_values(
    df: DataFrame, cols: Sequence[str], probs: Sequence[float]
) -> list[tuple[str, float, float]]:
    """(column, prob, value): exact quantiles, interpolated between neighbours.

    A column without any number has none.
    """
    cols, probs = list(cols), [float(p) for p in probs]
    numbers = _numbers(df, cols)
    open_, rows = _bracketed(numbers, cols, probs) if cols and probs else [], []
    while open_:
        while wide := [t for t in open_ if _is_wide(t)]:
            open_ = [t for t in open_ if not _is_wide(t)] + _narrowed(numbers, cols, wide)
        missed = []
        for t, ends in zip(open_, _counted(numbers, cols, open_)):
            if ends is None:
                missed.append(_widened(t))
                continue
            low, high = ends
            part = t.rank - int(t.rank)
            # Of equal neighbours one is the value: the difference of infinities is no number.
            rows.append((t.column, t.prob, low if low == high else low + part * (high - low)))
        open_ = missed
    return rows


def quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """Rows (column, prob, value), as ``quantile_values`` finds them."""
    rows = quantile_values(df, cols, probs)
    return df.sparkSession.createDataFrame(rows, "column string, prob double, value double")


def medians(df: DataFrame, cols: Sequence[str], accuracy: int | None = None) -> DataFrame:
    """One row with the median of each column: exact, or by sketches of this accuracy in one scan."""
    if accuracy:
        present = {c: F.nullif(F.col(c).cast("double"), F.lit(float("nan"))) for c in cols}
        return df.agg(*[F.percentile_approx(v, 0.5, accuracy).alias(c) for c, v in present.items()])
    mid = quantiles(df, cols, [0.5])
    return mid.agg(*[F.max(F.when(F.col("column") == c, F.col("value"))).alias(c) for c in cols])
