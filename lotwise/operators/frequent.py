"""Most frequent values by sketch: candidates with an error bound, then exact counts of few.

The first scan keeps a bounded table of values for each column, made in each task and merged. It
hands out the most frequent values it knows. The second scan counts these exactly, in an
aggregate that passes on one row for each task. The best of them is the answer if its count is
beyond what any value that the table may have lost can reach; else all values are counted,
as without a sketch, so the answer is exact and ties stay those of the full count.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Values that a sketch tracks for each column.
CAPACITY = 8192
#: Candidates that it hands out.
CANDIDATES = 32
#: A value the table has lost stands at most this many times ``rows / CAPACITY``.
LOST_SHARE = 3.5


def _text(df: DataFrame, name: str) -> Column:
    """The value as text; null, NaN and, of texts, '' are gaps."""
    kind, value = dict(df.dtypes)[name], F.col(f"`{name}`")
    if kind in ("double", "float"):
        value = F.when(~F.isnan(value), F.when(value == 0, 0.0).otherwise(value))
    return F.nullif(value.cast("string"), F.lit("")) if kind == "string" else value.cast("string")


def candidates(df: DataFrame, cols: Sequence[str]) -> dict[str, tuple[int, list[str]]]:
    """Per column how many values it has, and its likely most frequent ones; one scan."""
    values = {c: _text(df, c) for c in cols}
    made = df.agg(
        *[F.count(v).alias(f"n{i}") for i, v in enumerate(values.values())],
        *[
            F.call_function("approx_top_k", v, F.lit(CANDIDATES), F.lit(CAPACITY)).alias(f"t{i}")
            for i, v in enumerate(values.values())
        ],
    ).first()
    found = {}
    for i, c in enumerate(cols):
        best = [x["item"] for x in made[f"t{i}"] or [] if x["item"] is not None]
        found[c] = (made[f"n{i}"], best)
    return found


def most_frequent(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows (column, top, n): the most frequent value of each column as text, ties to the smallest.

    Gaps are not counted. A column without values has no row. Two scans run when this is called.
    """
    found = candidates(df, cols)
    listed = [(c, v) for c in cols for v in found[c][1]]
    rows, open_ = [], []
    if listed:
        sums = df.agg(*[F.count_if(_text(df, c) == v).alias(f"k{i}") for i, (c, v) in enumerate(listed)]).first()
        counts = {pair: sums[f"k{i}"] for i, pair in enumerate(listed)}
    for c in cols:
        total, best = found[c]
        if not total:
            continue
        top = max(best, key=lambda v: counts[c, v], default=None)
        certain = top is not None and counts[c, top] > LOST_SHARE * total / CAPACITY
        tied = [v for v in best if certain and counts[c, v] == counts[c, top]]
        # A full list may have left out a value that ties.
        if certain and (len(best) < CANDIDATES or min(counts[c, v] for v in best) < counts[c, top]):
            rows.append((c, min(tied, key=lambda v: v.encode("utf-8")), counts[c, top]))
        else:
            open_.append(c)
    made = df.sparkSession.createDataFrame(rows, "column string, top string, n long")
    for c in open_:
        value = _text(df, c)
        full = df.select(value.alias("top")).where("top IS NOT NULL").groupBy("top").agg(F.count(F.lit(1)).alias("n"))
        best = full.agg(F.min_by(F.struct("top", "n"), F.struct(-F.col("n"), F.col("top"))).alias("b"))
        made = made.unionByName(best.select(F.lit(c).alias("column"), "b.top", "b.n"))
    return made
