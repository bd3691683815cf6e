"""Distinct counts kept as columns: sketches per part, united without the rows.

A HyperLogLog sketch of 2**k bytes at most stands for the set of values it has seen. Sketches of
parts, such as days, are stored in a table; those of any longer period are their unions.
An estimate is off by about 1.04 / sqrt(2**k) of the count, in all but one case of a
thousand by less than four times that.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Binary logarithm of a sketch's size.
SKETCH_BITS = 12


def _sketched(df: DataFrame, name: str) -> Column:
    """A value that a sketch takes; the two zeros of floating point are one, NaN is a gap."""
    kind, value = df.schema[name].dataType, F.col(f"`{name}`")
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return F.when(~F.isnan(value), F.when(value == 0, 0.0).otherwise(value)).cast("string")
    plain = isinstance(kind, (T.IntegerType, T.LongType, T.StringType, T.BinaryType))
    return value if plain else value.cast("string")


def distinct_sketches(
    df: DataFrame, keys: Sequence[str], cols: Sequence[str], bits: int = SKETCH_BITS
) -> DataFrame:
    """Per keys the rows and a sketch of each column, made in one scan before any shuffle.

    Nulls are not counted. A column that has only nulls in a group has an empty sketch.
    """
    sketches = [F.hll_sketch_agg(_sketched(df, c), F.lit(bits)).alias(c) for c in cols]
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"), *sketches)


def united(sketches: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Sketches of larger groups: no row of the table is read again."""
    merged = [F.hll_union_agg(c).alias(c) for c in cols]
    return sketches.groupBy(*keys).agg(F.sum("n_rows").alias("n_rows"), *merged)


def distinct_estimates(sketches: DataFrame, cols: Sequence[str]) -> DataFrame:
    """The sketches as estimated counts."""
    return sketches.withColumns({c: F.hll_sketch_estimate(c) for c in cols})


def error_bound(bits: int = SKETCH_BITS) -> float:
    """The share of a count by which an estimate may be off."""
    return 4 * 1.04 / math.sqrt(1 << bits)
