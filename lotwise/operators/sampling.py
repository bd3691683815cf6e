"""Samples of a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Hashes of keys lie below this number.
HASHES = 1 << 32


def head_sample(df: DataFrame, n: int, order_by: Sequence[str]) -> DataFrame:
    """First ``n`` rows in the given order; no total sort, each task keeps ``n`` rows."""
    return df.orderBy(*order_by).limit(n)


def bernoulli_sample(df: DataFrame, fraction: float, seed: int = 42) -> DataFrame:
    """Keep each row with probability ``fraction``; 1 or more keeps all."""
    return df if fraction >= 1 else df.sample(fraction=fraction, seed=seed)


def bernoulli_sizes(df: DataFrame, fractions: Sequence[float], seed: int = 42) -> DataFrame:
    """Rows (fraction, n, total_rows): sizes of nested random samples, all from one scan."""
    drawn = df.select(F.rand(seed).alias("u"))
    row = drawn.agg(
        F.count(F.lit(1)).alias("total_rows"),
        *[F.count_if(F.col("u") < f).alias(f"f{i}") for i, f in enumerate(fractions)],
    )
    sizes = [
        F.struct(F.lit(float(f)).alias("fraction"), F.col(f"f{i}").alias("n"), "total_rows")
        for i, f in enumerate(fractions)
    ]
    return row.select(F.inline(F.array(*sizes)))


def key_hash(key_cols: Sequence[str]) -> Column:
    """A number below 2**32 that depends on the key alone, not on the run or partitioning."""
    key = F.concat_ws("|", *[F.col(c).cast("string") for c in key_cols])
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("long")


def hash_sample(df: DataFrame, key_cols: Sequence[str], fraction: float) -> DataFrame:
    """Repeatable sample of about ``fraction`` of the keys."""
    return df.where(key_hash(key_cols) < fraction * HASHES)


def sample_sizes(df: DataFrame, key_cols: Sequence[str], fractions: Sequence[float]) -> DataFrame:
    """Rows (fraction, n): sizes of nested samples, all from one scan."""
    bucket = df.select(key_hash(key_cols).alias("h"))
    row = bucket.agg(
        *[F.count_if(F.col("h") < f * HASHES).alias(f"f{i}") for i, f in enumerate(fractions)]
    )
    sizes = [
        F.struct(F.lit(float(f)).alias("fraction"), F.col(f"f{i}").alias("n"))
        for i, f in enumerate(fractions)
    ]
    return row.select(F.inline(F.array(*sizes)))


def preview(df: DataFrame, order_by: Sequence[str], n: int = 10) -> DataFrame:
    """First ten rows of a result."""
    return head_sample(df, n, order_by)
