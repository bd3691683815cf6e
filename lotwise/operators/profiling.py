"""Profiles of a table: shape, types, gaps, distinct values, duplicates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lotwise.operators.quantiles import quantiles


def is_missing(df: DataFrame, name: str) -> Column:
    """Null, or NaN in a floating column."""
    gap = F.col(name).isNull()
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        gap = gap | F.isnan(name)
    return gap


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def _per_column(df: DataFrame, measures: Mapping[str, Mapping[str, Column]]) -> DataFrame:
    """All measures of all columns in one aggregate, then one row per column."""
    flat = [m.alias(f"{c}|{k}") for c, ms in measures.items() for k, m in ms.items()]
    rows = [
        F.struct(F.lit(c).alias("column"), *[F.col(f"`{c}|{k}`").alias(k) for k in ms])
        for c, ms in measures.items()
    ]
    return df.agg(*flat).select(F.inline(F.array(*rows)))


def table_shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_columns", F.lit(len(df.columns)))


def column_info(df: DataFrame) -> DataFrame:
    """Rows (column, dtype, non_null)."""
    return _per_column(
        df,
        {
            f.name: {"dtype": F.first(F.lit(f.dataType.simpleString())), "non_null": F.count(f"`{f.name}`")}
            for f in df.schema.fields
        },
    )


def describe_numeric(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows (column, n, mean, std, min, q25, median, q75, max); quartiles are exact."""
    plain = _per_column(
        df,
        {
            c: {
                "n": F.count(c),
                "mean": F.avg(F.col(c).cast("double")),
                "std": F.stddev_samp(F.col(c).cast("double")),
                "min": F.min(F.col(c).cast("double")),
                "max": F.max(F.col(c).cast("double")),
            }
            for c in cols
        },
    )
    names = {0.25: "q25", 0.5: "median", 0.75: "q75"}
    quarts = quantiles(df, cols, list(names)).groupBy("column").agg(
        *[F.max(F.when(F.col("prob") == p, F.col("value"))).alias(n) for p, n in names.items()]
    )
    return plain.join(quarts, "column", "left").select(
        "column", "n", "mean", "std", "min", *names.values(), "max"
    )


def value_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows (column, value, n) with values as text; nulls and NaN are not counted.

    The two zeros of floating point are one value.
    """
    floats = {n for n, t in df.dtypes if t in ("float", "double")}

    def text(name: str):
        value = F.col(f"`{name}`")
        if name in floats:
            value = F.when(~F.isnan(value), value + F.lit(0).cast("float"))
        return value.cast("string").alias(name)

    texts = df.select(*[text(c) for c in cols])
    long = texts.unpivot([], list(cols), "column", "value").where(F.col("value").isNotNull())
    return long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))


def most_common(counts: DataFrame) -> DataFrame:
    """Rows (column, n, n_unique, top, top_n) from value counts; ties to the smallest value."""
    best = F.min(F.struct((-F.col("n")).alias("minus_n"), F.col("value"))).alias("best")
    return (
        counts.groupBy("column")
        .agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("n_unique"), best)
        .select(
            "column",
            "n",
            "n_unique",
            F.col("best.value").alias("top"),
            (-F.col("best.minus_n")).alias("top_n"),
        )
    )


def describe_text(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows (column, n, n_unique, top, top_n); a column without values has zeros and no top."""
    found = most_common(value_counts(df, cols))
    zero = {c: F.coalesce(c, F.lit(0)).alias(c) for c in ("n", "n_unique", "top_n")}
    return _names(df, cols).join(found, "column", "left").select(
        "column", zero["n"], zero["n_unique"], "top", zero["top_n"]
    )


def _names(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """The names as a table, without reading any."""
    names = F.array(*[F.lit(c) for c in cols])
    return df.sparkSession.range(1).select(F.explode(names).alias("column"))


def unique_counts(df: DataFrame, approx: bool = False) -> DataFrame:
    """Rows (column, n_unique), most first; ``approx`` uses sketches instead of a shuffle."""
    if approx:
        out = _per_column(
            df, {c: {"n_unique": F.approx_count_distinct(F.col(f"`{c}`"))} for c in df.columns}
        )
    else:
        found = value_counts(df, df.columns).groupBy("column").agg(F.count(F.lit(1)).alias("n_unique"))
        # A column of nulls only has no value rows.
        out = _names(df, df.columns).join(found, "column", "left").select(
            "column", F.coalesce("n_unique", F.lit(0)).alias("n_unique")
        )
    return out.orderBy(F.desc("n_unique"), "column")


def missing_report(df: DataFrame, top: int | None = None) -> DataFrame:
    """Rows (column, missing, pct) of columns with gaps, most first."""
    gaps = _per_column(
        df,
        {
            c: {"missing": F.count_if(is_missing(df, c)), "total": F.count(F.lit(1))}
            for c in df.columns
        },
    )
    out = (
        gaps.where(F.col("missing") > 0)
        .select("column", "missing", (F.col("missing") / F.col("total") * 100).alias("pct"))
        .orderBy(F.desc("missing"), "column")
    )
    return out.limit(top) if top else out


# Texts that stand for a missing value.
NONE_TEXTS = ("None", "none")


def placeholder_report(df: DataFrame, tokens: Sequence[str] = NONE_TEXTS) -> DataFrame:
    """Rows (column, placeholder, n, pct) for empty text and for ``tokens``, only where present."""
    texts = text_columns(df)
    counts = _per_column(
        df,
        {
            c: {
                "empty": F.count_if(F.col(c) == ""),
                "none": F.count_if(F.col(c).isin(*tokens)),
                "total": F.count(F.lit(1)),
            }
            for c in texts
        },
    )
    return (
        counts.unpivot(["column", "total"], ["empty", "none"], "placeholder", "n")
        .where(F.col("n") > 0)
        .select("column", "placeholder", "n", (F.col("n") / F.col("total") * 100).alias("pct"))
    )


def duplicate_report(df: DataFrame, key: str) -> DataFrame:
    """One row: keys that occur more than once, and rows beyond the first of each."""
    repeated = (
        df.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > 1)
    )
    return repeated.agg(
        F.count(F.lit(1)).alias("duplicated_keys"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("surplus_rows"),
    )


def validity_funnel(
    df: DataFrame,
    listing_ok: Column,
    market_ok: Column,
    make: str = "make_name",
    model: str = "model_name",
    city: str = "city",
    year: str = "year",
    band: str = "band",
) -> DataFrame:
    """Rows (rule, n): total, valid and rejected rows and distinct groups, in one scan.

    Two grouping sets reduce the rows to distinct (make, model) and (city, year,
    band) with counts; everything else is counted from these.
    """
    listing = F.coalesce(listing_ok, F.lit(False))
    market = F.coalesce(market_ok, F.lit(False))
    flagged = df.select(
        listing.alias("listing"),
        F.when(listing, F.col(make)).alias("make"),
        F.when(listing, F.col(model)).alias("model"),
        market.alias("market"),
        F.when(market, F.col(city)).alias("city"),
        F.when(market, F.col(year)).alias("year"),
        F.when(market, F.col(band)).alias("band"),
    )
    left, right = ["listing", "make", "model"], ["market", "city", "year", "band"]
    groups = flagged.groupingSets([left, right], *left, *right).agg(
        F.count(F.lit(1)).alias("n"), F.grouping("listing").alias("is_market")
    )
    on_listing, on_market = F.col("is_market") == 0, F.col("is_market") == 1
    ok_listing, ok_market = on_listing & F.col("listing"), on_market & F.col("market")
    places = F.struct("city", "year")
    measures = {
        "total_rows": F.sum(F.when(on_listing, F.col("n"))),
        "valid_listings": F.sum(F.when(ok_listing, F.col("n"))),
        "rejected_listings": F.sum(F.when(on_listing & ~F.col("listing"), F.col("n"))),
        "valid_market_rows": F.sum(F.when(ok_market, F.col("n"))),
        "rejected_market_rows": F.sum(F.when(on_market & ~F.col("market"), F.col("n"))),
        "makes": F.countDistinct(F.when(ok_listing, F.col("make"))),
        "make_models": F.count_if(ok_listing),
        "city_years": F.countDistinct(F.when(ok_market, places)),
        "city_year_bands": F.count_if(ok_market),
    }
    row = groups.agg(*[F.coalesce(m, F.lit(0)).alias(k) for k, m in measures.items()])
    return row.unpivot([], list(measures), "rule", "n")


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """Sorted distinct values of a column, nulls left out."""
    return df.select(col).where(F.col(col).isNotNull()).distinct().orderBy(col)
