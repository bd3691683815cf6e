"""Cleaning operators: sparse columns, imputation, duplicates, consistency."""

from __future__ import annotations

import fnmatch
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lotwise.functions.scalars import first_nonblank
from lotwise.operators.profiling import is_missing, most_common, value_counts
from lotwise.operators.quantiles import medians, quantile_values


def sparse_columns(df: DataFrame, threshold: float = 0.7) -> list[str]:
    """Names of columns with a larger share of gaps than ``threshold``.

    One aggregate over the table; only the list of names comes back.
    """
    shares = [F.avg(is_missing(df, c).cast("int")) for c in df.columns]
    over = [F.when(share > threshold, F.lit(c)) for share, c in zip(shares, df.columns)]
    return df.agg(F.array_compact(F.array(*over)).alias("names")).first()["names"]


def drop_sparse(df: DataFrame, threshold: float = 0.7) -> DataFrame:
    return df.drop(*sparse_columns(df, threshold))


def extraction_pairs(df: DataFrame, source: str, extracted: Column, n: int = 10) -> DataFrame:
    """A few distinct (source, extracted) pairs without nulls, in source order."""
    pairs = df.select(F.col(source), extracted.alias("extracted"))
    return pairs.dropna().distinct().orderBy(source).limit(n)


def explode_counts(df: DataFrame, items: Column) -> DataFrame:
    """How often each list element occurs."""
    each = df.select(F.explode(items).alias("item"))
    return each.groupBy("item").agg(F.count(F.lit(1)).alias("n"))


def match_rate(df: DataFrame, a: Column, b: Column, rtol: float = 1e-5, atol: float = 1e-8) -> DataFrame:
    """Percentage of rows where two numbers agree; two gaps agree."""
    close = a.eqNullSafe(b) | F.coalesce(F.abs(a - b) <= atol + rtol * F.abs(b), F.lit(False))
    return df.agg((F.count_if(close) * 100 / F.count(F.lit(1))).alias("match_pct"))


def date_parts(df: DataFrame, col: str, prefix: str) -> DataFrame:
    """Add year, month, day and day of week (Monday is 0) of a date."""
    day = F.col(col)
    return df.withColumns(
        {
            f"{prefix}_year": F.year(day),
            f"{prefix}_month": F.month(day),
            f"{prefix}_day": F.dayofmonth(day),
            f"{prefix}_dayofweek": F.weekday(day),
        }
    )


def flag_missing(df: DataFrame, cols: Sequence[str], blank: bool = False) -> DataFrame:
    """Add ``<col>_missing`` as 0 or 1; with ``blank`` empty text is missing as well."""

    def gap(c: str) -> Column:
        missing = is_missing(df, c)
        return (missing | (F.col(c) == "") if blank else missing).cast("int")

    return df.withColumns({f"{c}_missing": F.coalesce(gap(c), F.lit(1)) for c in cols})


def _filled(df: DataFrame, fills: DataFrame, cols: Sequence[str], gap_to_null: Mapping[str, Column]) -> DataFrame:
    """Replace gaps by the values in the one row of ``fills``.

    The row is a scalar subquery: it is computed once and used as a literal.
    """
    row = fills.select(F.struct(*cols)).scalar()
    return df.withColumns({c: F.coalesce(gap_to_null[c], row.getField(c)) for c in cols})


def impute_median(
    df: DataFrame,
    cols: Sequence[str],
    exclude: Sequence[str] = ("price",),
    accuracy: int | None = None,
) -> DataFrame:
    """Numeric gaps become the median of their column: exact, or by sketches of this accuracy."""
    cols = [c for c in cols if c not in exclude]
    if not cols:
        return df
    present = {c: F.when(~is_missing(df, c), F.col(c).cast("double")) for c in cols}
    if accuracy:
        return _filled(df, medians(df, cols, accuracy), cols, present)
    middle = {c: F.lit(value) for c, _, value in quantile_values(df, cols, [0.5])}
    none = F.lit(None).cast("double")
    return df.withColumns({c: F.coalesce(present[c], middle.get(c, none)) for c in cols})


def impute_mode(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Null or empty text becomes the most common value, ties to the smallest."""
    cols = list(cols)
    if not cols:
        return df
    present = {c: F.nullif(F.col(c), F.lit("")) for c in cols}
    counted = value_counts(df.select(*[e.alias(c) for c, e in present.items()]), cols)
    modes = most_common(counted).agg(
        *[F.max(F.when(F.col("column") == c, F.col("top"))).alias(c) for c in cols]
    )
    return _filled(df, modes, cols, present)


def fill_like(df: DataFrame, pattern: str = "*color*", value: str = "Unknown") -> DataFrame:
    """Null or empty text becomes ``value`` in the columns whose name fits ``pattern``."""
    names = [n for n, t in df.dtypes if t == "string" and fnmatch.fnmatchcase(n, pattern)]
    fill = {c: F.coalesce(F.nullif(F.col(c), F.lit("")), F.lit(value)) for c in names}
    return df.withColumns(fill) if fill else df


def dedupe_latest(
    df: DataFrame, key: str, date: str, tie: Sequence[str], null_key: str = "keep"
) -> DataFrame:
    """Per key the row with the latest date, null dates last, ties by ``tie``.

    Rows without a key (null or blank) are no copies of each other and all stay;
    ``null_key="collapse"`` treats them as one key instead.
    The rank filter runs in each task before the shuffle too, so however often a key
    occurs, a task passes on one row for it.
    """
    order = [F.desc_nulls_last(date), *[F.asc_nulls_last(t) for t in tie]]
    own = [F.col(key)]
    if null_key == "keep":
        absent = F.coalesce(F.trim(F.col(key).cast("string")) == "", F.lit(True))
        own.append(F.when(absent, F.monotonically_increasing_id()))
    place = F.row_number().over(Window.partitionBy(*own).orderBy(*order))
    return df.withColumn("_place", place).where(F.col("_place") == 1).drop("_place")


def lacks_text(col: Column) -> Column:
    return F.coalesce(col == "", F.lit(True))


def count_inconsistent(df: DataFrame, flag: Column, dependent: Column) -> DataFrame:
    """Rows where the flag is true and the dependent text is absent."""
    return df.agg(F.count_if(flag & lacks_text(dependent)).alias("inconsistent"))


def fill_when(df: DataFrame, condition: Column, target: str, source: Column) -> DataFrame:
    """Replace ``target`` by ``source`` in the rows that meet the condition."""
    return df.withColumn(target, F.when(condition, source).otherwise(F.col(target)))


def cross_fill_counts(df: DataFrame, a: Column, b: Column) -> DataFrame:
    """Rows with only the first text present, and rows with only the second."""
    no_a, no_b = lacks_text(a), lacks_text(b)
    return df.agg(
        F.count_if(no_a & ~no_b).alias("only_second"), F.count_if(~no_a & no_b).alias("only_first")
    )


def unify_columns(df: DataFrame, name: str, *cols: str, default: str = "Unknown") -> DataFrame:
    """New column: first non-blank of ``cols``, else ``default``."""
    return df.withColumn(
        name, F.coalesce(first_nonblank(*[F.col(c) for c in cols]), F.lit(default))
    )
