"""Reading listing CSV files."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotwise.schema import project, require_columns, text_schema

BAD_ROW = "_bad_row"

_FORMAT = {
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def read_listings_csv(
    spark: SparkSession,
    path: str | list[str],
    columns: Iterable[str] | None = None,
    multiline: bool = True,
    on_missing: str = "error",
) -> DataFrame:
    """CSV with a header as text columns, found by name; short and long rows are dropped.

    With ``multiline`` a quoted field may hold line breaks. Store the typed table as
    Parquet: later jobs then read single columns in splits.
    """
    good, _ = split_bad_rows(read_flagged_csv(spark, path, multiline))
    return good if columns is None else project(good, columns, on_missing)


def read_flagged_csv(
    spark: SparkSession, path: str | list[str], multiline: bool = True
) -> DataFrame:
    """CSV as text columns, plus the whole record in ``_bad_row`` where its width is wrong.

    A quote opens a field only where the field starts. A file whose header differs from
    the first one raises instead of shifting columns. With ``multiline`` a task reads whole
    files, however large, since only the text before a line tells whether it starts a
    record: give large inputs as many files, or without line breaks in fields.
    """
    reader = spark.read.options(header=True, multiLine=multiline, **_FORMAT)
    names = reader.csv(path).columns
    # The parser must see all fields of a record to judge its width, hence no column
    # pruning inside it.
    options = {
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": BAD_ROW,
        "enforceSchema": False,
        "columnPruning": False,
    }
    rows = reader.options(**options).schema(text_schema(names).add(BAD_ROW, "string")).csv(path)
    # The second value is never there. It keeps a data column in every plan, as Spark
    # refuses to read the record column alone, such as for a count.
    never = F.when(F.length(F.col(f"`{names[0]}`")) < 0, F.lit(""))
    return rows.withColumn(BAD_ROW, F.coalesce(BAD_ROW, never))


def split_bad_rows(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of the right width, and the rejected ones."""
    require_columns(df, [BAD_ROW])
    good = df.where(F.col(BAD_ROW).isNull()).drop(BAD_ROW)
    return good, df.where(F.col(BAD_ROW).isNotNull())
