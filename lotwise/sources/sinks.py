"""Writing results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def write_report(
    df: DataFrame, path: str, order_by: Sequence[str], line: str = "line", single_file: bool = False
) -> None:
    """Write report lines in order, replacing what is there.

    Part files are in order of their names. With ``single_file`` one task sorts and
    writes everything, so that is for reports of a size that one task can handle.
    """
    if single_file:
        ordered = df.repartition(1).sortWithinPartitions(*order_by)
    else:
        ordered = df.orderBy(*order_by)
    ordered.select(line).write.mode("overwrite").text(path)


def read_report(spark: SparkSession, path: str) -> DataFrame:
    """(place, line): the lines of a written report with their place in it, from 1.

    Files are in order of their names. Lines are numbered within each split of a file, then
    carried on over one row per split, so no task sees the whole report.
    """
    lines = spark.read.text(path).select(
        F.col("value").alias("line"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("pos"),
    )
    within = F.row_number().over(Window.partitionBy("file", "split").orderBy("pos"))
    sizes = lines.groupBy("file", "split").agg(F.count(F.lit(1)).alias("n"))
    ahead = F.sum("n").over(Window.orderBy("file", "split")) - F.col("n")
    starts = sizes.select("file", "split", ahead.alias("ahead"))
    numbered = lines.withColumn("within", within).join(starts, ["file", "split"])
    return numbered.select((F.col("ahead") + F.col("within")).alias("place"), "line")


def write_table(
    df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = ()
) -> None:
    """Write a table as Parquet, or as CSV that ``read_listings_csv`` reads back unchanged."""
    writer = df.write.mode("overwrite").partitionBy(*partition_by)
    if fmt == "csv":
        writer = writer.options(
            header=True,
            quote='"',
            escape='"',
            ignoreLeadingWhiteSpace=False,
            ignoreTrailingWhiteSpace=False,
        )
    writer.format(fmt).save(path)
