"""What lies in an input folder."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def input_inventory(
    spark: SparkSession, path: str | list[str], fmt: str = "parquet", **options
) -> DataFrame:
    """Rows (file_name, n_rows, size_mb) per input file, empty files included.

    Starts from the list of files; of the data only the number of rows is read.
    """
    name = F.col("_metadata.file_path").alias("file_path")
    listed = spark.read.format("binaryFile").load(path).select(
        name, F.col("_metadata.file_name").alias("file_name"), F.col("length").alias("file_size")
    )
    counted = (
        spark.read.format(fmt).options(**options).load(path).select(name)
        .groupBy("file_path").agg(F.count(F.lit(1)).alias("n_rows"))
    )
    return listed.join(counted, "file_path", "left").select(
        "file_name",
        F.coalesce("n_rows", F.lit(0)).alias("n_rows"),
        (F.col("file_size") / (1024 * 1024)).alias("size_mb"),
    )


def input_totals(
    spark: SparkSession, paths: Sequence[str], fmt: str = "parquet", **options
) -> DataFrame:
    """Rows (input, n_files, n_rows, size_mb) per given path, be it one file or a folder of files.

    Each path is read by itself, so the inputs may differ in schema. A path given twice counts once.
    """
    paths = list(dict.fromkeys(paths))

    def part(df: DataFrame, label: Column, files: int, rows: int, size: Column) -> DataFrame:
        return df.select(
            label.alias("input"), F.lit(files).alias("files"), F.lit(rows).alias("rows"), size.cast("long").alias("size")
        )

    # A row of zeros per path, so that one without files has its row too.
    parts = [part(spark.range(1), F.explode(F.array(*map(F.lit, paths))), 0, 0, F.lit(0))]
    for path in paths:
        parts.append(part(spark.read.format("binaryFile").load(path), F.lit(path), 1, 0, F.col("length")))
        parts.append(part(spark.read.format(fmt).options(**options).load(path), F.lit(path), 0, 1, F.lit(0)))
    return (
        reduce(DataFrame.unionByName, parts)
        .groupBy("input")
        .agg(
            F.sum("files").alias("n_files"),
            F.sum("rows").alias("n_rows"),
            (F.sum("size") / (1024 * 1024)).alias("size_mb"),
        )
    )
