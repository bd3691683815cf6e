"""Reading benchmark records: JSON arrays and sectioned text reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lotwise.functions.scalars import num, trimmed


def read_json_records(
    spark: SparkSession, path: str | list[str], schema: T.StructType | str, multiline: bool = True
) -> DataFrame:
    """Records of JSON arrays: one array to a file, or without ``multiline`` one to a line.

    Files with an array to a line are read in splits, however long they are.
    """
    return spark.read.schema(schema).option("multiLine", multiline).json(path)


def _group(col: Column, pattern: str) -> Column:
    """First group of the pattern, null where it does not match."""
    return F.when(col.rlike(pattern), F.regexp_extract(col, pattern, 1))


def parse_report_log(spark: SparkSession, path: str | list[str], technology: str) -> DataFrame:
    """Table rows of sectioned reports, each with the headers that precede it in its file.

    A file is read in splits. The headers are carried down in two steps: within a split,
    and from split to split over one row per split, so that a long file is never sorted
    by a single task. Rows with a bad cell or without headers are left out.
    """
    line = trimmed(F.col("value"))
    lines = spark.read.text(path).select(
        line.alias("line"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("pos"),
    )
    is_row = F.col("line").startswith("|") & F.col("line").contains("%")
    marked = lines.select(
        "file",
        "split",
        "pos",
        F.when(is_row, F.col("line")).alias("row"),
        _group(F.col("line"), r"^Summary for (\d+) nodes").try_cast("int").alias("nodes"),
        trimmed(_group(F.col("line"), r"^Job:(.*)$")).alias("job"),
    ).where("row IS NOT NULL OR nodes IS NOT NULL OR job IS NOT NULL")

    headers = ["nodes", "job"]
    by_split = Window.partitionBy("file", "split").orderBy("pos")
    inside = marked.withColumns(
        {f"in_{h}": F.last(h, ignorenulls=True).over(by_split) for h in headers}
    )

    def last_of(header: str) -> Column:
        return F.max(F.when(F.col(header).isNotNull(), F.struct("pos", header))).getField(header)

    ends = marked.groupBy("file", "split").agg(*[last_of(h).alias(f"end_{h}") for h in headers])
    earlier = (
        Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    )
    carried = ends.select(
        "file",
        "split",
        *[F.last(f"end_{h}", ignorenulls=True).over(earlier).alias(f"from_{h}") for h in headers],
    )
    rows = inside.where(F.col("row").isNotNull()).join(carried, ["file", "split"])

    cells = F.split("row", r"\|")
    parsed = rows.select(
        *[F.coalesce(f"in_{h}", f"from_{h}").alias(h) for h in headers],
        num(F.replace(F.get(cells, F.lit(1)), F.lit("%"), F.lit(""))).alias("dataset_pct"),
        num(F.get(cells, F.lit(2))).alias("input_mb"),
        trimmed(F.get(cells, F.lit(3))).try_cast("long").alias("records"),
        num(F.get(cells, F.lit(4))).alias("time_sec"),
        num(F.get(cells, F.lit(5))).alias("records_sec"),
        num(F.get(cells, F.lit(6))).alias("mb_sec"),
    )
    return parsed.dropna().withColumn("technology", F.lit(technology))
