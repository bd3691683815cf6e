"""Tables stored in buckets of a key, so that joins and groups by the key need no shuffle.

Both sides of a join have to be written with the same number of buckets. Rows of a bucket are
sorted by the key and ``sort_by``, which a merge join and a rank by key make use of.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lotwise.session import shared_path


def bucketed(
    df: DataFrame,
    key: Sequence[str],
    buckets: int,
    sort_by: Sequence[str] = (),
    name: str | None = None,
    folder: str | None = None,
) -> DataFrame:
    """Write ``df`` as a table of the catalog, below the shared folder, and read it.

    One shuffle by bucket comes first, so that a bucket is one file and not one for each task. A
    key that holds most rows makes one large bucket: such tables are better left unbucketed.
    """
    table = name or f"bucketed_{uuid.uuid4().hex}"
    sorted_by = [*key, *sort_by]
    (
        df.repartition(buckets, *key)
        .write.mode("overwrite")
        .option("path", shared_path(df.sparkSession, table, folder))
        .bucketBy(buckets, *key)
        .sortBy(*sorted_by)
        .saveAsTable(table)
    )
    return df.sparkSession.table(table)


def latest_in_buckets(df: DataFrame, key: Sequence[str], order: Sequence) -> DataFrame:
    """Per key the first row in ``order``, of a table in buckets of the key: no shuffle."""
    place = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
    return df.withColumn("_place", place).where("_place = 1").drop("_place")
