"""Session helpers: a place for intermediate tables that every executor can see."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_path(spark: SparkSession, name: str, folder: str | None = None) -> str:
    """A fresh path below ``folder``, or below the checkpoint folder the cluster names.

    There is no fallback: a folder of one machine would be invisible to the others.
    """
    root = folder or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors, or pass a folder")
    return f"{root.rstrip('/')}/lotwise/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str, folder: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back.

    Cuts the lineage like a reliable checkpoint, but keeps the data columnar, so
    that later passes read only the columns they need.
    """
    path = shared_path(df.sparkSession, name, folder)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
