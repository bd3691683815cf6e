"""The one place that chooses a folder for the intermediate tables of registered queries."""

from __future__ import annotations

import functools
import tempfile

from pyspark.sql import SparkSession


@functools.cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="lotwise-")


def work_folder(spark: SparkSession) -> str:
    """The session's shared checkpoint folder.

    A session with a local master has one machine only, so there a temporary folder of
    the process stands in for a setting that is absent. Any other master needs the setting.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    return _local_folder()
