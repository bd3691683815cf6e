"""The local session for tests and measurements."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(cpus: str | None = None) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus or os.environ.get('BENCH_CPUS', '8')}]")
        .appName("lotwise")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="lotwise-test-"))
        .config("spark.driver.memory", "12g")
        .config("spark.sql.maxMetadataStringLength", "1000")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
