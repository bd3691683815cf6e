"""Event streams: windowed counts with late rows, and one row per key, in bounded state.

A stream reads a folder of files. ``run_available`` works off what has arrived and stops; run
again with the same checkpoint, it goes on where it was, and files already read change nothing.
State is bounded by the watermark, the latest event time so far less the allowed lateness:
a window leaves the state, and the table it is written to gets it, once the watermark passes
its end, and rows for windows that are closed are dropped. The number of state partitions is
fixed by the first run of a checkpoint, so it is a parameter and not the session's setting.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
KEPT_SETTINGS = ("spark.sql.ansi.enabled", "spark.sql.caseSensitive")


def state_session(spark: SparkSession, partitions: int) -> SparkSession:
    """A session of the same application whose streams keep state on disk in so many partitions.

    Its time zone is UTC, so that times without a zone have days of equal length.
    """
    session = spark.newSession()
    for name in KEPT_SETTINGS:
        session.conf.set(name, spark.conf.get(name))
    session.conf.set("spark.sql.session.timeZone", "UTC")
    session.conf.set("spark.sql.shuffle.partitions", str(partitions))
    session.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    return session


def file_stream(
    spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int | None = None
) -> DataFrame:
    """Rows of the Parquet files that arrive in a folder."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def _zoned(stream: DataFrame, time: str) -> DataFrame:
    """The stream with a time that can have a watermark."""
    plain = dict(stream.dtypes)[time] == "timestamp_ntz"
    return stream.withColumn(time, F.col(time).cast("timestamp")) if plain else stream


def windowed_counts(
    stream: DataFrame,
    time: str,
    width: str,
    lateness: str,
    keys: Sequence[str] = (),
    value: str | None = None,
    slide: str | None = None,
) -> DataFrame:
    """Per window and keys: rows, and sum, least and greatest of ``value``.

    Rows without a time belong to no window. Counts are combined before the shuffle.
    """
    measures = [F.count(F.lit(1)).alias("n")]
    if value:
        measures += [F.sum(value).alias("total"), F.min(value).alias("low"), F.max(value).alias("high")]
    window = F.window(time, width, slide) if slide else F.window(time, width)
    kind = dict(stream.dtypes)[time]
    counted = _zoned(stream, time).withWatermark(time, lateness).groupBy(window, *keys).agg(*measures)
    return counted.select(
        F.col("window.start").cast(kind).alias("window_start"),
        F.col("window.end").cast(kind).alias("window_end"),
        *keys,
        *[c for c in counted.columns if c not in ("window", *keys)],
    )


def first_per_key(stream: DataFrame, key: Sequence[str], time: str, lateness: str) -> DataFrame:
    """The first row that arrives for each key; repeats within the lateness are dropped.

    A key leaves the state once the watermark is past its time and the lateness. Of rows of
    one batch any may be the first. Rows without a time are kept apart from state and all dropped.
    """
    kind = dict(stream.dtypes)[time]
    timed = _zoned(stream.where(F.col(time).isNotNull()), time)
    first = timed.withWatermark(time, lateness).dropDuplicatesWithinWatermark(list(key))
    return first.withColumn(time, F.col(time).cast(kind)).select(*stream.columns)


def run_available(df: DataFrame, path: str, checkpoint: str, mode: str = "append") -> list[dict]:
    """Append what has arrived to a Parquet table, then stop; progress of the batches.

    The table lists its files itself, so a batch that is repeated after a failure is not read twice.
    """
    query = (
        df.writeStream.format("parquet")
        .outputMode(mode)
        .trigger(availableNow=True)
        .option("checkpointLocation", checkpoint)
        .start(path)
    )
    query.awaitTermination()
    return [
        {
            "batch": p.batchId,
            "rows": p.numInputRows,
            "state_rows": sum(s.numRowsTotal for s in p.stateOperators),
            "late_rows": sum(s.numRowsDroppedByWatermark for s in p.stateOperators),
            "watermark": (p.eventTime or {}).get("watermark"),
        }
        for p in query.recentProgress
    ]
