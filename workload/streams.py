"""Event streams over the given events, which arrive in two parts, the second with late rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotwise.session import shared_path
from lotwise.streaming.events import file_stream, first_per_key, run_available, state_session, windowed_counts
from workload.folders import work_folder
from workload.views import table

SPLIT = "2024-01-15 00:00:00"
LATENESS = "3 days"
STATE_PARTITIONS = 8


def _events(spark, sf) -> DataFrame:
    cents = F.round(F.col("value") * 100).cast("long").alias("cents")
    return table(spark, sf, "events").select("event_id", "ts", "event_type", "value", cents)


def _before_split():
    return F.col("ts") < F.lit(SPLIT).cast("timestamp_ntz")


def streamed(spark, arrivals, transform, folder: str) -> DataFrame:
    """Let the parts arrive one by one, each worked off by a run of its own, and read the table."""
    source, sink, checkpoint = (shared_path(spark, f"stream-{x}", folder) for x in ("in", "out", "state"))
    session = state_session(spark, STATE_PARTITIONS)
    for part in arrivals:
        part.write.mode("append").parquet(source)
        run_available(transform(file_stream(session, source, part.schema)), sink, checkpoint)
    return spark.read.parquet(sink)


def windowed_stream(spark, sf):
    """Counts per six hours and type. Every tenth event comes with the second part, up to weeks late."""
    events = _events(spark, sf)
    first = _before_split() & (F.col("event_id") % 10 != 0)

    def counted(stream):
        return windowed_counts(stream, "ts", "6 hours", LATENESS, ["event_type"], "cents")

    return streamed(spark, [events.where(first), events.where(~first)], counted, work_folder(spark))


def sliding_stream(spark, sf):
    """Daily counts every six hours, all types together."""
    events = _events(spark, sf)

    def counted(stream):
        return windowed_counts(stream, "ts", "24 hours", LATENESS, slide="6 hours")

    parts = [events.where(_before_split()), events.where(~_before_split())]
    return streamed(spark, parts, counted, work_folder(spark))


def stream_first_rows(spark, sf):
    """One row per event, whether its repeats come along or arrive again with other values."""
    events = _events(spark, sf)
    early = events.where(_before_split())
    again = early.where(F.col("event_id") % 7 == 0).withColumn("value", -F.col("value"))
    late = events.where(~_before_split())
    copies = late.where(F.col("event_id") % 5 == 0)

    def kept(stream):
        return first_per_key(stream, ["event_id"], "ts", LATENESS)

    parts = [early, late.unionByName(copies).unionByName(again)]
    made = streamed(spark, parts, kept, work_folder(spark))
    return made.select("event_id", "event_type", "value")


QUERIES = {
    "windowed_stream": windowed_stream,
    "sliding_stream": sliding_stream,
    "stream_first_rows": stream_first_rows,
}

_MARKS = f"""A AS (SELECT event_id, ts, event_type, CAST(round(value * 100) AS BIGINT) AS cents,
                ts < TIMESTAMP '{SPLIT}' AS early FROM events),
W AS (SELECT date_trunc('milliseconds', max(ts) FILTER (early AND event_id % 10 <> 0)) - INTERVAL 3 DAY AS mark_1,
             date_trunc('milliseconds', max(ts)) - INTERVAL 3 DAY AS mark_2 FROM A)"""

ORACLES = {
    "windowed_stream": f"""WITH {_MARKS},
        R AS (SELECT *, time_bucket(INTERVAL 6 HOUR, ts) AS window_start FROM A)
        SELECT window_start, window_start + INTERVAL 6 HOUR AS window_end, event_type, count(*) AS n,
               CAST(sum(cents) AS BIGINT) AS total, min(cents) AS low, max(cents) AS high
        FROM R, W WHERE (early AND event_id % 10 <> 0 OR window_start + INTERVAL 6 HOUR > mark_1)
          AND window_start + INTERVAL 6 HOUR <= mark_2
        GROUP BY 1, 2, 3""",
    "sliding_stream": f"""WITH {_MARKS},
        R AS (SELECT time_bucket(INTERVAL 6 HOUR, ts) - k * INTERVAL 6 HOUR AS window_start
              FROM A, range(4) r(k))
        SELECT window_start, window_start + INTERVAL 24 HOUR AS window_end, count(*) AS n
        FROM R, W WHERE window_start + INTERVAL 24 HOUR <= mark_2 GROUP BY 1, 2""",
    "stream_first_rows": "SELECT event_id, event_type, value FROM events",
}
