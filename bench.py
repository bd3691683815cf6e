"""Time the headline queries: one JSON line, seconds per query.

Each query runs once to warm up and then three times in one session; the median counts.
Results are written to the no-op sink, so that every row and column is computed but none
is collected. Both reports also run straight from CSV files, with their MB/s.
"""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time
from pathlib import Path

from pyspark.sql import functions as F

from lotwise.plans.reports import (
    market_report,
    price_report,
    typed_market_listings,
    typed_price_listings,
)
from lotwise.sources.listings_csv import read_listings_csv
from lotwise.sources.sinks import write_table
from tests.sessions import local_session
from workload import all_queries
from workload.views import text_listings

HEADLINE = [
    "model_stats",
    "make_report",
    "make_report_cities",
    "band_stats",
    "band_grid",
    "band_pivot",
    "tokenize",
    "word_counts",
    "top_words",
    "band_profile",
    "city_year_report",
    "validity_funnel",
    "describe_numeric",
    "unique_counts",
    "dedupe_latest",
    "impute_median",
    "impute_mode",
    "clean_listings",
    "csv_source",
    "parse_report_log",
    "speedup_vs_baseline",
    "metric_pivot",
]
RUNS = 3
CSV_FILES = 16


def seconds(query, spark, sf_dir: str) -> float:
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def median_seconds(query, spark, sf_dir: str) -> float:
    seconds(query, spark, sf_dir)
    return round(statistics.median(seconds(query, spark, sf_dir) for _ in range(RUNS)), 3)


def csv_jobs(spark, sf_dir: str) -> tuple[dict, float]:
    """Both reports from listings with long texts in CSV files, and the size of those in MB."""
    folder = tempfile.mkdtemp(prefix="lotwise-bench-")
    makes = F.concat(F.lit("make"), F.col("doc_id") % 50).alias("make_name")
    models = F.concat(F.lit("model"), F.col("doc_id") % 900).alias("model_name")
    rows = text_listings(spark, sf_dir).select("*", makes, models).repartition(CSV_FILES, "doc_id")
    write_table(rows, f"{folder}/listings", "csv")
    size = sum(f.stat().st_size for f in Path(folder, "listings").glob("part-*")) / 1e6

    def raw():
        return read_listings_csv(spark, f"{folder}/listings")

    return {
        "make_report_from_csv": lambda *_: price_report(typed_price_listings(raw())),
        "city_year_report_from_csv": lambda *_: market_report(typed_market_listings(raw())),
    }, size


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    queries = all_queries()
    from_csv, megabytes = csv_jobs(spark, sf_dir)
    jobs = {name: queries[name] for name in HEADLINE} | from_csv
    times = {name: median_seconds(job, spark, sf_dir) for name, job in jobs.items()}
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "runs": RUNS,
                "listings": rows,
                "job1_listings_per_sec": round(rows / times["make_report"]),
                "csv_mb": round(megabytes, 1),
                "csv_mb_per_sec": {name: round(megabytes / times[name], 1) for name in from_csv},
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
