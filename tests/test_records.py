"""Benchmark records, metric tables and samples."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from lotwise.operators import metrics as M
from lotwise.operators import sampling as S
from lotwise.sources.records import parse_report_log, read_json_records
from lotwise.sources.sinks import read_report, write_report

LOG = """Report
| 1.00% | 1 | 1 | 1 | 1 | 1 |
Summary for 3 nodes (Spark):
------
Job: job1_spark
| Dataset Size | Input Size (MB) | Records | Time (s) | Records/sec | MB/sec |
|--------------|----------------|---------|----------|-------------|--------|
|    1.00% |     12.34 | 70001 |   20.50 |    3414.68 |  0.60 |
|  100.00% |  8000.08 | 45000000 |  300.25 |  149875.10 | 26.64 |
|  broken% | 1 | 2 | 3 | 4 | 5 |
|    5.00% | 1 | 2.5 | 3 | 4 | 5 |
|    5.00% | 1 |
Job: job2_spark
|    1.00% |     12.34 | 70001 |   21.75 |    3218.44 |  0.60 |
Summary for 5 nodes (Spark):
|   10.00% |    111.22 |612345 |   40.40 |   15157.05 |  2.75 |
"""

PARSED = [
    (3, "job1_spark", 1.0, 12.34, 70001, 20.5, 3414.68, 0.6, "Spark Core"),
    (3, "job1_spark", 100.0, 8000.08, 45000000, 300.25, 149875.1, 26.64, "Spark Core"),
    (3, "job2_spark", 1.0, 12.34, 70001, 21.75, 3218.44, 0.6, "Spark Core"),
    (5, "job2_spark", 10.0, 111.22, 612345, 40.4, 15157.05, 2.75, "Spark Core"),
]


@pytest.mark.parametrize("split", ["134217728", "50", "130"])
def test_headers_are_carried_across_splits(spark, tmp_path, split):
    (tmp_path / "a.txt").write_text(LOG)
    (tmp_path / "b.txt").write_text("Job: other\n| 1.00% | 1 | 1 | 1 | 1 | 1 |\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        rows = parse_report_log(spark, str(tmp_path), "Spark Core").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert sorted(map(tuple, rows)) == PARSED


def test_json_array(spark, tmp_path):
    records = [{"job": "job1", "time": 1.5}, {"job": "job2", "time": None}]
    (tmp_path / "r.json").write_text(json.dumps(records, indent=2))
    rows = read_json_records(spark, str(tmp_path), "job string, time double").collect()
    assert sorted(map(tuple, rows)) == [("job1", 1.5), ("job2", None)]


@pytest.fixture(scope="module")
def runs(spark):
    return spark.createDataFrame(
        [("a", 3, 1, 10.0), ("a", 5, 1, 8.0), ("a", 3, 10, 50.0), ("b", 5, 1, 4.0), ("b", 5, 10, 40.0),
         ("c", 3, 1, 1.0), ("c", 3, 10, 20.0)],
        "job string, nodes int, size int, time double",
    )


def test_baseline_drops_groups_without_one(runs):
    out = M.ratio_to_baseline(runs, ["job", "size"], "nodes", 3, "time")
    rows = {(r.job, r.nodes, r.size): (r.speedup, r.efficiency_pct) for r in out.collect()}
    assert set(rows) == {("a", 3, 1), ("a", 5, 1), ("a", 3, 10), ("c", 3, 1), ("c", 3, 10)}
    assert rows["a", 5, 1] == (1.25, pytest.approx(75.0))


def test_growth_and_verdict(runs):
    three = runs.where("nodes = 3 OR job = 'b'")
    growth = {(r.job, r.size): r.scaling_factor for r in M.growth(three, ["job"], "size", "time").collect()}
    assert growth == {("a", 1): 1.0, ("a", 10): 0.5, ("b", 1): 1.0, ("b", 10): 1.0, ("c", 1): 1.0, ("c", 10): 2.0}
    verdict = M.scaling_verdict(three, ["job"], "size", "time")
    assert {r.job: r.verdict for r in verdict.collect()} == {"a": "SUB-linear", "b": "linear", "c": "SUPER-linear"}
    two_way = M.scaling_verdict(three, ["job"], "size", "time", three_way=False)
    assert {r.job: r.verdict for r in two_way.collect()}["b"] == "SUPER-linear"


def test_names_labels_and_rates(spark):
    df = spark.createDataFrame([("job1_sparksql", 10, 0.0), ("sqljob2_spark", 10, 4.0)], "job string, n int, t double")
    out = df.select(M.normalize_names(F.col("job")), M.map_labels(F.col("job"), {"job1_sparksql": "One"}))
    assert [tuple(r) for r in out.collect()] == [("job1", "One"), ("job2", None)]
    rates = M.throughput(df, "n", "n", "t").orderBy("t").collect()
    assert [r.records_per_sec for r in rates] == [0.0, 2.5]


def test_samples(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_orderkey", "l_linenumber", "l_partkey")
    key = ["l_orderkey", "l_linenumber"]
    part = S.hash_sample(rows, key, 0.2)
    assert part.exceptAll(rows).isEmpty()
    assert S.hash_sample(rows.repartition(5), key, 0.2).exceptAll(part).isEmpty()
    assert S.hash_sample(rows, key, 0.1).exceptAll(part).isEmpty()
    drawn = S.bernoulli_sample(rows, 0.3, seed=1)
    assert drawn.exceptAll(rows).isEmpty() and 0 < drawn.count() < rows.count()
    assert S.bernoulli_sample(rows, 1.0).count() == rows.count()
    sizes = {r.fraction: r.n for r in S.sample_sizes(rows, key, [0.2, 1.0]).collect()}
    assert sizes == {0.2: part.count(), 1.0: rows.count()}


def test_arrays_one_to_a_line(spark, tmp_path):
    lines = [json.dumps([{"a": i * 10 + k, "b": f"x\n{k}"} for k in range(3)]) for i in range(50)]
    spark.createDataFrame([(x,) for x in lines] + [("[]",), ("",)], "value string").coalesce(1).write.text(str(tmp_path / "j"))
    rows = read_json_records(spark, str(tmp_path / "j"), "a long, b string", multiline=False).dropna().collect()
    assert sorted(r.a for r in rows) == sorted(i * 10 + k for i in range(50) for k in range(3))


def test_lines_of_a_report_have_their_place(spark, tmp_path):
    path = str(tmp_path / "report")
    df = spark.range(5000).select(F.concat(F.lit("line "), F.col("id")).alias("line"), (-F.col("id")).alias("o"))
    write_report(df.repartition(6), path, ["o"])
    rows = read_report(spark, path).collect()
    assert {r.place: r.line for r in rows} == {i + 1: f"line {4999 - i}" for i in range(5000)}
    assert read_report(spark, path).where("place = 1").first().line == "line 4999"
