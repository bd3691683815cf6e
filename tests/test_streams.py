"""Streams in several runs: late rows, restarts, repeats and bounded state."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest

from lotwise.streaming.events import file_stream, first_per_key, run_available, state_session, windowed_counts

START = datetime(2024, 5, 1)
SCHEMA = "id long, at timestamp_ntz, kind string, v long"


class Feed:
    """A folder that rows arrive in, and a stream that works them off run by run."""

    def __init__(self, spark, folder, transform):
        self.spark, self.folder, self.transform = spark, folder, transform
        self.session = state_session(spark, 2)

    def arrive(self, rows):
        made = [(i, None if h is None else START + timedelta(hours=h), kind, v) for i, h, kind, v in rows]
        df = self.spark.createDataFrame(made, SCHEMA)
        df.coalesce(1).write.mode("append").parquet(f"{self.folder}/in")

    def run(self):
        schema = self.spark.createDataFrame([], SCHEMA).schema
        stream = self.transform(file_stream(self.session, f"{self.folder}/in", schema))
        return run_available(stream, f"{self.folder}/out", f"{self.folder}/state")

    def table(self):
        return self.spark.read.parquet(f"{self.folder}/out")


def counts(feed):
    return {((r.window_start - START) / timedelta(hours=1), r.kind): (r.n, r.total) for r in feed.table().collect()}


@pytest.fixture
def windows(spark, tmp_path):
    return Feed(spark, str(tmp_path), lambda s: windowed_counts(s, "at", "1 hour", "2 hours", ["kind"], "v"))


def test_late_rows_count_within_the_lateness_only(windows):
    windows.arrive([(1, 0.5, "a", 1), (2, 5.5, "a", 2), (3, 5.6, None, 3), (4, None, "a", 9)])
    windows.run()  # the watermark is now 3.6
    assert counts(windows) == {(0, "a"): (1, 1)}
    windows.arrive([(5, 4.2, "a", 10), (6, 1.5, "a", 100), (7, 3.7, "a", 1000), (8, 20.0, "a", 5)])
    progress = windows.run()
    # 1.5 is in a window that is closed; 3.7 is not; 20.0 closes all but its own.
    assert sum(p["late_rows"] for p in progress) == 1
    assert counts(windows) == {
        (0, "a"): (1, 1), (3, "a"): (1, 1000), (4, "a"): (1, 10), (5, "a"): (1, 2), (5, None): (1, 3),
    }
    assert progress[-1]["state_rows"] == 1


def test_a_restart_changes_nothing(windows):
    windows.arrive([(i, float(i), "a", i) for i in range(12)])
    windows.run()
    before = counts(windows)
    windows.session = state_session(windows.spark, 5)  # the checkpoint keeps its own partitions
    windows.run()
    assert counts(windows) == before
    windows.arrive([(99, 30.0, "a", 0)])
    windows.run()
    assert counts(windows) == before | {(h, "a"): (1, h) for h in range(9, 12)}


def test_windows_of_one_batch_equal_a_plain_aggregate(spark, windows):
    rows = [(i, (i * 37 % 500) / 7, "ab"[i % 2], i) for i in range(500)]
    windows.arrive([*rows, (1000, 200.0, "z", 0)])
    windows.run()
    df = windows.spark.read.parquet(f"{windows.folder}/in").where("id < 1000")
    want = df.groupBy("kind").count().collect()
    got = windows.table().groupBy("kind").sum("n").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))


def test_sliding_windows_overlap(spark, tmp_path):
    feed = Feed(spark, str(tmp_path), lambda s: windowed_counts(s, "at", "2 hours", "0 hours", slide="1 hour"))
    feed.arrive([(1, 5.5, "a", 1), (2, 50.0, "a", 1)])
    feed.run()
    assert sorted((r.window_start - START) / timedelta(hours=1) for r in feed.table().where("n = 1").collect())[:2] == [4, 5]


def test_first_rows_over_several_runs(spark, tmp_path):
    feed = Feed(spark, str(tmp_path), lambda s: first_per_key(s, ["id"], "at", "2 hours"))
    feed.arrive([(1, 1.0, "a", 1), (1, 1.0, "a", 1), (2, 2.0, "a", 2), (None, 2.0, "n", 0), (3, None, "a", 3)])
    feed.run()
    feed.arrive([(1, 1.5, "again", 7), (2, 2.5, "again", 7), (None, 2.5, "again", 7), (4, 3.0, "b", 4)])
    progress = feed.run()
    assert progress[-1]["state_rows"] == 4
    assert sorted((r.id or 0, r.kind) for r in feed.table().collect()) == [(0, "n"), (1, "a"), (2, "a"), (4, "b")]
    feed.arrive([(5, 40.0, "c", 5)])
    feed.run()
    feed.arrive([(6, 41.0, "c", 6), (4, 3.0, "late repeat", 4)])
    progress = feed.run()
    assert progress[-1]["state_rows"] <= 2, "keys that the watermark has passed leave the state"
    assert sorted((r.id or 0) for r in feed.table().collect()) == [0, 1, 2, 4, 5, 6]


def test_state_is_bounded_by_the_watermark(spark, tmp_path):
    feed = Feed(spark, str(tmp_path), lambda s: first_per_key(s, ["id"], "at", "3 hours"))
    sizes = []
    for day in range(4):
        feed.arrive([(day * 1000 + i, day * 24 + i / 50, "a", 0) for i in range(1000)])
        sizes.append(feed.run()[-1]["state_rows"])
    assert feed.table().count() == 4000
    assert max(sizes) < 1000
