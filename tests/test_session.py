"""The shared folder for intermediate tables."""

from __future__ import annotations

from types import SimpleNamespace

import pytest

from lotwise.session import materialize, shared_path
from workload.folders import work_folder


def session(master, root):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda name, default: root), sparkContext=SimpleNamespace(master=master)
    )


def test_the_folder_of_the_session_is_used():
    paths = {shared_path(session("spark://host:7077", "/shared/"), "x") for _ in range(5)}
    assert len(paths) == 5
    assert all(path.startswith("/shared/lotwise/x-") for path in paths)


@pytest.mark.parametrize("master", ["yarn", "local[4]"])
def test_a_session_without_a_folder_is_refused(master):
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_path(session(master, None), "x")


def test_a_folder_given_wins():
    assert shared_path(session("yarn", "/shared"), "x", "/mine/").startswith("/mine/lotwise/x-")


def test_queries_need_no_setting_on_one_machine_only():
    assert work_folder(session("local[4]", None))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        work_folder(session("local-cluster[2,1,1024]", None))


def test_materialized_table_reads_single_columns(spark):
    table = materialize(spark.range(100).selectExpr("id", "id * 2 AS twice"), "test")
    plan = table.select("twice")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<twice:bigint>" in plan
    assert table.count() == 100
