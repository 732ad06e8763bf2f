"""Where intermediate tables go."""

from types import SimpleNamespace

import pytest

from pairforge.session import scratch_path, scratch_scope, shared_dir, written


def _session(master, configured=None):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: configured or default),
        sparkContext=SimpleNamespace(master=master, applicationId=f"app-{master}"),
    )


def test_shared_dir():
    assert shared_dir(_session("yarn", "hdfs:///shared/")) == "hdfs:///shared"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(_session("yarn"))
    local = _session("local[2]")
    assert shared_dir(local) == shared_dir(local)
    assert scratch_path(local, "x") != scratch_path(local, "x")


def test_scope_drops_its_tables(spark):
    kept = written(spark.range(3), "kept")
    with scratch_scope(spark):
        inside = written(spark.range(5), "inside")
        assert inside.count() == 5
        path = inside.inputFiles()[0]
    assert kept.count() == 3
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path).count()
