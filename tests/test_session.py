"""Checkpoint-folder policy and session helpers."""

from types import SimpleNamespace

import pytest

from yellowstar.session import ensure_checkpoint_dir, scratch_path


class _Conf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)


class _Context:
    def __init__(self, master, current=None):
        self.master, self.current = master, current

    def getCheckpointDir(self):
        return self.current

    def setCheckpointDir(self, path):
        self.current = path


def test_cluster_without_checkpoint_dir_is_refused():
    spark = SimpleNamespace(sparkContext=_Context("yarn"), conf=_Conf({}))
    with pytest.raises(RuntimeError, match="shared storage"):
        ensure_checkpoint_dir(spark)


def test_configured_dir_is_used_as_is():
    spark = SimpleNamespace(sparkContext=_Context("yarn"), conf=_Conf({"spark.checkpoint.dir": "hdfs:///ckpt"}))
    assert ensure_checkpoint_dir(spark) == "hdfs:///ckpt"


def test_local_mode_gets_a_folder_when_unset():
    spark = SimpleNamespace(sparkContext=_Context("local[2]"), conf=_Conf({}))
    assert ensure_checkpoint_dir(spark)


def test_scratch_paths_live_under_the_checkpoint_dir(spark):
    base = ensure_checkpoint_dir(spark).rstrip("/")
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a.startswith(base + "/x-") and a != b
