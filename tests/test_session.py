"""Checkpoint-folder policy: shared folder from the session, private temp
folder only for local masters, fail fast on a cluster without one."""

import pytest

from ledgerlens.session import ensure_checkpoint_dir


class _Conf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)


class _SC:
    def __init__(self, master, conf=None, current=None):
        self.master, self._conf, self._dir = master, _Conf(conf or {}), current

    def getCheckpointDir(self):
        return self._dir

    def getConf(self):
        return self._conf

    def setCheckpointDir(self, d):
        self._dir = d


class _Spark:
    def __init__(self, sc):
        self.sparkContext = sc


def test_keeps_existing_folder():
    assert ensure_checkpoint_dir(_Spark(_SC("yarn", current="hdfs:///ckpt"))) == "hdfs:///ckpt"


def test_uses_configured_shared_folder():
    sc = _SC("yarn", conf={"spark.checkpoint.dir": "s3a://bucket/ckpt"})
    assert ensure_checkpoint_dir(_Spark(sc)) == "s3a://bucket/ckpt"


def test_local_master_gets_private_folder():
    assert ensure_checkpoint_dir(_Spark(_SC("local[4]"))).startswith("/")


def test_cluster_without_folder_fails_fast():
    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(_Spark(_SC("spark://master:7077")))


def test_scale_conf_sizes_partitions():
    from ledgerlens.session import scale_conf
    big = scale_conf(100 * 10**12, task_slots=8000)
    assert 8000 < int(big["spark.sql.shuffle.partitions"]) <= 40_000
    small = scale_conf(10**6, task_slots=8)
    assert small["spark.sql.shuffle.partitions"] == "16"
