"""The shared work folder comes from the session, never a local default on a cluster."""

import pytest

from tablevault.session import new_work_dir, shared_root


class _Conf(dict):
    def get(self, key, default=None):  # noqa: D102 - dict-like stub of the runtime conf
        return super().get(key, default)


class _Context:
    def __init__(self, master, conf=None, ckpt=None):
        self.master = master
        self._conf = _Conf(conf or {})
        self._ckpt = ckpt
        self.set_to = None

    def getConf(self):  # noqa: N802 - mirrors SparkContext
        return self._conf

    def getCheckpointDir(self):  # noqa: N802
        return self._ckpt

    def setCheckpointDir(self, d):  # noqa: N802
        self.set_to = d


class _Session:
    def __init__(self, master, conf=None, ckpt=None):
        self.conf = _Conf(conf or {})
        self.sparkContext = _Context(master, conf, ckpt)


def test_cluster_without_a_shared_folder_is_an_error():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_root(_Session("yarn"))


def test_configured_folder_is_used_as_is():
    s = _Session("yarn", conf={"spark.checkpoint.dir": "hdfs://nn/shared/ckpt/"})
    assert shared_root(s) == "hdfs://nn/shared/ckpt"
    assert new_work_dir(s, "x").startswith("hdfs://nn/shared/ckpt/tablevault/x-")


def test_folder_set_by_set_checkpoint_dir_is_reused():
    s = _Session("yarn", ckpt="s3a://bucket/ckpt/2f1c0b6e-uuid")
    assert shared_root(s) == "s3a://bucket/ckpt"


def test_local_session_without_a_folder_gets_one():
    s = _Session("local[2]")
    root = shared_root(s)
    assert root and s.sparkContext.set_to == root


def test_work_folders_can_be_removed(spark, monkeypatch):
    from tablevault import session
    from tablevault.sources import fs

    monkeypatch.setattr(session, "_MADE", [])
    path = session.new_work_dir(spark, "gone")
    spark.range(3).write.parquet(path)
    assert session.remove_work_dirs(spark) == 1 and not fs.exists(spark, path)
    assert session.remove_work_dirs(spark) == 0
