"""The shared checkpoint folder: taken from the session, never a local folder on a cluster."""

import pytest

from trackline.session import checkpoint_dir


class _Conf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)


class _Context:
    def __init__(self, master, ckpt=None):
        self.master = master
        self.ckpt = ckpt
        self.conf = {}

    def getCheckpointDir(self):
        return self.ckpt

    def setCheckpointDir(self, path):
        self.ckpt = path

    def getConf(self):
        return _Conf(self.conf)


class _Session:
    def __init__(self, master, session_conf=None, ckpt=None):
        self.sparkContext = _Context(master, ckpt)
        self.conf = _Conf(session_conf or {})


def test_cluster_without_checkpoint_dir_is_an_error():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_dir(_Session("yarn"))


def test_cluster_uses_the_configured_folder():
    s = _Session("spark://cluster:7077", {"spark.checkpoint.dir": "hdfs:///shared/ckpt"})
    assert checkpoint_dir(s) == "hdfs:///shared/ckpt"
    assert s.sparkContext.getCheckpointDir() == "hdfs:///shared/ckpt"


def test_folder_already_set_on_the_context_wins():
    s = _Session("k8s://api", {"spark.checkpoint.dir": "/other"}, ckpt="s3a://bucket/ckpt")
    assert checkpoint_dir(s) == "s3a://bucket/ckpt"


def test_local_master_gets_a_scratch_folder_when_unset():
    s = _Session("local[2]")
    path = checkpoint_dir(s)
    assert "checkpoints-" in path and checkpoint_dir(s) == path
