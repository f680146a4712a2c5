"""Checkpoint folder: read from the session, set only where unset."""

import pytest

from plotline.session import checkpoint_dir


class _Conf:
    def __init__(self, value, read_only=False):
        self.value, self.read_only = value, read_only

    def get(self, key, default=None):
        return self.value if self.value is not None else default

    def set(self, key, value):
        if self.read_only:
            raise RuntimeError("read-only")
        self.value = value


class _SC:
    def __init__(self, current=None, master="local[2]"):
        self.current, self.master = current, master

    def getCheckpointDir(self):
        return self.current

    def setCheckpointDir(self, path):
        self.current = path


class _Spark:
    def __init__(self, conf, sc):
        self.conf, self.sparkContext = conf, sc


def test_uses_the_session_setting():
    s = _Spark(_Conf("/shared/ckpt"), _SC())
    assert checkpoint_dir(s) == "/shared/ckpt" and s.sparkContext.current == "/shared/ckpt"


def test_makes_a_folder_only_when_unset():
    s = _Spark(_Conf(None, read_only=True), _SC())
    path = checkpoint_dir(s)
    assert path and s.sparkContext.current == path
    assert checkpoint_dir(s) == path  # stays the same


def test_keeps_an_existing_context_folder():
    s = _Spark(_Conf(None), _SC("/already/set"))
    assert checkpoint_dir(s) == "/already/set"


def test_a_cluster_needs_the_setting():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_dir(_Spark(_Conf(None), _SC(master="spark://host:7077")))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_dir(_Spark(_Conf(None), _SC(master="local-cluster[2,1,1024]")))
