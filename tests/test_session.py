import os
import subprocess
import sys

import pytest

from larder.session import ensure_checkpoint_dir

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


class _Conf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)


class _Context:
    def __init__(self, master, conf=None):
        self.master = master
        self._dir = None
        self._conf = _Conf(conf or {})

    def getCheckpointDir(self):
        return self._dir

    def setCheckpointDir(self, d):
        self._dir = d

    def getConf(self):
        return self._conf


class _Session:
    def __init__(self, master, conf=None):
        self.sparkContext = _Context(master)
        self.conf = _Conf(conf or {})


def test_cluster_without_checkpoint_dir_is_an_error():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(_Session("yarn"))


def test_configured_dir_is_used_on_a_cluster():
    s = _Session("yarn", {"spark.checkpoint.dir": "hdfs:///shared/ckpt"})
    assert ensure_checkpoint_dir(s) == "hdfs:///shared/ckpt"


def test_local_mode_gets_a_scratch_dir():
    assert ensure_checkpoint_dir(_Session("local[2]"))


def test_local_cluster_has_executors_and_needs_a_shared_dir():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(_Session("local-cluster[2,1,1024]"))


def test_submitted_settings_survive():
    code = (
        "from larder.session import build_session; s = build_session();"
        "print('GOT', s.conf.get('spark.sql.shuffle.partitions'), s.conf.get('spark.sql.session.timeZone'), s.conf.get('spark.sql.adaptive.enabled'))"
    )
    args = "--master local[1] --conf spark.sql.shuffle.partitions=4000 --conf spark.sql.session.timeZone=Asia/Tokyo --conf spark.ui.enabled=false pyspark-shell"
    out = subprocess.run([sys.executable, "-c", code], env=os.environ | {"PYSPARK_SUBMIT_ARGS": args, "PYTHONPATH": ROOT}, capture_output=True, text=True, timeout=120)
    assert "GOT 4000 Asia/Tokyo true" in out.stdout, out.stderr[-500:]
