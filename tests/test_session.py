"""Session settings: what was submitted stays."""

import os
import subprocess
import sys

import pytest

from tonalyze import session

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_submitted_settings_survive():
    code = ("from tonalyze.session import build_session\n"
            "s = build_session('local[1]')\n"
            "print('GOT', s.conf.get('spark.sql.shuffle.partitions'), s.conf.get('spark.driver.memory', 'unset'))\n"
            "s.stop()\n")
    env = {k: v for k, v in os.environ.items() if not k.startswith("TONALYZE_")}
    env |= {"PYTHONPATH": ROOT, "PYSPARK_SUBMIT_ARGS": "--conf spark.sql.shuffle.partitions=2000 pyspark-shell"}
    out = subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True, timeout=300).stdout
    assert "GOT 2000 unset" in out


def test_a_cluster_needs_a_shared_folder():
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return Conf()

    class Spark:
        sparkContext = Context()

    with pytest.raises(ValueError):
        session.checkpoint_root(Spark())
