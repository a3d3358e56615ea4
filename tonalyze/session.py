"""Session construction and the shared work folder.

Derived tables (CSV copies, stream sinks, saved models, store rewrites) go
under the folder the cluster names in ``spark.checkpoint.dir``.  Only a
local session without that setting gets a folder of its own; any other
master without it is an error, since each executor would write to its own
disk.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(master: str | None = None, app: str = "tonalyze",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Session with the settings every job here assumes.

    * UTC session time zone (stored instants are UTC; oracle parity).
    * AQE on: runtime coalescing of small shuffles, skew-join splitting and
      size-checked broadcast conversion (Spark's own threshold check).
    * UI off: no server port.

    Shuffle partitions and driver memory are left as submitted, unless the
    argument or an environment variable asks for others.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    partitions = shuffle_partitions or os.environ.get("TONALYZE_SHUFFLE_PARTITIONS")
    if partitions:
        conf["spark.sql.shuffle.partitions"] = str(partitions)
    if "TONALYZE_DRIVER_MEMORY" in os.environ:
        conf["spark.driver.memory"] = os.environ["TONALYZE_DRIVER_MEMORY"]
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder; a private one only for a local
    session that has none."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="tonalyze-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused folder for one derived table or sink."""
    return f"{checkpoint_root(spark).rstrip('/')}/tonalyze-work/{name}-{uuid.uuid4().hex}"
