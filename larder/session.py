"""Spark session defaults and the shared checkpoint location."""

from __future__ import annotations

import re
import tempfile

from pyspark import SparkConf, SparkContext
from pyspark.sql import SparkSession


#: Set only where nothing else has: neither spark-submit, spark-defaults nor the caller.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(
    master: str | None = None,
    app_name: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Session with the settings the plans are written against.

    What was submitted wins over ``DEFAULTS``; only the arguments given here are
    forced. On a cluster leave ``master`` and ``shuffle_partitions`` unset and
    size the submitted ``spark.sql.shuffle.partitions`` to the data (AQE
    coalesces small partitions, so erring high is cheap; for ~100 TB inputs a
    few tens of thousands is a reasonable start).
    """
    SparkContext._ensure_initialized()  # so that SparkConf sees what was submitted
    submitted = SparkConf()
    builder = SparkSession.builder
    if app_name or not submitted.contains("spark.app.name"):
        builder = builder.appName(app_name or "larder")
    if master:
        builder = builder.master(master)
    conf = {k: v for k, v in DEFAULTS.items() if not submitted.contains(k)}
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory, creating a local one only in local mode.

    On a cluster the directory must be shared storage named by ``spark.checkpoint.dir``
    (or set with ``setCheckpointDir``); a machine-local folder would not survive the
    loss of an executor, so outside local mode an unset directory is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # remote (Connect) session: the server owns the setting
        if configured:
            return configured
        raise RuntimeError("spark.checkpoint.dir is not set on the server session")
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = configured or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not re.match(r"local(\[|$)", sc.master):  # local-cluster has executors of its own
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at shared storage "
            "(HDFS/S3/ABFS) before building customer ids"
        )
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="larder-ckpt-"))
    return sc.getCheckpointDir()
