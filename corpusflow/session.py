"""Session construction and shared-storage helpers."""
from __future__ import annotations

import datetime as _dt
import tempfile

from pyspark.sql import SparkSession

# Fixed clock used by every time-dependent query in tests and checks.
FIXED_NOW = _dt.datetime(2024, 1, 31, 0, 0, 0)
FIXED_NOW_SQL = "TIMESTAMP_NTZ'2024-01-31 00:00:00'"


def get_spark(master: str | None = None, app: str = "corpusflow",
              shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings this library assumes.

    On a cluster leave ``master`` unset and let spark-submit decide; the
    shuffle partition count then comes from the cluster configuration.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # Arrow batches double as the embedder batch size.
        "spark.sql.execution.arrow.maxRecordsPerBatch": "2048",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the session.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session
    (tests, single-node checks) without one gets a private folder.
    """
    sc = spark.sparkContext
    cur = sc.getCheckpointDir()
    if cur:
        return cur
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir() or conf_dir
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    path = tempfile.mkdtemp(prefix="corpusflow-ckpt-")
    sc.setCheckpointDir(path)
    return path

