"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Column call sites cost a JVM round trip each and are wanted only in debugging.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def get_session(app: str = "contrail", master: str | None = None, **conf: str) -> SparkSession:
    """Build (or fetch) a session with the settings the operators rely on.

    On a cluster leave ``master`` unset and pass a generous
    ``spark.sql.shuffle.partitions``; AQE coalesces what is not needed.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh folder path every executor can reach.

    The cluster names its shared folder in ``spark.checkpoint.dir``; a local
    temporary folder is used only where that setting is missing and the master
    is local, since executors elsewhere would each write to their own disk.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="contrail-")
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex[:12]}"
