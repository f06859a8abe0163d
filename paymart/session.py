"""Session settings and the shared folder for written intermediates."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# The ids that a streaming dedup remembers live in RocksDB on local disk, with
# a copy in the checkpoint, and not in executor memory.
#
# Left to Spark's own defaults on purpose: the broadcast threshold (a size
# check before every broadcast), file split size and executor sizing.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Call sites kept with every column expression; half the time of building a plan.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def get_session(app_name: str = "paymart", **settings: object) -> SparkSession:
    """A session with the settings every job here relies on."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, str(value))
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder, as ``spark.checkpoint.dir`` names it.

    Only a local session without that setting gets a folder of its own.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if context.master != "local" and not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", folder)
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; nothing is ever reused there."""
    return f"{shared_dir(spark)}/paymart/{name}-{uuid.uuid4().hex}"
