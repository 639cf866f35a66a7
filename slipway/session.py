"""Session settings and the shared scratch location.

The library never hard-codes partition counts: shuffles are sized by the
session (``spark.sql.shuffle.partitions``) and adjusted at run time by AQE,
which also splits skewed join partitions and turns a join into a broadcast
only when the measured size of one side is under
``spark.sql.autoBroadcastJoinThreshold``.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every session of this library should carry. Cluster-specific
# sizing (executor memory, shuffle partitions) is left to the deployment.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # Broadcast only below a checked size. Before execution the size is an
    # estimate from compressed Parquet files, so keep that threshold small
    # and inflate file estimates; larger broadcasts are decided by AQE from
    # sizes measured at run time.
    "spark.sql.autoBroadcastJoinThreshold": "10m",
    "spark.sql.sources.fileCompressionFactor": "3.0",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, app: str = "slipway",
                shuffle_partitions: int | None = None,
                extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts, stores and stream checkpoints.

    Uses the cluster's ``spark.checkpoint.dir``. Only a local session that has
    none gets a fresh local folder; on a cluster a missing setting is an error.
    """
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir")
    if configured:
        return configured.rstrip("/")
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", sc.master):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    local = tempfile.mkdtemp(prefix="slipway-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, kind: str = "stores") -> str:
    """A fresh, never reused location under the shared folder."""
    return f"{shared_dir(spark)}/slipway/{kind}/{uuid.uuid4().hex}"


def testdata_dir(sf: str = "0.1") -> str:
    return os.environ.get("SLIPWAY_TESTDATA", "/root/testdata") + f"/sf{sf}"
