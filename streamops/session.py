"""Session helpers: a configured SparkSession and a shared scratch folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every operator assumes; the time zone only matters for the
# streaming forms (batch forms convert TIMESTAMP_NTZ without a zone).
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


# Settings for the 100 TB target (about 1000 executors).  A full shuffle of
# 100 TB at ~256 MB per reducer needs ~400k reducers; start at 100k and let
# AQE coalesce small ones and split skewed ones.  Scan splits of 512 MB keep
# ~200k map tasks.  Decommissioning migrates shuffle and cached blocks off a
# leaving executor, so losing one does not recompute whole stages.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "100000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64m",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.files.maxPartitionBytes": "512m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.decommission.enabled": "true",
    "spark.storage.decommission.enabled": "true",
    "spark.storage.decommission.shuffleBlocks.enabled": "true",
    "spark.storage.decommission.rddBlocks.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def get_session(master: str | None = None, app: str = "streamops",
                shuffle_partitions: int | None = None,
                extra: dict | None = None, profile: str = "local") -> SparkSession:
    """``profile="cluster"`` adds ``CLUSTER_CONF``; explicit ``extra`` wins."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(BASE_CONF)
    if profile == "cluster":
        conf.update(CLUSTER_CONF)
    for k, v in conf.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting names a shared file system folder and is used as
    is.  Only when it is unset and the master is local (tests) do we create
    one: on a cluster a machine-local folder would lose rows, so this raises.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[.*\])?", master):
            raise ValueError(f"set spark.checkpoint.dir to a folder that all executors of {master} share")
        d = tempfile.mkdtemp(prefix="streamops-ckpt-")
    spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, "streamops", f"{name}-{uuid.uuid4().hex[:12]}")
