"""Session helpers: UTC pinning, adaptive execution and the shared checkpoint root."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession

# Settings every session used by the library should carry. They are runtime SQL
# confs, so they can be applied to a session the caller already built.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # keep the padded HMAC key literals out of logged plan text
    "spark.sql.redaction.string.regex": "(?i)0x[0-9A-F]{64,}",
}


# Starting points for a large cluster (set by the launcher; not applied automatically).
# AQE coalesces the generous shuffle partition count down to the advisory size, and
# splits skewed join partitions; the broadcast threshold is Spark's own size check.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "20000",             # ~2-3x total cores at 1000 executors
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    # size-based coalescing suits a busy shared cluster; on one small machine it costs
    # parallelism (about a quarter slower over the sf0.1 batch queries on local[8])
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def ensure_conf(spark: SparkSession) -> SparkSession:
    """Pin the runtime settings the queries rely on (UTC above all)."""
    for k, v in RUNTIME_CONF.items():
        try:
            if spark.conf.get(k, None) != v:
                spark.conf.set(k, v)
        except Exception:  # noqa: BLE001 - a locked setting: keep the session's value
            if k == "spark.sql.session.timeZone":
                raise  # results depend on it
    return spark


def local_session(
    cpus: int | str = "*",
    shuffle_partitions: int = 8,
    app_name: str = "streamcharts",
    checkpoint_dir: str | None = None,
) -> SparkSession:
    """A local session for tests and the bench.

    On a cluster the session comes from the launcher; only then is
    ``spark.checkpoint.dir`` already set to the shared folder.
    """
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in RUNTIME_CONF.items():
        builder = builder.config(k, v)
    if checkpoint_dir:
        builder = builder.config("spark.checkpoint.dir", checkpoint_dir)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only on a local master, where driver and tasks share one disk, is a folder picked when it is unset, and
    recorded back on the session so every later caller agrees on it. On a cluster an unset folder is an error:
    each node would see a temporary folder of its own.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect: the server owns the checkpoint dir
        root = spark.conf.get("spark.checkpoint.dir", None)
        if not root:
            raise RuntimeError("spark.checkpoint.dir must name a shared folder") from None
        return root
    root = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        import re
        import tempfile

        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="streamcharts-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint root."""
    return os.path.join(checkpoint_root(spark), f"{name}-{uuid.uuid4().hex[:12]}")
