"""SparkSession construction and cluster-facing settings."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings the library relies on.  AQE re-plans joins from real shuffle sizes (broadcast
# conversion is then a checked decision, not a guess), coalesces small partitions and
# splits skewed ones; the session time zone is pinned so hour/day extraction is stable.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
}


def build_session(
    master: str | None = None,
    shuffle_partitions: int | None = None,
    app_name: str = "cinemetric",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or fetch) a session with the library's settings.

    On a cluster, call with ``master=None`` and leave ``spark.checkpoint.dir`` to the
    cluster configuration; a local scratch checkpoint folder is only chosen when the
    setting is absent (tests, laptops).
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in SCALE_CONF.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    The cluster's setting always wins.  Only when it is unset in local mode (tests) is a fresh
    scratch folder created and registered; on a cluster an unset setting is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not spark.sparkContext.master.startswith("local"):
            # a machine-local folder would not survive the loss of the executor that wrote it
            raise RuntimeError("set spark.checkpoint.dir to a shared folder for cluster runs")
        configured = tempfile.mkdtemp(prefix="cinemetric-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(configured)
    return configured


def stream_checkpoint(spark: SparkSession, name: str) -> str:
    """Checkpoint location for a streaming query, under the shared checkpoint folder."""
    return os.path.join(checkpoint_dir(spark), "streams", name)
