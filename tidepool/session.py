"""Session defaults and the shared work folder.

The pipeline depends on these session settings:
UTC session time zone (date keys are taken from timestamps), ANSI mode
(a bad value must abort a staging load, and integer overflow must raise),
and adaptive execution (skew-join splitting, partition coalescing).

Broadcast policy: a join side is broadcast only when its size is known -
either proven by construction (explicit hints: the calendar, hash slots, hot
keys) or measured at runtime by AQE on the materialised shuffle output. The static planner's estimate from file sizes (compressed
bytes, not what the side occupies in memory) is not used.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": "-1",                       # no estimate-based broadcasts
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(10 * 1024 * 1024),   # measured at runtime
}


def configure(spark: SparkSession) -> SparkSession:
    """Pin the settings the pipeline's semantics rely on."""
    for key, value in REQUIRED_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


# Partition sizing: a shuffle partition should hold ~256 MB of input-equivalent
# data so a reducer's share fits executor memory (spilling beyond that), and
# never fewer than a few partitions per core. AQE coalesces the small ones.
TARGET_PARTITION_BYTES = 256 * 1024 * 1024
SIZING_KEYS = ("spark.sql.adaptive.coalescePartitions.initialPartitionNum", "spark.sql.files.maxPartitionBytes",
               "spark.sql.shuffle.partitions")


def size_for(spark: SparkSession, input_bytes: int, target_bytes: int = TARGET_PARTITION_BYTES) -> dict[str, str]:
    """Set and return the partition settings for a job over ``input_bytes`` of input.

    * shuffle partitions (and AQE's initial number) = input / ``target_bytes``, at least
      4 x cores and without a ceiling - AQE coalesces down to the advisory size;
    * scan splits of ``target_bytes``.

    The settings replace what the session has; a caller that wants its own leaves this out
    (``jobs.run_pipeline(..., sizing=False)``). For 100 TB at 256 MB these are 409,600
    partitions; a larger target gives fewer.
    """
    cores = max(1, spark.sparkContext.defaultParallelism)
    partitions = max(4 * cores, -(-int(input_bytes) // target_bytes))
    wanted = dict(zip(SIZING_KEYS, (str(partitions), str(target_bytes), str(partitions))))
    for key, value in wanted.items():
        spark.conf.set(key, value)
    return wanted


def build_session(master: str = "local[*]", app: str = "tidepool",
                  shuffle_partitions: int = 8, extra: dict | None = None) -> SparkSession:
    """Local/test session builder. On a cluster, the cluster's own session is used."""
    builder = (
        SparkSession.builder.master(master).appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # call-site capture on every Column call: error context only, costs Py4J round trips
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in {**REQUIRED_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def shared_dir(spark: SparkSession) -> str:
    """The cluster-shared folder named by ``spark.checkpoint.dir``.

    Read from the session. Only when it is unset and the master is local (tests) do we
    create one and register it, so checkpoint() and our written tables land in
    the same place. On a cluster an unset folder is an error: executors would write to
    their own disks.
    """
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not path:
        path = sc.getCheckpointDir()
    if not path:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise RuntimeError("spark.checkpoint.dir is not set: it must name a folder that all executors share")
        path = tempfile.mkdtemp(prefix="tidepool-ckpt-")
        sc.setCheckpointDir(path)
        spark.conf.set("spark.checkpoint.dir", path)
    return path


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh, unique sub-folder of the shared folder (never reused)."""
    base = shared_dir(spark).rstrip("/")
    return "/".join([base, "tidepool", *parts, uuid.uuid4().hex])


def local_path(path: str) -> str:
    """Strip a file: scheme for local-only helpers (tests)."""
    return path[len("file:"):] if path.startswith("file:") else path


__all__ = ["configure", "build_session", "shared_dir", "scratch_path", "local_path"]
