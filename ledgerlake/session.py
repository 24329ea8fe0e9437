"""Session helpers for tests, the bench and local runs.

Library operators never create a session; callers pass their own. These helpers
only exist so tests and the bench share one sensible local configuration.
"""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

# Settings every run of this library assumes (ANSI on is Spark 4's default; the
# code uses try_* functions on dirty input instead of depending on it).
BASE_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even where the aggregate above would reuse the join's partitioning (dedupe by key): one
    # more shuffle of the split rows, instead of one task with the whole key.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "ledgerlake",
                  extra: dict[str, str] | None = None) -> SparkSession:
    """A ``local[cores]`` session with the library's base settings. ``extra`` may name ``spark.checkpoint.dir``."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", os.environ.get("LEDGERLAKE_DRIVER_MEMORY", "8g"))
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint directory.

    ``spark.checkpoint.dir`` is used as is. Where it is unset, a local session takes a folder of its warehouse directory;
    on a cluster that could be one machine's own folder, so it must be set there.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: no SparkContext here; the server's setting applies
        current = spark.conf.get("spark.checkpoint.dir", None)
        if not current:
            raise RuntimeError("spark.checkpoint.dir is not set on the Spark Connect server")
        return current
    if not sc.getCheckpointDir():
        configured = sc.getConf().get("spark.checkpoint.dir", None)
        if not configured and sc.master.split("[")[0] != "local":
            raise RuntimeError("spark.checkpoint.dir is not set: name a folder that all machines share")
        sc.setCheckpointDir(configured or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_checkpoints")
    return sc.getCheckpointDir()
