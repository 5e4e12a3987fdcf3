"""Spark session defaults shared by the library, the tests and the bench."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import SparkSession

# Settings the library relies on: ANSI casts (bad values raise, like the
# warehouse the data comes from), UTC timestamps, adaptive execution.
DEFAULTS = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # size shuffle partitions by bytes, not by core count (fewer tiny tasks
    # on a busy cluster; large stages still split at the advisory size)
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    # checkpoint files of a run are removed once nothing references them
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, app: str = "metamart",
              shuffle_partitions: int | None = None,
              extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in DEFAULTS.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the setting names a shared folder and is used as is.  Only
    when it is unset a scratch folder is created and set, on a local master alone.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        current = tempfile.mkdtemp(prefix="metamart-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(current)
    return current
