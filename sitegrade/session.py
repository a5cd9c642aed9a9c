"""Session settings the operators count on, and the shared scratch folder."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import SparkSession

# Runtime settings, valid on any running session.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join even where that costs the next operator a shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # A run of many writes gives back each one's shuffle files when it ends, and does not hold all until the driver collects garbage.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    # Text that is no number fails; days begin at midnight UTC wherever the cluster stands.
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def scratch_root(spark: SparkSession, prefix: str = "sitegrade") -> str:
    """A new folder under the shared checkpoint folder, removed when the driver's JVM ends.

    The folder is the one that ``spark.checkpoint.dir`` or ``setCheckpointDir``
    names.  Where neither does, a local session gets one beside the warehouse's
    tables; on a cluster that could be each machine's own disk, so it is an error.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.getCheckpointDir():
            if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
                raise RuntimeError("tables are stored on the way: set spark.checkpoint.dir to a folder that driver and executors share")
            spark.sparkContext.setCheckpointDir(f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/checkpoints")
        shared = spark.sparkContext.getCheckpointDir()
    folder = f"{shared.rstrip('/')}/{prefix}-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    return folder
