"""Shared storage locations.

On a cluster the shared folder is whatever ``spark.checkpoint.dir`` names;
it is read from the session and never replaced.  Only when it is unset (as
in local tests) a folder inside the session's warehouse directory is used,
which a cluster shares as well; never a machine-local temporary folder.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def shared_dir(spark: SparkSession) -> str:
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        d = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_marquee_shared"
    return d.rstrip("/")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Make ``df.checkpoint()`` usable, using the configured shared folder."""
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(shared_dir(spark))
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder for one run's outputs; what is
    written there goes when the driver's JVM ends."""
    path = f"{shared_dir(spark)}/marquee/{label}-{uuid.uuid4().hex[:12]}"
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(where.getParent())
    fs.deleteOnExit(where)
    return path
