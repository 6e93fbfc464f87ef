"""Session construction and the shared scratch location.

On a cluster the shared folder is whatever ``spark.checkpoint.dir`` names
(HDFS, S3A, ...).  Only when a session has none (unit tests, a bare
local session) do we create one, with ``tempfile`` on the local disk.
"""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Arrow batch size for mapInPandas (the distributed rank); block kernels get one block pair per call
    "spark.sql.execution.arrow.maxRecordsPerBatch": "10000",
    # delete checkpoint files once nothing references them (long-running jobs re-snapshot)
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.sql.streaming.forceDeleteTempCheckpointLocation": "true",
}


def build_session(
    master: str | None = None,
    app_name: str = "tasteflow",
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the settings the operators assume.

    ``shuffle_partitions`` should be sized to the data: roughly total
    shuffle bytes / 128 MB at scale, about 2x the cores locally.  AQE
    coalesces small partitions and splits skewed ones at run time.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    shared_dir(spark)
    return spark


def _checkpoint_root(spark: SparkSession) -> str | None:
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    return spark.sparkContext.getCheckpointDir()


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """Return a path under the cluster's shared checkpoint folder.

    Reads ``spark.checkpoint.dir`` from the session.  If it is unset, a local
    master (tests, ad-hoc sessions) gets a temporary folder registered as the
    checkpoint dir; any other master raises, because its executors would not
    see the driver's disk.
    """
    root = _checkpoint_root(spark)
    if not root:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError(f"set spark.checkpoint.dir to a folder that every node of {master} sees")
        root = tempfile.mkdtemp(prefix="tasteflow-ckpt-")
        spark.sparkContext.setCheckpointDir(root)
    elif spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    root = root.rstrip("/")
    return "/".join([root, *parts]) if parts else root


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh, never reused folder under the shared location for one run."""
    return shared_dir(spark, "tasteflow", f"{label}-{uuid.uuid4().hex[:12]}")


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme so Python can touch a local path (tests only)."""
    if path.startswith("file:"):
        path = path[len("file:"):]
        while path.startswith("//"):
            path = path[1:]
    return os.path.abspath(path)


def ship_package(spark: SparkSession) -> None:
    """Give every executor this package, zipped, when it is not installed there."""
    package = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="tasteflow-ship-"), "tasteflow")
    path = shutil.make_archive(archive, "zip", os.path.dirname(package), os.path.basename(package))
    spark.sparkContext.addPyFile(path)


def checkpointed(df):
    """``df.checkpoint()`` into the shared folder (created only when the session names none)."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
