"""Session helpers and the shared scratch folder."""

from __future__ import annotations

import atexit
import os
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"
_scratch: list[tuple[SparkSession, str]] = []


def get_spark(app: str = "lakeops", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings every job here relies on.

    Shuffle partition counts are left to the cluster and to AQE; pass
    ``**{"spark.sql.shuffle.partitions": "8"}`` for small local data.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it.

    A session without that setting is an error, unless its master is ``local``:
    there the driver is the only machine, and the warehouse folder will do.
    """
    root = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError(f"set {CHECKPOINT_KEY} to a folder that all executors share")
        root = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root


def work_dir(spark: SparkSession, name: str) -> str:
    """A new, unused folder below the shared root, removed when the application ends."""
    path = os.path.join(shared_root(spark), "lakeops", f"{name}-{uuid.uuid4().hex[:12]}")
    if not _scratch:
        atexit.register(_remove_scratch)
    _scratch.append((spark, path))
    return path


def _remove_scratch() -> None:
    """Remove the folders of this application; a session that has ended leaves them."""
    for spark, path in _scratch:
        try:
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
        except Exception:
            return


def checkpointed(df):
    """Reliable checkpoint: later branches re-read these rows, not the plan."""
    shared_root(df.sparkSession)
    return df.checkpoint(eager=True)
