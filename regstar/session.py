"""Session helpers: building a local session and locating the checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that matter for these jobs; on a cluster they come from the cluster.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "regstar",
                  extra: dict | None = None) -> SparkSession:
    """A local session for tests and the bench (never used on a cluster)."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = os.environ.get("REGSTAR_DRIVER_MEMORY", "8g")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _is_local(spark: SparkSession) -> bool:
    master = spark.conf.get("spark.master", None) or ""
    return master.startswith("local")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster (``spark.checkpoint.dir``).

    Only a local-mode session without that setting gets its own folder, so
    tests can run; a cluster session without it is a configuration error,
    because a machine-local folder would not survive the loss of an executor.
    Works on classic sessions (sets the SparkContext's folder too) and on
    Spark Connect sessions (path only).
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect has no SparkContext
        sc = None
    if sc is not None and sc.getCheckpointDir():
        return sc.getCheckpointDir()
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured and sc is not None:
        configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not _is_local(spark):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder before running on a cluster")
        configured = tempfile.mkdtemp(prefix="regstar-ckpt-", dir=os.environ.get("REGSTAR_SCRATCH", "/tmp"))
    if sc is None:
        return configured
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder, for intermediate tables."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def shuffled(df):
    """``df`` as a side of a join that grows with the data: the join shuffles it.

    Spark judges a stored table by its compressed files, so one of a few MB, a
    million rows, would be collected by the driver and sent to every executor.
    """
    return df.hint("merge")


def materialize(df, name: str):
    """Write ``df`` as parquet under the shared checkpoint folder and read it back.

    Cuts the lineage at a durable copy: later stages read it instead of
    recomputing, and a lost executor does not lose it.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)
