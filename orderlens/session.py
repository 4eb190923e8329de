"""Session construction and shared-folder resolution."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every session of ours wants; applied only where the caller has not set them.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def get_session(master: str = "local[8]", shuffle_partitions: int = 8, app: str = "orderlens") -> SparkSession:
    """Local session for tests and benches. On a cluster, build the session there and pass it in."""
    builder = SparkSession.builder.master(master).appName(app)
    for k, v in DEFAULTS.items():
        builder = builder.config(k, v)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", os.environ.get("ORDERLENS_DRIVER_MEMORY", "16g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    The cluster's setting always wins. Only a local master may do without: it gets a fresh
    folder under the system temp dir, which goes when this process ends. On a cluster such
    a folder would lie on each machine's own disk, so an unset setting is an error there.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    if configured:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(configured)
        return configured
    existing = sc.getCheckpointDir()
    if existing:
        return existing
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    local = tempfile.mkdtemp(prefix="orderlens-ckpt-")
    atexit.register(shutil.rmtree, local, ignore_errors=True)
    spark.conf.set("spark.checkpoint.dir", local)
    sc.setCheckpointDir(local)
    return local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused folder for written outputs (round trips, saved models).

    It lives next to the checkpoint folder, so on a cluster it is on shared storage.
    """
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/orderlens-out/{name}-{uuid.uuid4().hex}"
