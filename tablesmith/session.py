"""Session helpers.

On a cluster the session is given: we only read ``spark.checkpoint.dir`` from it. Tests and the bench build a
local session and name a scratch checkpoint folder only when the setting is unset.
"""

from __future__ import annotations

import os
import re
import tempfile
import zipfile

from pyspark.sql import SparkSession

_SHIPPED: set[str] = set()

LOCAL_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # checkpointed stage tables are removed once their DataFrame is garbage-collected
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app: str = "tablesmith", extra: dict | None = None) -> SparkSession:
    """Return the active session, or build a local one for tests and the bench."""
    active = SparkSession.getActiveSession()
    if active is not None:
        ensure_checkpoint_dir(active)
        return active
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = SparkSession.builder.master(master or f"local[{cpus}]").appName(app)
    conf = dict(LOCAL_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions or cpus)
    conf["spark.driver.memory"] = os.environ.get("TABLESMITH_DRIVER_MEMORY", "16g")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's ``spark.checkpoint.dir``.

    Only a ``local`` master (tests, the bench) without the setting gets a scratch folder of its own: there the
    driver and the executor are one process. On any other master an unset folder is an error, because a
    machine-local one would not be seen by the other executors.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if not re.match(r"local(\[|$)", sc.master):
        raise RuntimeError("spark.checkpoint.dir is not set: name a folder that driver and executors share")
    path = tempfile.mkdtemp(prefix="tablesmith-ckpt-", dir="/tmp")
    sc.setCheckpointDir(path)
    return path


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers, once per application.

    Functions that run in the workers are pickled by reference to their module, so the workers must be able to
    import it whatever folder the driver was started from.
    """
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    target = os.path.join(tempfile.mkdtemp(prefix="tablesmith-py-"), "tablesmith-package.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, files in os.walk(os.path.join(root, "tablesmith")):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(target)
    _SHIPPED.add(sc.applicationId)


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and stage tables (cluster-named; scratch only in local tests)."""
    return ensure_checkpoint_dir(spark)


def stage_path(spark: SparkSession, name: str) -> str:
    """A path below the shared checkpoint folder for a written stage table."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/tables/{name}"
