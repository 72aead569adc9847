"""Session construction and the shared work folder.

The work folder is where jobs cut lineage (checkpoint) or land intermediate
tables.  On a cluster it must be a shared file system, so it is read from
``spark.checkpoint.dir``.  Only a local-mode session (tests, bench) may fall
back to a fresh folder of its own.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    # Coalescing aims at parallelism first, down to this size per partition.
    # Large shuffles never reach it; small ones that feed CPU-heavy steps
    # (masking, substring grams) keep more than a couple of tasks.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "256k",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.showConsoleProgress": "false",
    # Runs of many definitions put each in a pool of its own (plans.runs).
    "spark.scheduler.mode": "FAIR",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Broadcasts keep Spark's default size check (10 MB estimated); AQE
    # re-plans a shuffle join to a broadcast at runtime when a side turns
    # out small.
}


def build_session(master: str | None = None, app: str = "shiftkit",
                  shuffle_partitions: int | None = None,
                  conf: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with the settings the jobs assume."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.split("[")[0] == "local"


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Set from the session conf when present.  When it is unset, a local-mode
    session gets a fresh folder of its own; a cluster session raises, since a
    machine-local folder would not survive the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not _is_local(spark):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        configured = tempfile.mkdtemp(prefix="shiftkit-ckpt-")
    sc.setCheckpointDir(configured)
    return (sc.getCheckpointDir() or configured).rstrip("/")


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new, unique sub-folder of the checkpoint root for landed tables."""
    root = checkpoint_root(spark)
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``shiftkit`` importable in Python workers (``--py-files`` at runtime).

    Functions run by ``mapInPandas`` / ``applyInPandas`` are pickled by
    module reference, so every worker must be able to import the package.
    The package's sources are zipped once per application and added with
    ``addPyFile``; Spark distributes the archive to the executors.
    """
    import os
    import zipfile
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    base = os.path.dirname(pkg_dir)
    archive = os.path.join(tempfile.mkdtemp(prefix="shiftkit-pkg-"), "shiftkit.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for root, _, files in os.walk(pkg_dir):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, base))
    sc.addPyFile(archive)
    _SHIPPED.add(sc.applicationId)
