"""Spark session helpers.

The library never decides where durable state lives on a cluster: streaming
checkpoints and lineage cuts go under ``spark.checkpoint.dir``, which the
cluster sets to a shared folder.  Only when that setting is absent (local
tests) do we pick a fresh scratch folder ourselves.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"

# Arrow batches end at so many bytes: what workers and executors hold of long texts follows neither the count of rows
# in a batch nor the texts' length.  A value that the user has set stays.
ARROW_BYTES_CONF, ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "4m"

# Settings every session built by this library carries.  They are all
# standard Spark options; none changes query results.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Python workers talk to the JVM over a socket file, not a TCP port.
    "spark.python.unix.domain.socket.enabled": "true",
    # transformWithState needs the RocksDB state store; commits write a
    # changelog instead of a full snapshot per batch.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app_name: str = "tributary", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the library defaults.

    On a cluster, call with ``master=None`` so spark-submit decides, and size
    ``shuffle_partitions`` to the data (AQE coalesces small ones anyway).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if master and master.startswith("local"):
        # local mode runs every task inside the driver JVM
        conf["spark.driver.memory"] = "12g"
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    prepare(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder (a path or a URI).

    On a cluster ``spark.checkpoint.dir`` must name a folder all executors
    share.  Only a local master, where driver and tasks are one process, gets
    a folder of our own when the setting is absent.
    """
    current = spark.conf.get(CHECKPOINT_CONF, None)
    if not current:
        master = spark.conf.get("spark.master", "") or ""
        if not re.fullmatch(r"local(\[[^\]]*\])?", master):
            raise ValueError(f"set {CHECKPOINT_CONF} to a folder that driver and executors share")
        current = tempfile.mkdtemp(prefix="tributary-ckpt-")
        spark.conf.set(CHECKPOINT_CONF, current)
    try:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(current)
    except Exception:  # noqa: BLE001 - no SparkContext on a remote (Connect) session
        pass
    return current


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{purpose}-{uuid.uuid4().hex}"


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable on executors (once per application).

    Python workers unpickle operator functions and stateful processors by
    module name, so the package is zipped on the driver and added with
    ``addPyFile``: Spark itself serves it to the executors, as it does for
    ``--py-files``.  Nothing is written to the shared folder for this.
    """
    try:
        sc = spark.sparkContext
        app = sc.applicationId
    except Exception:  # noqa: BLE001 - remote session: ship with --py-files / addArtifacts instead
        return
    if app in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    parent = os.path.dirname(root)
    target = os.path.join(tempfile.mkdtemp(prefix="tributary-pkg-"), "tributary.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, files in os.walk(root):
            for name in files:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, parent))
    sc.addPyFile(target)
    _SHIPPED.add(app)


def prepare(spark: SparkSession) -> SparkSession:
    """Checkpoint folder, bounded Arrow batches and the package on executors; safe to call often."""
    ensure_checkpoint_dir(spark)
    if spark.conf.get(ARROW_BYTES_CONF, None) is None:
        spark.conf.set(ARROW_BYTES_CONF, ARROW_BYTES)
    ship_package(spark)
    return spark
