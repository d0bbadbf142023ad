"""Session helpers: configuration for the scale we target, and the shared scratch folder.

Nothing here changes query semantics.  The builders never read session state except
``spark.checkpoint.dir`` (shared scratch folder for sinks and lineage cuts) and they are written
to be independent of ``spark.sql.session.timeZone``.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings a production job would carry.  Shuffle partitions are sized per deployment; the
# defaults below suit local[8] tests and are overridden by spark-submit on a cluster.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # keep generated methods under the JIT's size limit; larger ones run interpreted
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.ui.enabled": "false",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "headway", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(SCALE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.sql.session.timeZone"] = "UTC"
    conf["spark.driver.memory"] = "8g"
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the session.

    On a cluster ``spark.checkpoint.dir`` points at shared storage and is used as is.  Only when it
    is unset (local tests, the smoke driver) do we set one of our own.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        current = spark.sparkContext.getCheckpointDir()
    if not current:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        current = tempfile.mkdtemp(prefix="headway-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
        spark.sparkContext.setCheckpointDir(current)
    elif not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(current)
    return current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint folder (never a machine-local temp dir
    when the cluster names one)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/headway-{name}-{uuid.uuid4().hex[:12]}"


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``headway`` importable on executors (Python workers) for the few Arrow/pandas steps.

    On a cluster this is what ``--py-files`` does; doing it from the session keeps jobs launchable
    from any driver.  The archive goes to the shared scratch folder.
    """
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    import shutil

    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    target = scratch_path(spark, "pyfiles")
    if target.startswith("file:"):                     # a shared folder that every machine has mounted
        target = "/" + target.removeprefix("file:").lstrip("/")
    if "://" in target:
        # shared storage is not writable with Python file I/O: build the archive on the driver;
        # addPyFile serves it to every executor through Spark's own file server
        target = tempfile.mkdtemp(prefix="headway-pyfiles-")
    os.makedirs(target, exist_ok=True)
    archive = shutil.make_archive(os.path.join(target, "headway"), "zip",
                                  root_dir=os.path.dirname(pkg_dir), base_dir="headway")
    spark.sparkContext.addPyFile(archive)
    _SHIPPED.add(app)
