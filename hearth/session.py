"""Session construction and shared-folder handling."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

# Defaults a user would set for this workload; anything already present in
# the cluster configuration wins.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def get_session(app: str = "hearth", master: str | None = None,
                conf: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**_DEFAULTS, **(conf or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    checkpoint_dir(spark)
    ship_package(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting points at shared storage and is only read.
    When it is unset (a local test session) a folder is created under the
    system temp dir and registered, so ``DataFrame.checkpoint()`` works. On
    any other master an unset folder is an error: executors and driver would
    each see a folder of their own.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
        current = sc._jsc.sc().getCheckpointDir()
    except Exception:  # a Connect session: the server owns the setting
        return path or ""
    if current.isDefined():
        return current.get()
    if not path:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="hearth-ckpt-")
    elif "://" not in path:
        os.makedirs(path, exist_ok=True)
    sc.setCheckpointDir(path)
    return path


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new path, ``data`` in a folder of its own under the shared checkpoint
    folder. The folder is made here, as only what exists can be registered for
    removal, and goes when the application ends."""
    folder = f"{checkpoint_dir(spark).rstrip('/')}/tables/{name}_{uuid.uuid4().hex}"
    sc = spark.sparkContext
    where = sc._jvm.org.apache.hadoop.fs.Path(folder)
    fs = where.getFileSystem(sc._jsc.hadoopConfiguration())
    fs.mkdirs(where)
    fs.deleteOnExit(where)
    return f"{folder}/data"


def drop_at_exit(spark: SparkSession, table_name: str) -> None:
    """Drop a table of the catalog when the driver program ends, unless its
    session was stopped before."""
    def drop():
        if spark.sparkContext._jsc is not None:
            spark.sql(f"DROP TABLE IF EXISTS `{table_name}`")
    atexit.register(drop)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``hearth`` importable in the Python workers.

    Pandas UDFs and ``mapInPandas`` functions from this package are
    unpickled on the executors, which must be able to import it. The
    package is zipped once per SparkContext and added with ``addPyFile``,
    the same as ``--py-files`` on spark-submit; Spark's file server ships
    it to every executor. It is harmless where the package is installed.
    """
    try:
        sc = spark.sparkContext
        key = sc.applicationId
    except Exception:  # Connect: the server's environment provides the package
        return
    if key in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg_dir)
    out = os.path.join(tempfile.mkdtemp(prefix="hearth-py-"), "hearth.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as zf:
        for folder, _, files in os.walk(pkg_dir):
            for name in files:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    zf.write(full, os.path.relpath(full, root))
    sc.addPyFile(out)
    _SHIPPED.add(key)
