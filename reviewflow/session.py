"""Session construction and the shared scratch location.

Cluster jobs must not write to a machine-local temporary folder: every
intermediate table goes below ``spark.checkpoint.dir`` (a shared file
system path named by the cluster).  Only when that setting is absent — a
laptop or a test run — do we pick a local folder ourselves.
"""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every flow assumes (timestamps are rendered in UTC; AQE re-plans
# joins and coalesces small shuffle partitions at run time).
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # pandas-UDF scorers receive whole review texts: a batch is bounded in
    # records and in bytes, which keeps a Python worker small for long texts
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20),
    # a landing has a folder a city: Spark lists folders in a task each, up to
    # 10,000, and every task's result goes to the driver; fewer tasks list
    # many folders each and send the driver little beside the files' names
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "64",
    "spark.ui.enabled": "false",
}


def get_session(master: str | None = None, app_name: str = "reviewflow",
                shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings the library relies on."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint directory, choosing a local one only if none is set.

    The cluster's ``spark.checkpoint.dir`` (applied by SparkContext at start)
    wins.  Only when it is absent and Spark runs in one process (``local``
    master: a laptop or a test run) do we create a local folder; it is
    removed when the process ends.  On a cluster the executors would not see
    such a folder, so there the setting is required.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="reviewflow-ckpt-")
        atexit.register(shutil.rmtree, configured, ignore_errors=True)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables (landing documents, staged batches)."""
    return ensure_checkpoint_dir(spark)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, run-unique path below the checkpoint root."""
    return os.path.join(checkpoint_root(spark), f"{name}-{uuid.uuid4().hex[:12]}")


def spread(df, min_partitions: int | None = None):
    """Round-robin a frame over the cluster's cores when its scan yields fewer splits.

    A file stored as one row group is read by one task, and every per-row
    expression before the first shuffle (regex splits, md5 picks, template
    fills) then runs on one core.  When the input already has at least
    ``min_partitions`` splits — the normal case for large tables — this is
    a no-op and adds no shuffle.

    For frames that only scan files: the splits are estimated from the file
    index (files, and bytes per split), which plans nothing and runs no job.
    """
    spark = df.sparkSession
    target = min_partitions or spark.sparkContext.defaultParallelism
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    per_split = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    if max(len(df._jdf.inputFiles()), size // per_split) >= target:
        return df
    return df.repartition(target)


def clear_scratch(spark: SparkSession, name: str | None = None) -> None:
    """Delete this application's intermediate tables (all, or those whose name starts with ``name``).

    For the end of a job: frames that still read such a table stop working.
    """
    jvm, root = spark.sparkContext._jvm, checkpoint_root(spark)
    path = jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for status in fs.listStatus(path):
        own = status.getPath().getName()
        if own != "pyfiles" and own.startswith(name or ""):
            fs.delete(status.getPath(), True)


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``reviewflow`` importable in executor Python workers (pandas UDFs).

    Zips the package once per SparkContext into the shared checkpoint folder
    (through the Hadoop FileSystem API, so any shared file system works) and
    registers it with ``addPyFile``; Spark then puts it on every Python
    worker's path.  Harmless when the package is installed on the executors
    already.
    """
    import hashlib
    import io
    import zipfile

    sc = spark.sparkContext
    key = sc.applicationId
    if key in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    files = []
    for root, _dirs, names in os.walk(pkg_dir):
        if "__pycache__" in root:
            continue
        files += [os.path.join(root, n) for n in sorted(names) if n.endswith(".py")]
    files.sort()
    digest = hashlib.sha1()
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        for f in files:
            with open(f, "rb") as fh:
                data = fh.read()
            digest.update(f.encode() + data)
            info = zipfile.ZipInfo(os.path.relpath(f, os.path.dirname(pkg_dir)), date_time=(2020, 1, 1, 0, 0, 0))
            z.writestr(info, data, zipfile.ZIP_DEFLATED)
    target = f"{checkpoint_root(spark).rstrip('/')}/pyfiles/reviewflow-{digest.hexdigest()[:12]}.zip"
    jvm = sc._jvm
    path = jvm.org.apache.hadoop.fs.Path(target)
    fs = path.getFileSystem(sc._jsc.hadoopConfiguration())
    if not fs.exists(path):
        tmp = jvm.org.apache.hadoop.fs.Path(target + f".{uuid.uuid4().hex[:8]}.part")
        out = fs.create(tmp, True)
        out.write(bytearray(buf.getvalue()))
        out.close()
        if not fs.rename(tmp, path) and not fs.exists(path):
            raise OSError(f"could not publish {target}")
    sc.addPyFile(target)
    _SHIPPED.add(key)
