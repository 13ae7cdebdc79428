"""Session settings and shared folders.

The library never guesses a machine-local folder on a cluster: every file it
writes (landing drops, warehouse tables, streaming checkpoints, lineage cuts)
goes below the folder the cluster names in ``spark.checkpoint.dir``. Only when
that setting is missing (a laptop, a test) does :func:`get_session` pick one.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# SQL settings the operators rely on for correct results (not tuning).
REQUIRED_CONF = {
    # Trade dates, epoch conversions and the news calendar are UTC everywhere.
    "spark.sql.session.timeZone": "UTC",
    # Re-running a load replaces the partitions it writes, never the table.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}

# A table's folder is listed by so many tasks at most: Spark's default is one for each day's folder, which costs more than
# the listing. Left as it is where a session has chosen a number.
LISTING_TASKS, LISTING_DEFAULT = "spark.sql.sources.parallelPartitionDiscovery.parallelism", "10000"

# Settings that make the plans scale; applied when the library builds the session.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    # Runtime broadcast decisions are taken on measured shuffle sizes (AQE) against
    # Spark's default bound (10 MB, compressed): a larger bound let a side whose hash
    # table expands well past its shuffle size exhaust the driver at 10x test data.
    "spark.sql.files.maxPartitionBytes": "128MB",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.optimizer.dynamicPartitionPruning.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "candleworks", driver_memory: str | None = None) -> SparkSession:
    """Build (or reuse) a session with the library's settings. ``driver_memory``
    only takes effect when this call starts the JVM (local runs)."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    if driver_memory:
        builder = builder.config("spark.driver.memory", driver_memory)
    builder = builder.config("spark.ui.enabled", "false")
    for k, v in {**REQUIRED_CONF, **SCALE_CONF}.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings results depend on to an existing session."""
    for k, v in REQUIRED_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    if spark.conf.get(LISTING_TASKS, None) in (None, LISTING_DEFAULT):
        spark.conf.set(LISTING_TASKS, str(max(32, 4 * spark.sparkContext.defaultParallelism)))
    shared_dir(spark)
    return spark


def share_package(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it, if they run where that
    folder exists (one machine, a shared mount); else it is installed there."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, root])


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder (set one only where it is unset)."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        # Tests and laptops only.
        configured = tempfile.mkdtemp(prefix="candleworks-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, *parts: str, unique: bool = False) -> str:
    """A path below the shared folder; ``unique`` adds a fresh run id."""
    base = shared_dir(spark).rstrip("/")
    # The checkpoint dir has a per-application uuid leaf; keep our data beside it
    # so that it survives a restarted application with the same shared root.
    root = base.rsplit("/", 1)[0] if _looks_like_app_leaf(base) else base
    path = "/".join([root, "candleworks", *parts])
    if unique:
        path = f"{path}/{uuid.uuid4().hex}"
    return path


def _looks_like_app_leaf(path: str) -> bool:
    leaf = path.rsplit("/", 1)[-1]
    try:
        uuid.UUID(leaf)
        return True
    except ValueError:
        return False


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through Spark's file system layer (works on any store)."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(hpath))


def rename_path(spark: SparkSession, src: str, dst: str) -> bool:
    """Atomic directory rename on the shared store ("write beside, then swap")."""
    jvm = spark.sparkContext._jvm
    s = jvm.org.apache.hadoop.fs.Path(src)
    d = jvm.org.apache.hadoop.fs.Path(dst)
    fs = s.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(d):
        return False
    parent = d.getParent()
    if parent is not None and not fs.exists(parent):
        fs.mkdirs(parent)
    return bool(fs.rename(s, d))


def set_mtime(spark: SparkSession, path: str, millis: int) -> None:
    """Set a file's modification time (landing drops keep their day order)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.setTimes(p, int(millis), -1)

