"""Session helpers: a tuned local session for tests/bench and checkpoint handling."""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, shuffle_partitions: int = 8, app: str = "flowguard") -> SparkSession:
    """A session with AQE on (runtime broadcast, partition coalescing, skew-join splitting)."""
    builder = (
        SparkSession.builder.master(master or "local[*]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("FLOWGUARD_DRIVER_MEMORY", "16g"))
    )
    event_dir = os.environ.get("FLOWGUARD_EVENT_LOG_DIR")
    if event_dir:  # stage/task times for profiling, written to a scratch folder
        builder = builder.config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", event_dir)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Checkpoint folder named by the cluster (``spark.checkpoint.dir``).

    A folder of our own is set only when the session has none (local tests).
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (e.g. on HDFS/S3) before checkpointing")
        configured = tempfile.mkdtemp(prefix="flowguard-ckpt-")  # local mode (tests) only
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def path_exists(spark: SparkSession, path: str) -> bool:
    """Is there such a file or folder; a store that can't be asked raises."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def materialize(df: DataFrame, how: str = "cache") -> DataFrame:
    """Keep a DataFrame that several jobs read.

    ``cache``: memory+disk, recomputed from lineage if an executor is lost.
    ``checkpoint``: written to the shared checkpoint folder; cuts lineage.
    ``store``: written as Parquet below the checkpoint folder, where it takes less room than a cached
    table and its shuffles' files can go; :func:`discard` removes it.
    ``none``: recompute each time.
    """
    if how == "cache":
        return spread(df).persist()
    if how == "checkpoint":
        ensure_checkpoint_dir(df.sparkSession)
        return df.checkpoint(eager=True)
    if how == "store":
        return stored(df)
    if how == "none":
        return df
    raise ValueError(f"unknown materialize mode: {how}")


def stored(df: DataFrame) -> DataFrame:
    """``df`` written below the shared checkpoint folder and read again; its lineage ends there."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/flowguard-tables/{uuid.uuid4().hex}"
    with one_use_shuffles(spark):
        df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._flowguard_path = path
    return out


def discard(df: DataFrame) -> None:
    """Remove the files of a :func:`stored` table that nothing reads any more; other tables are left."""
    path = getattr(df, "_flowguard_path", None)
    if path:
        spark = df.sparkSession
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


@contextmanager
def one_use_shuffles(spark: SparkSession):
    """Shuffle files of the queries inside are removed when each query ends, not when the driver next
    collects garbage. For queries whose shuffles no later one reads, such as the epochs of a training."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``flowguard`` importable in executor Python workers (for ``mapInPandas`` steps).

    Zips the package in memory once per SparkContext, writes it into the cluster's shared
    checkpoint folder through the Hadoop FileSystem API and adds it with ``addPyFile``, as
    ``--py-files`` would.
    """
    import hashlib
    import io
    import zipfile

    sc = spark.sparkContext
    key = sc.applicationId
    if key in _SHIPPED:
        return
    import flowguard

    root = os.path.dirname(os.path.abspath(flowguard.__file__))
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        for base, _dirs, files in sorted(os.walk(root)):
            for f in sorted(files):
                if f.endswith(".py"):
                    full = os.path.join(base, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    data = buf.getvalue()
    folder = ensure_checkpoint_dir(spark).rstrip("/")
    uri = f"{folder}/flowguard-code/flowguard-{hashlib.sha1(data).hexdigest()[:12]}.zip"
    jvm = sc._jvm
    path = jvm.org.apache.hadoop.fs.Path(uri)
    fs = path.getFileSystem(sc._jsc.hadoopConfiguration())
    if not fs.exists(path):
        out = fs.create(path, True)
        out.write(bytearray(data))
        out.close()
    sc.addPyFile(uri)
    _SHIPPED.add(key)


def spread(df: DataFrame) -> DataFrame:
    """Give a DataFrame at least the default parallelism before it is kept and reread.

    A small input (a file of a few row groups) would otherwise run every later stage on a
    few cores. At cluster scale inputs have far more partitions than cores, so this is a
    no-op there.
    """
    sc = df.sparkSession.sparkContext
    plan = df._jdf.queryExecution().executedPlan().toString()
    if "Exchange" in plan or "AdaptiveSparkPlan" in plan:
        return df  # after a shuffle AQE already sizes the partitions; asking would run it
    n = df.rdd.getNumPartitions()  # scan-only plan: file splits, no job
    return df.repartition(sc.defaultParallelism) if n < sc.defaultParallelism else df


def row_cap_for_broadcast(spark: SparkSession, key: str = "flowguard.broadcast.maxRows", default: int = 1_000_000) -> int:
    """Row count up to which a measured side table is broadcast by hint."""
    return int(spark.conf.get(key, str(default)))
