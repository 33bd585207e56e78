"""SparkSession helpers: a local session for tests/bench and the shared
checkpoint folder used to cut lineage."""

from __future__ import annotations

import functools
import gc
import os
import tempfile
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "contrail", extra: dict | None = None) -> SparkSession:
    """Local session for tests and the bench. On a cluster the caller's
    session is used as is; these settings are the ones we rely on."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "16g")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        # keyed streaming state (one row per aircraft) off the JVM heap
        .config("spark.sql.streaming.stateStore.providerClass",
                "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting names a shared, fault-tolerant folder and is
    only read here (unset on a cluster is an error: a machine-local folder
    would not survive executor loss). Only in local mode, when it is unset,
    a scratch folder is created and set.
    """
    current = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getConf().get(CHECKPOINT_CONF, None)
    if not current:
        current = spark.sparkContext.getCheckpointDir()
    if not current:
        master = spark.sparkContext.master or ""
        if not master.startswith("local"):
            raise RuntimeError(
                f"{CHECKPOINT_CONF} is not set: on a cluster it must name a shared folder "
                "(HDFS / object store) that every executor can read")
        current = tempfile.mkdtemp(prefix="contrail-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set(CHECKPOINT_CONF, current)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(current)
    return current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder name under the shared checkpoint folder."""
    import uuid

    return os.path.join(ensure_checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex}")


def delete_path(spark: SparkSession, path: str) -> None:
    """Recursively delete ``path`` on its file system (scratch clean-up)."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(jvm_path):
        fs.delete(jvm_path, True)


def release(spark: SparkSession) -> None:
    """Let go of the shuffle files of ended jobs. Spark drops them once the
    driver's JVM has collected the plans that name them, which a driver with
    much memory does late."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def cut_lineage(df: DataFrame, name: str = "stage", columnar: bool = True,
                base: str | None = None) -> DataFrame:
    """End the lineage of ``df`` with data in the shared checkpoint folder
    (it survives executor loss, unlike a cache or a local checkpoint).

    ``columnar=True``: written as parquet and read back with the known
    schema, so later readers prune columns and push filters into the files;
    for large intermediates that several consumers read in part.
    ``columnar=False``: a reliable RDD checkpoint; cheaper for small
    intermediates that are always read whole."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    if not columnar:
        return df.checkpoint(eager=True)
    path = scratch_path(spark, name) if base is None else os.path.join(base, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ship_code() -> None:
    """Pickle this package's functions by value, so Python workers run them
    without having the package installed (on a cluster or when the driver
    was started from elsewhere)."""
    import contrail
    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(contrail)


def input_bytes(spark: SparkSession, paths: list[str]) -> int:
    """Total size of the files under ``paths`` (Hadoop file system summary;
    no data is read)."""
    jvm = spark._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    total = 0
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        fs = path.getFileSystem(conf)
        if fs.exists(path):
            total += fs.getContentSummary(path).getLength()
    return int(total)


def scale_settings(total_input_bytes: int, total_cores: int,
                   target_partition_bytes: int = 128 << 20) -> dict[str, str]:
    """Runtime SQL settings sized to the input: shuffle partitions so that a
    partition holds about ``target_partition_bytes`` (at least 2 per core;
    AQE coalesces small ones and splits skewed ones at run time), scan
    splits of the same size, and skew thresholds relative to it."""
    parts = max(2 * total_cores, -(-total_input_bytes // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
        "spark.sql.session.timeZone": "UTC",
    }


def apply_scale_settings(spark: SparkSession, paths: list[str], total_cores: int | None = None) -> dict[str, str]:
    """Size the session for the inputs under ``paths`` (see :func:`scale_settings`)."""
    cores = total_cores or spark.sparkContext.defaultParallelism
    settings = scale_settings(input_bytes(spark, paths), cores)
    for k, v in settings.items():
        spark.conf.set(k, v)
    return settings


@contextmanager
def session_conf(spark: SparkSession, settings: dict[str, str]):
    """Set runtime SQL settings for a block and restore the caller's values."""
    old = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def in_utc(fn):
    """Run ``fn`` with the session time zone of its first DataFrame or
    session set to UTC. Time-zone-dependent expressions take the zone when
    their plan is made, so frames that ``fn`` returns keep UTC whatever the
    caller's zone is."""
    @functools.wraps(fn)
    def run(*args, **kw):
        for a in (*args, *kw.values()):
            spark = a if hasattr(a, "newSession") else getattr(a, "sparkSession", None) \
                or getattr(getattr(a, "aircraft", None), "sparkSession", None)
            if spark is not None:
                with session_conf(spark, {"spark.sql.session.timeZone": "UTC"}):
                    return fn(*args, **kw)
        return fn(*args, **kw)
    return run


def stateful_settings(spark: SparkSession, total_input_bytes: int) -> dict[str, str]:
    """Settings a stateful stream fixes at its first start: state partitions
    sized to the input (>= 2 per core, ~128 MB each) and the RocksDB state
    store (state off the JVM heap)."""
    cores = spark.sparkContext.defaultParallelism
    parts = max(2 * cores, -(-total_input_bytes // (128 << 20)))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    }
