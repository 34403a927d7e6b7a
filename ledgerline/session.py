"""Session helpers: building a local session for tests/bench, and the shared
folder (the cluster's checkpoint dir) used for lineage cuts and scratch output."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, shuffle_partitions: int = 8, app: str = "ledgerline") -> SparkSession:
    master = master or f"local[{os.environ.get('BENCH_CPUS', '8')}]"
    spark = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", os.environ.get("LEDGERLINE_DRIVER_MEMORY", "16g"))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.constraintPropagation.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint dir (``spark.checkpoint.dir``).

    The cluster names a shared folder there. Only a local-mode session without
    one (tests) gets a fresh temporary folder; a cluster session without one
    is an error, because a machine-local folder would not survive the loss of
    an executor.
    """
    conf = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - a Connect session has no SparkContext
        if conf:
            return conf
        raise RuntimeError("spark.checkpoint.dir must name a shared folder") from None
    current = sc.getCheckpointDir()
    if current:
        return current
    if conf:
        sc.setCheckpointDir(conf)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="ledgerline-ckpt-"))
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/scratch/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet under the shared checkpoint folder and read
    it back: later consumers share one computation (no recomputed scans or
    shuffles), lineage is cut for executor loss, and re-reads prune columns,
    nested struct fields included. The shuffle files of the write go with it, as nothing reads them again."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with shuffles_removed(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.parquet(path)


def drop_materialized(*frames: DataFrame) -> None:
    """Deletes tables written by ``materialize``, when nothing reads them any more."""
    for df in frames:
        spark = df.sparkSession
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def settings(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    """Inside, the session has these settings; afterwards its own again."""
    old = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Inside, Spark deletes a query's shuffle files when the query ends; else they stay until the driver's garbage collector finds the plan
    unused. For jobs that write a table after the other. A DataFrame that is itself computed twice inside would shuffle again."""
    with settings(spark, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}):
        yield


def plan_settings(spark: SparkSession) -> None:
    """Catalyst's constraint propagation enumerates alias combinations and
    takes minutes on plans with many derived text columns over the same
    inputs (as the description split produces). The filters it would infer
    here are IS NOT NULL tests that the plan does not need, so it is
    switched off for sessions that run these plans.

    The JVM never compiles a method of more than 8000 bytes, and these plans fuse into larger ones: such a stage then ran interpreted
    for every row. Above that size Spark shall evaluate it operator by operator, whose expressions it splits into small methods."""
    spark.conf.set("spark.sql.constraintPropagation.enabled", "false")
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")


def cleanup_scratch(spark: SparkSession) -> None:
    """Delete this application's scratch tables (``<checkpoint dir>/scratch``).
    Call when no DataFrame built on them is used any more (they are lazy over
    those files). The checkpoint dir of a SparkContext is its own subfolder,
    so other applications' data is untouched."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{base}/scratch")
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(path):
        fs.delete(path, True)
