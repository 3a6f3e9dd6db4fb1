"""Session helpers: a tuned local session for tests, the shared checkpoint folder, spreading of small inputs."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "pricelake") -> SparkSession:
    """Session for tests and the local benchmark. On a cluster, use the session the platform gives you."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("PRICELAKE_DRIVER_MEMORY", "16g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the platform sets it to shared storage and it is used as is; a cluster without it is an error. Only a
    session whose executors are threads of the driver (``local``, as in tests) gets a scratch folder.
    """
    conf = spark.sparkContext.getConf()
    current = conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        spark.sparkContext.setCheckpointDir(current)
        return current
    if not spark.sparkContext.master.split("[")[0] == "local":
        raise ValueError("spark.checkpoint.dir must name a folder on shared storage")
    path = tempfile.mkdtemp(prefix="pricelake-ckpt-")
    spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (survives executor loss, unlike a local one)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder below ``spark.checkpoint.dir`` (shared storage), deleted when the driver's JVM ends."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)  # noqa: SLF001
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(folder)  # noqa: SLF001
    return path


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared checkpoint folder and read back. Unlike after :func:`cut_lineage`, the planner
    knows the table's size, so that a small one is broadcast before anything is shuffled to meet it."""
    path = scratch_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """For CPU-heavy row work on an input with fewer splits than task slots (a file with one row group is read by one
    task): hash-partitions it by ``keys`` (deterministic on retry), or round-robin. An input of as many splits as slots
    stays as it is, so this adds no shuffle at scale; results never depend on it."""
    slots = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= slots:
        return df
    return df.repartition(slots, *keys) if keys else df.repartition(slots)
