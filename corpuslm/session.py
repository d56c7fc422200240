"""Spark session helpers shared by the jobs, tests and the bench."""

from __future__ import annotations

import gc
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_spark(master: str | None = None, shuffle_partitions: int = 8,
              app: str = "corpuslm") -> SparkSession:
    """Create (or reuse) a session with the settings the jobs assume.

    AQE stays on: it coalesces the many small shuffle partitions of the
    per-round BPE jobs and splits skewed partitions of the word group-bys.
    """
    master = master or os.environ.get("CORPUSLM_MASTER", "local[8]")
    builder = (
        SparkSession.builder.master(master).appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("CORPUSLM_DRIVER_MEM", "16g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    prepare(spark)
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``corpuslm`` importable in the Python workers (Arrow helpers and
    ``mapInPandas`` nodes import it): zip the package on the driver once per
    application and hand it to ``addPyFile``, which Spark copies to every
    executor (the code, not data)."""
    import zipfile

    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg)
    zpath = os.path.join(tempfile.mkdtemp(prefix="corpuslm-code-"), "corpuslm.zip")
    with zipfile.ZipFile(zpath, "w") as z:
        for dirpath, _dirs, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(zpath)
    _SHIPPED.add(sc.applicationId)


def prepare(spark: SparkSession) -> str:
    """Everything a job needs from the session: the package on the workers
    and a checkpoint folder."""
    ship_package(spark)
    return ensure_checkpoint_dir(spark)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's shared ``spark.checkpoint.dir``; only a local
    session without one gets a private scratch folder (tests, bench)."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return configured
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a shared folder "
            "(HDFS/S3/ABFS) so checkpoints survive executor loss")
    path = tempfile.mkdtemp(prefix="corpuslm-ckpt-")
    sc.setCheckpointDir(path)
    return path


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that a job has written for itself, wherever it is stored."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def stored(df: DataFrame) -> DataFrame:
    """The rows of a frame, written to the shared folder as compressed columns and read back: a
    checkpoint of a fraction of the size.  The shuffle files that made them are let go; Spark deletes
    them only when the driver happens to collect its garbage."""
    spark = df.sparkSession
    path = f"{prepare(spark).rstrip('/')}/stored-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    release(spark)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Collect the driver's garbage, so that Spark deletes the shuffle files of plans that are done with."""
    gc.collect()
    spark._jvm.System.gc()
