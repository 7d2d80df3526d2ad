"""Session settings shared by tests, bench and queries."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def get_spark(master: str | None = None, shuffle_partitions: int = 8,
              app: str = "tempora") -> SparkSession:
    """Session with the settings every operator assumes.

    * ``spark.sql.session.timeZone=UTC`` — all stored times are UTC; local
      wall-clock (Europe/Paris calendar) is always derived, never stored.
    * AQE on (coalesce + skew join) so shuffle partition counts adapt at
      runtime and hot keys in joins are split.
    * Off a local master shuffles start with at least 2,000 partitions, which
      AQE then merges to the advisory size (it never raises their number).
    * UI off: no server is opened.
    """
    master = master or os.environ.get("TEMPORA_MASTER", "local[*]")
    if not master.startswith("local"):
        shuffle_partitions = max(shuffle_partitions, 2000)
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # partition sizing: AQE coalesces / splits shuffle partitions toward the
        # advisory size, scans split files at the same granularity
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes",
                os.environ.get("TEMPORA_PARTITION_BYTES", "128m"))
        .config("spark.sql.files.maxPartitionBytes", os.environ.get("TEMPORA_PARTITION_BYTES", "128m"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("TEMPORA_DRIVER_MEMORY", "12g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder.

    On a cluster this is the shared folder named by ``spark.checkpoint.dir``;
    we only read it, and it is an error if it is unset there: a folder of the
    driver's machine can't be seen by executors.  With a local master we
    create a scratch folder once and register it.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return sc.getCheckpointDir()
    if not (sc.master == "local" or sc.master.startswith("local[")):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    path = tempfile.mkdtemp(prefix="tempora-ckpt-")
    sc.setCheckpointDir(path)
    spark.conf.set("spark.checkpoint.dir", path)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for written tables."""
    base = checkpoint_dir(spark)
    return base.rstrip("/") + "/tables/" + name


def materialize(df, name: str):
    """Write ``df`` as Parquet under the shared checkpoint folder and read it
    back: cuts lineage and makes every later consumer (bounds, block
    summaries, joins) read the small written table instead of re-scanning
    the raw source.  Survives executor loss (no local checkpoint).
    :func:`release` frees it once nothing reads it any more."""
    import uuid
    spark = df.sparkSession
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")
    df.write.mode("overwrite").parquet(path)
    out = spark.read.parquet(path)
    out._written = path
    return out


def release(*frames) -> None:
    """Delete the tables behind frames that :func:`materialize` returned;
    other frames are left alone.  Only for tables whose readers have run."""
    for df in frames:
        path = getattr(df, "_written", None)
        if path:
            p = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(p, True)
