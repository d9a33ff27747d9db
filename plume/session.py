"""SparkSession defaults and the shared work folder.

Everything time-based is computed in UTC; AQE stays on so that join strategy,
partition coalescing and skew splitting are decided at run time from real sizes.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A shuffle partition should hold ~128 MB after AQE coalescing; the initial
    # number is an upper bound that AQE shrinks on small inputs.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    # Checkpoints of rounds that nothing refers to any more are deleted.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "plume", driver_memory: str | None = "8g",
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with the engine defaults applied.

    ``driver_memory`` only takes effect when this call starts the JVM (local mode: the driver JVM also
    runs the tasks, and the 1 GB default leaves little room for shuffle and cached rounds).
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    if driver_memory:
        b = b.config("spark.driver.memory", driver_memory)
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    for k, v in DEFAULTS.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = b.getOrCreate()
    apply_defaults(spark)
    return spark


def apply_defaults(spark: SparkSession) -> None:
    """Pin the settings results depend on (time zone) on an existing session."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def work_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``; we read it from the
    session.  Only a local-mode session without one (tests, laptops) gets a
    fresh folder of its own.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if not d:
        d = spark.conf.get("spark.checkpoint.dir", None)
        if d:
            sc.setCheckpointDir(d)
            d = sc.getCheckpointDir()
    if not d:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder for this cluster")
        d = tempfile.mkdtemp(prefix="plume-ckpt-")
        sc.setCheckpointDir(d)
        d = sc.getCheckpointDir()
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path below the shared work folder."""
    base = work_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once below the shared work folder and read back: Parquet is a fraction of a checkpoint's rows
    where values repeat, as words and counts do."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def local_path(p: str) -> str:
    """Strip a ``file:`` scheme for code that needs an OS path (tests only)."""
    return p[5:] if p.startswith("file:") else p


__all__ = ["build_session", "apply_defaults", "work_dir", "scratch_path", "stored", "local_path", "DEFAULTS"]
