"""Session settings the library relies on.

The library never builds its own cluster configuration: on a cluster the
session comes from the platform and only the settings below are read from
it.  ``local_session`` exists for tests, the bench and the driver smoke run.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every query here assumes.  Time zone fixes the calendar day of
# ``to_date``; AQE re-plans joins and coalesces shuffle partitions at run time.
# Broadcasts: the planner's static choice from size *estimates* is off; a side
# is broadcast either after ``strata.operators.joins`` proved it small, or by
# AQE from the measured size of a finished shuffle stage.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "strata", driver_memory: str | None = None,
                  warehouse_dir: str | None = None) -> SparkSession:
    """A local session for tests and benchmarks (UI off, UTC, AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", driver_memory or os.environ.get("STRATA_DRIVER_MEMORY", "4g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if warehouse_dir:
        builder = builder.config("spark.sql.warehouse.dir", warehouse_dir)
    for key, value in REQUIRED_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def apply_required_conf(spark: SparkSession) -> None:
    """Set the runtime SQL settings the queries assume on an existing session."""
    for key, value in REQUIRED_CONF.items():
        spark.conf.set(key, value)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting one only when it is unset.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used
    as it is.  Only when it is unset (tests, local runs) a scratch folder
    is made for this process.  A Spark Connect session has no
    ``sparkContext``; there the server's setting is returned as it is.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: checkpointing is configured server-side
        return spark.conf.get("spark.checkpoint.dir", "") or ""
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir is not set: on a cluster it must name a folder all nodes share")
        configured = tempfile.mkdtemp(prefix="strata-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def stored(df: DataFrame) -> DataFrame:
    """``df`` written once as Parquet in the shared checkpoint folder and read
    again: as a checkpoint, compressed, for wide or many rows."""
    spark = df.sparkSession
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/stored-{uuid.uuid4().hex}"
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)
