"""Session defaults for local runs; a cluster's own settings always win."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(app: str = "folioloom", cpus: int | None = None, **conf: str) -> SparkSession:
    """A local session with ``cpus`` threads (all by default) and as many shuffle partitions."""
    n = cpus or os.cpu_count() or 4
    builder = SparkSession.builder.appName(app).master(f"local[{n}]")
    for key, value in {**DEFAULTS, "spark.sql.shuffle.partitions": str(n), "spark.driver.memory": "8g", **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session; one is set only where the session names none."""
    context = spark.sparkContext
    current = context._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if configured is None:
        # Only a session on one machine may do without the setting: others' executors don't see this folder.
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        configured = "file:///tmp/checkpoints/folioloom"
    context.setCheckpointDir(configured)
    return configured


def stored(df: DataFrame, name: str = "table") -> DataFrame:
    """``df`` written to the shared folder and read again: worked out once, and read by column from then on."""
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
