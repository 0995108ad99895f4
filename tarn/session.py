"""The session that the library expects: UTC, adaptive execution, Arrow batches."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def get_session(app: str = "tarn", master: str | None = None, **conf: str) -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    return b.config(map={**CONF, **conf}).getOrCreate()


def cut_lineage(df):
    """``df`` checkpointed to the shared folder that the cluster names; a local one only in local mode (tests)."""
    spark = df.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        found = spark.conf.get("spark.checkpoint.dir", None)
        if not found:
            if not spark.sparkContext.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            found = tempfile.mkdtemp(prefix="spark-")
        spark.sparkContext.setCheckpointDir(found)
    return df.checkpoint()
