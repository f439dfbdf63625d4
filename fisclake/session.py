"""Session settings the library expects, and the shared folder its jobs may write to."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    # Several times the size of one shuffle block: fewer, fuller files behind a rebalanced write.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # `0512` is a year-month, not the number 512.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.parquet.compression.codec": "lz4",
}


def build_session(app: str = "fisclake", master: str | None = None, **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``, which every executor must be able to reach.

    Only a local session may do without that setting; on a cluster a folder of one machine is of no use.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="fisclake-")
    return f"{base.rstrip('/')}/fisclake/{name}-{uuid.uuid4().hex[:12]}"
