"""Session helpers: UTC clock, shared folder, settings the plans rely on."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

# Adaptive execution re-plans on measured sizes: it coalesces small shuffle partitions, splits skewed ones in joins, and
# turns a shuffle join into a broadcast when a side proves small.  No fixed shuffle width is set here.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Noting the Python call site of every column expression takes longer than planning many of these queries.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def utc(spark: SparkSession) -> SparkSession:
    """Put the session clock to UTC, which every time operator expects."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def build(app: str = "firnflow", master: str | None = None, **options: str) -> SparkSession:
    """Session with the settings above; a cluster's own master and sizes stay untouched unless given."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **options}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """New path below the folder the cluster shares (``spark.checkpoint.dir``).

    Where that is unset, a local session, which is one machine, takes a folder beside its warehouse; a cluster is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_work"
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
