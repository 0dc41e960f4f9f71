"""Session settings the plans rely on, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# HotSpot compiles no method above 8000 bytes of bytecode; a stage that would generate one runs
# faster as separate operators than interpreted. Spark's own default is 65535.
HOTSPOT_LIMIT = "8000"
# Results depend on the time zone; the rest only steers the physical plan.
REQUIRED = {"spark.sql.session.timeZone": "UTC"}
RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.optimizer.windowGroupLimitThreshold": "1000",
    # Streamed sessions of one key are merged before they are shuffled.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
    "spark.sql.codegen.hugeMethodLimit": HOTSPOT_LIMIT,
    # Call-site capture for every column expression makes building wide plans slow.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the settings that change results, and the limit on generated methods if the cluster
    names none: wide decodes run many times longer interpreted. The rest stays as the cluster
    set it."""
    for key, value in REQUIRED.items():
        spark.conf.set(key, value)
    limit = "spark.sql.codegen.hugeMethodLimit"
    if spark.conf.get(limit, None) is None:
        spark.conf.set(limit, HOTSPOT_LIMIT)
    return spark


def local_session(app: str, cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        # Small trial data would otherwise be coalesced into one task.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="run-", dir="/tmp"))
    )
    for key, value in {**REQUIRED, **RECOMMENDED}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder below the cluster's shared checkpoint folder.

    Only a session that names no such folder (a local trial) falls back to /tmp.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        root = tempfile.mkdtemp(prefix="run-", dir="/tmp")
        spark.sparkContext.setCheckpointDir(root)
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"

