"""Session settings the engine expects, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Adaptive execution does three jobs here: it picks broadcast joins from measured
# sizes, splits skewed join partitions, and coalesces small shuffle partitions.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # register codes such as 0000 and periods such as 202301 must stay text
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
}


def apply_conf(spark: SparkSession) -> SparkSession:
    """Set the engine's runtime SQL settings on an existing session."""
    for key, value in SESSION_CONF.items():
        spark.conf.set(key, value)
    return spark


def build_session(app_name: str = "fiscalgrove", master: str | None = None,
                  extra: dict[str, str] | None = None, input_bytes: int | None = None) -> SparkSession:
    """``input_bytes``: the volume the session is for; it sets the number of initial shuffle partitions."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **(sized_conf(input_bytes) if input_bytes else {}), **(extra or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def sized_conf(input_bytes: int, partition_bytes: int = 128 << 20) -> dict[str, str]:
    """Shuffle settings for a volume of data: enough initial partitions to fit in memory.

    Adaptive execution merges the ones that turn out small, so too many cost little, while too
    few spill; 100 TB need several hundred thousand.
    """
    parts = max(200, -(-input_bytes // partition_bytes))
    return {"spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes)}


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder below the cluster's shared checkpoint folder.

    ``spark.checkpoint.dir`` names storage every executor can reach. Only where it
    is unset and the master is local (tests) is a temporary folder of this machine used.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.conf.get("spark.master", "")
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="fiscalgrove-")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


@contextmanager
def freed(spark: SparkSession) -> Iterator[None]:
    """Queries that are run inside delete their shuffle files as they end. Only for frames that are run once: of one
    that is run again Spark makes the files again."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)
