"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from functools import cache

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    # Stamps, purge predicates and timestamp text must not depend on the host's zone.
    "spark.sql.session.timeZone": "UTC",
    # Skewed joins, rebalanced writes and the empty-side shortcut in row_diff rely on AQE.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Size of the shuffle blocks that become one file of a rebalanced archive.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
}


def build_session(master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName("coldkeep")
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings to a session somebody else created."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and staged tables: `spark.checkpoint.dir`.

    A temporary folder stands in only in local mode, where driver and executors are one process.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = _local_scratch(spark.sparkContext.applicationId)
    return root.rstrip("/")


@cache
def _local_scratch(application: str) -> str:
    return tempfile.mkdtemp(prefix=f"coldkeep-{application}-")


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_root(spark)}/coldkeep/{label}-{uuid.uuid4().hex}"


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write once to the shared folder and read back: the plan is cut and survives lost executors."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def in_parallel(spark: SparkSession, task: Callable, items: Iterable, max_parallel: int) -> list:
    """Submit independent Spark jobs from a few driver threads; each job runs on the cluster."""
    with ThreadPoolExecutor(max_workers=max(1, max_parallel)) as pool:
        return list(pool.map(inheritable_thread_target(spark)(task), items))
