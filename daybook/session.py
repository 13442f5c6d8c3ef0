"""Session settings the package relies on."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from daybook.errors import ParamError

#: Settings to start a session with. Sizes are per task, so they hold on any
#: number of executors; adaptive execution merges small shuffle partitions and
#: splits large ones at run time.
RECOMMENDED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    # The JVM never compiles a method beyond 8000 bytes of bytecode. A projection
    # that parses a whole row easily generates one; with this limit Spark splits
    # it into small methods instead and it runs about twice as fast.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}

_WHILE_RUNNING = ("spark.sql.codegen.hugeMethodLimit",)


@contextmanager
def tuned(spark: SparkSession) -> Iterator[None]:
    """Apply the settings that matter for parsing while the block runs jobs."""
    before = {key: spark.conf.get(key) for key in _WHILE_RUNNING}
    for key in _WHILE_RUNNING:
        spark.conf.set(key, RECOMMENDED_CONF[key])
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def require_utc(spark: SparkSession) -> None:
    """Zone-less timestamps and business dates are only right in a UTC session."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "Z", "GMT", "+00:00"):
        raise ParamError(f"spark.sql.session.timeZone must be UTC, not {zone}")


def shared_folder(spark: SparkSession) -> str:
    """Folder for intermediate tables that every executor can reach.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session, where
    driver and executors share one machine, gets a temporary folder instead.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ParamError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="daybook-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder; never reused, so re-runs cannot clash."""
    return f"{shared_folder(spark)}/daybook-{label}-{uuid.uuid4().hex}"


def settle(df: DataFrame, label: str) -> DataFrame:
    """Write a frame to the shared folder and go on from the written copy.

    Used where several branches read the same result: it is computed once, and
    losing an executor later costs a re-read instead of the whole lineage. Spark
    also knows the size of the copy, so it can choose the join strategy by it.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
