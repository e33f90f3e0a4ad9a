"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


# Spark's setting that drops a query's shuffle files as soon as the query has ended, not when the driver collects garbage.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(app: str = "trolley", cpus: int | str = "*", shuffle_partitions: int = 8,
                  driver_memory: str = "12g") -> SparkSession:
    """Local session for tests and benchmarks; on a cluster use the one submitted to."""
    return (
        SparkSession.builder.master(f"local[{cpus}]").appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", driver_memory)
        .config("spark.ui.enabled", "false")
        .config(SHUFFLE_CLEANUP, "true")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by the cluster.

    Only a purely local session without ``spark.checkpoint.dir`` falls back to a
    temporary folder; a cluster without one is an error, because a machine-local
    folder would be lost with its executor.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    context = spark.sparkContext
    if context.getCheckpointDir():
        return context.getCheckpointDir()
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="run-", dir="/tmp"))
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/trolley/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage by writing the table to the shared folder and reading it back.

    Used where a later step must see exactly the same rows in the same order slots
    more than once (range partition bounds are sampled, so a re-run could move them).
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
