"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession

from lakezones.fixed_values import TARGET_FILE_BYTES

# Results depend on these.
RESULT_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.legacy.timeParserPolicy": "CORRECTED",
}

# Only speed and file layout depend on these.
PLAN_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

# File sizes of a cluster.
CLUSTER_SETTINGS = {
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(TARGET_FILE_BYTES),
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.files.maxPartitionBytes": str(TARGET_FILE_BYTES),
    "spark.sql.parquet.compression.codec": "snappy",
}
FEWEST_PARTITIONS = 200


def prepare_session(spark: SparkSession, shuffle_bytes: int | None = None) -> SparkSession:
    """Apply the settings the operators rely on.

    For a cluster, ``shuffle_bytes`` says how much the largest shuffle of the load moves, about
    the size of the table that is sorted or merged. Shuffles then start with partitions of the
    target file size, and smaller ones are merged at run time.
    """
    settings = RESULT_SETTINGS | PLAN_SETTINGS
    if shuffle_bytes is not None:
        partitions = max(shuffle_bytes // TARGET_FILE_BYTES, FEWEST_PARTITIONS)
        settings = settings | CLUSTER_SETTINGS | {
            "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions)
        }
    for name, value in settings.items():
        spark.conf.set(name, value)
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    A machine-local folder is only used when every task runs on this machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return _local_folder(spark.conf.get("spark.app.id", ""))


@cache
def _local_folder(application: str) -> str:
    return tempfile.mkdtemp(prefix=f"lakezones-{application}-")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that no other call gets."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Used where several actions need the same rows: they are computed once, later readers
    prune columns, and a lost executor costs no recomputation of what came before.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
