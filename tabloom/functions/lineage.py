"""Cut lineage by writing a table to the folder every executor shares."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_folder: tempfile.TemporaryDirectory | None = None


def shared_folder(spark: SparkSession) -> str:
    """The session's `spark.checkpoint.dir`; a throwaway folder only in local mode."""
    global _local_folder
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if _local_folder is None:
        _local_folder = tempfile.TemporaryDirectory(prefix="tabloom-")
    return _local_folder.name


def new_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder, private to this application."""
    app = spark.sparkContext.applicationId
    return f"{shared_folder(spark)}/tabloom/{app}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str = "table") -> DataFrame:
    """Write once and read back.

    The copy is columnar, so later passes read only the columns they use, and it
    is on shared storage, so a lost executor costs a re-read and no recomputation.
    """
    path = new_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clear_materialized(spark: SparkSession) -> None:
    """Delete everything this application materialised."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(
        f"{shared_folder(spark)}/tabloom/{spark.sparkContext.applicationId}"
    )
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
