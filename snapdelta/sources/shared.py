"""Where jobs keep intermediate tables and stream checkpoints: the shared folder the cluster names."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder name under ``spark.checkpoint.dir``. Where that is unset, a temporary folder in local mode only."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
        root = tempfile.mkdtemp(prefix="snapdelta-")
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def settle(df: DataFrame, path: str) -> DataFrame:
    """Write a frame out and read it back: computed once, and kept when executors are lost."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of intermediate tables, wherever it is stored."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a folder is there, wherever it is stored."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def move(spark: SparkSession, source: str, target: str) -> bool:
    """Give a folder another name in the same store; false where the store cannot, or the target is there."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    files = path(source).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return not files.exists(path(target)) and files.rename(path(source), path(target))
