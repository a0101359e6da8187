"""Tables on the way, in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def folder(spark: SparkSession) -> str:
    """A new folder in the shared one that spark.checkpoint.dir names; where none is set, a local master (tests) gets a local one."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="spark-")
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """df as a table that is read again: its plan ends there, and a lost executor loses none of it."""
    path = folder(df.sparkSession)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._scratch_path = path
    return out


def remove(df: DataFrame) -> None:
    """Deletes a table that written() made and nothing will read again."""
    target = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df._scratch_path)
    target.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(target, True)
