"""Where intermediate tables and files go: the folder that the cluster shares."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_path(spark: SparkSession, tag: str) -> str:
    """A fresh path under spark.checkpoint.dir; where that is unset, one machine takes a
    temporary folder, and a cluster has none."""
    top = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not top:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="spark-", dir="/tmp"))
        top = spark.sparkContext.getCheckpointDir()
    return f"{top.rstrip('/')}/loomseq-{tag}-{uuid.uuid4().hex}"


#: Tables written by stored(), by application.
_WRITTEN: dict[str, list[str]] = {}


def _place(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def stored(spark: SparkSession, df: DataFrame, tag: str) -> DataFrame:
    """df, written to the shared folder and read back. The table stays as long as frames may
    read it: until release(), or the end of the application, which deletes it."""
    path = shared_path(spark, tag)
    df.write.parquet(path)
    files, at = _place(spark, path)
    files.deleteOnExit(at)
    _WRITTEN.setdefault(spark.sparkContext.applicationId, []).append(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> int:
    """Delete the tables that stored() wrote in this application so far, for sessions that live
    long; frames that read them must be used up. Returns their number."""
    paths = _WRITTEN.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        files, at = _place(spark, path)
        files.delete(at, True)
        files.cancelDeleteOnExit(at)
    return len(paths)
