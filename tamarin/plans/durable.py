"""Intermediate tables that survive the loss of executors.

A lineage cut goes to the folder named in ``spark.checkpoint.dir``, which every executor of a cluster shares. Only where that
setting is unset and the session runs on one machine (tests) a temporary folder takes its place; on a cluster that is an error.
"""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The session's shared folder; one of our own only where a local session names none."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        at = "file://" + tempfile.mkdtemp(prefix="tamarin-")
        spark.conf.set("spark.checkpoint.dir", at)
    return at.rstrip("/")


def _remove(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    except Exception:  # noqa: BLE001 - the session is gone, the folder's owner cleans up
        pass


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, removed with all it holds when the interpreter ends."""
    path = f"{shared_dir(spark)}/tamarin/{name}-{uuid.uuid4().hex}"
    atexit.register(_remove, spark, path)
    return path


def durable(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` once as parquet into the shared folder and return a scan of it.

    Used where a result is read more than once: later failures re-read the table and never recompute the stages before it. The
    table is removed when the interpreter ends.
    """
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """A table in fewer partitions than the session has cores, which is a small one, is dealt out to all of them; any other is left
    as it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df._jdf.queryExecution().toRdd().getNumPartitions() < cores else df
