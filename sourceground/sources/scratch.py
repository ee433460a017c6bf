"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below ``spark.checkpoint.dir``; Hadoop deletes it when the driver ends.

    Where none is set, a local session takes a temporary folder; a cluster must set one.
    """
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="spark-scratch-"))
        root = sc.getCheckpointDir()
    path = f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    where = sc._jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(sc._jsc.hadoopConfiguration())
    fs.mkdirs(where)
    fs.deleteOnExit(where)
    return path


def exists(spark: SparkSession, path: str) -> bool:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def delete(spark: SparkSession, path: str) -> None:
    """Deletes a scratch table that nothing reads any more."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def stored(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write once as Parquet and read back: later steps reuse it, and a lost executor costs a reread."""
    path = path or scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def sent_if_small(stored_table: DataFrame, row_bytes: int, limit: int = 64 << 20) -> DataFrame:
    """A stored table, broadcast while its rows are proven to stay under ``limit`` bytes, so that the other side of a join does not move."""
    from pyspark.sql import functions as F

    return F.broadcast(stored_table) if stored_table.count() * row_bytes <= limit else stored_table


def stored_by(df: DataFrame, name: str, key: str, buckets: int) -> DataFrame:
    """Write once, bucketed and sorted by ``key``: joins of such tables with equal ``buckets`` on ``key`` shuffle nothing.

    The table's files lie in the shared folder; its entry is in the session's catalog.
    """
    path = scratch_path(df.sparkSession, name)
    table = f"{name.replace('-', '_')}_{path.rpartition('-')[2]}"
    df.write.bucketBy(buckets, key).sortBy(key).option("path", path).mode("overwrite").saveAsTable(table)
    return df.sparkSession.table(table)
