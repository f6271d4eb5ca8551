"""Cutting lineage through shared storage.

``checkpoint()`` writes to the folder the cluster names in
``spark.checkpoint.dir``, so the rows outlive any executor.
"""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: More than a stored part takes: files of this size are read by one task each.
WHOLE_FILE = "1g"


def shared_dir(spark: SparkSession) -> str:
    """The session's shared folder; a local session without one gets a scratch folder."""
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        configured = tempfile.mkdtemp(prefix="larkspur-checkpoint-")
    context.setCheckpointDir(configured)
    return context.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Compute ``df`` once into shared storage and go on from there."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def release(spark: SparkSession) -> None:
    """Let Spark delete the files of shuffles and stored frames that nothing refers to.

    Spark deletes them once the driver's objects are collected, and a driver with room to
    spare collects too seldom: iterative work would keep the shuffles of every step on disk.
    """
    gc.collect()
    spark._jvm.System.gc()


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; it is removed when the session's JVM ends."""
    place = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(place)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    return place


def stored(df: DataFrame, name: str = "rows") -> DataFrame:
    """``df`` computed once into columnar files of the shared folder, smaller than those of ``cut``."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored_parts(df: DataFrame, name: str = "rows") -> DataFrame:
    """``stored``, read back in the parts it was written in, whatever the cluster and the sizes of files.

    Reading has a session of its own with the settings of ``df``'s, where files are neither joined nor split.
    """
    spark, session = df.sparkSession, df.sparkSession.newSession()
    for key, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(key):
            session.conf.set(key, value)
    for key in ("spark.sql.files.openCostInBytes", "spark.sql.files.maxPartitionBytes"):
        session.conf.set(key, WHOLE_FILE)
    path = shared_path(spark, name)
    df.write.parquet(path)
    return session.read.schema(df.schema).parquet(path)
