"""Cutting lineage in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder; one is made only in a local session that names none."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named is None and (not context.master.startswith("local") or context.master.startswith("local-cluster")):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        context.setCheckpointDir(named or "file://" + tempfile.mkdtemp(prefix="ledgerloom-"))
    return context.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """``df`` written to the checkpoint folder; Spark cleans it up with the session's references."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def keep(df: DataFrame) -> DataFrame:
    """``df`` as a written table that ``drop`` deletes as soon as nothing reads it."""
    path = f"{shared_dir(df.sparkSession)}/kept-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._kept_path = path
    return out


def drop(*frames: DataFrame) -> None:
    for df in frames:
        p = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df._kept_path)
        p.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(p, True)
