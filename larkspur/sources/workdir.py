"""Scratch space that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """This application's folder in the session's ``spark.checkpoint.dir``.

    Only a session on a local master may do without that setting (single-machine tests): it gets a local folder. Elsewhere
    executors would write to their own disks, so there a missing setting is an error.
    """
    base = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getConf().get(CHECKPOINT_CONF)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"{CHECKPOINT_CONF} must name a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="spark-larkspur-")
        spark.conf.set(CHECKPOINT_CONF, base)
    return f"{base.rstrip('/')}/larkspur-{spark.sparkContext.applicationId}"


def new_dir(spark: SparkSession, what: str) -> str:
    """An unused path below :func:`shared_dir`."""
    return f"{shared_dir(spark)}/{what}-{uuid.uuid4().hex}"


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is anything at ``path``, wherever it is stored."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder, wherever it is stored."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def clear(spark: SparkSession) -> None:
    """Delete all scratch tables of this application; for when every result that reads them has been stored."""
    remove(spark, shared_dir(spark))
