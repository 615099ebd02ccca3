"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import os
import tempfile
from collections.abc import Sequence
from urllib.parse import unquote, urlparse
from uuid import uuid4

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``.

    A local session without that setting gets a temporary folder of its own; a
    cluster must name one, because a machine-local folder would be lost with its
    machine and unseen by the others.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    context = spark.sparkContext
    if not context.getCheckpointDir():
        if not context.master.startswith("local"):
            raise RuntimeError("Set spark.checkpoint.dir to a folder shared by the cluster.")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tablewright-"))
    return context.getCheckpointDir()


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark).rstrip('/')}/tablewright/{name}-{uuid4().hex}"


def stage(df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> str:
    """Write a table once, so that later jobs read columns instead of redoing work."""
    path = new_path(df.sparkSession, name)
    df.write.partitionBy(*partition_by).parquet(path)
    return path


def drop_staged(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def folder_exists(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def create_once(spark: SparkSession, path: str, text: str) -> bool:
    """Create a file with a text unless there is one; of many callers only one gets True.

    Local folders have an atomic call of their own; elsewhere the storage decides, as HDFS and
    object stores with conditional writes do.
    """
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if system.getScheme() == "file":
        local = unquote(urlparse(path).path) if path.startswith("file:") else path
        os.makedirs(os.path.dirname(local), exist_ok=True)
        try:
            with open(local, "x") as file:
                file.write(text)
        except FileExistsError:
            return False
        return True
    try:
        out = system.create(folder, False)
    except Py4JJavaError as error:
        if system.exists(folder):
            return False
        raise error
    out.write(bytearray(text, "utf-8"))
    out.close()
    return True
