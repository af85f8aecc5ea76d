"""Folder operations on whatever file system a path lives on (local, HDFS, object store)."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _file_system(spark, path)
    return fs.exists(target)


def child_names(spark: SparkSession, path: str) -> list[str]:
    fs, target = _file_system(spark, path)
    if not fs.exists(target):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(target))


def drop_folder(spark: SparkSession, path: str) -> bool:
    fs, target = _file_system(spark, path)
    return fs.delete(target, True)


def claim(spark: SparkSession, path: str) -> bool:
    """Make the folder ``path`` for the caller alone; False if another caller has made it or is making it.

    A folder with a token of the caller's own is moved to ``path``, which file systems refuse or, where
    they merge folders instead, leaves two tokens there. Only who finds no other token has won; of
    callers that meet in the same moment both may lose, never both win.
    """
    fs, target = _file_system(spark, path)
    if fs.exists(target):
        return False
    token = f"token-{uuid.uuid4().hex}"
    _, own = _file_system(spark, f"{path}.{token}")
    fs.mkdirs(own)
    fs.create(_file_system(spark, f"{path}.{token}/{token}")[1], False).close()
    try:
        fs.rename(own, target)
    except Py4JJavaError:
        pass  # refused
    names = [n for n in child_names(spark, path) if not n.startswith(".")]
    fs.delete(own, True)
    return names == [token]
