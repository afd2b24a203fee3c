"""Scratch locations on the file system the whole cluster shares."""

from __future__ import annotations

import tempfile
import time
import uuid

from py4j.java_gateway import JavaObject
from pyspark.sql import SparkSession


FOLDER = "skerry"


def scratch(spark: SparkSession, label: str) -> str:
    """A fresh path under `spark.checkpoint.dir`; nothing is created yet.

    A local-mode session without that setting falls back to the machine's
    temporary folder. A cluster without it is an error: executors on other
    hosts could not see such a folder.
    """
    return f"{_base(spark)}/{label}-{uuid.uuid4().hex}"


def _base(spark: SparkSession) -> str:
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.gettempdir()
    return f"{base.rstrip('/')}/{FOLDER}"


def sweep(spark: SparkSession, hours: float) -> list[str]:
    """Remove scratch folders that were made more than `hours` ago, and name them.

    Results of queries read their scratch tables when they are used, so choose a
    time beyond which none is.
    """
    fs, target = hadoop_path(spark, _base(spark))
    if not fs.exists(target):
        return []
    limit = (time.time() - hours * 3600) * 1000
    old = [s.getPath() for s in fs.listStatus(target) if s.getModificationTime() < limit]
    for path in old:
        fs.delete(path, True)
    return sorted(p.getName() for p in old)


def hadoop_path(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    """The Hadoop file system owning `path`, and the path object."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def make_dirs(spark: SparkSession, path: str) -> str:
    fs, target = hadoop_path(spark, path)
    fs.mkdirs(target)
    return path


def write_bytes(spark: SparkSession, path: str, body: bytes) -> None:
    """A small file with the given bytes."""
    fs, target = hadoop_path(spark, path)
    out = fs.create(target)
    out.write(bytearray(body))
    out.close()


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, target = hadoop_path(spark, path)
    return bool(fs.exists(target))


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a file or a folder with all it holds."""
    fs, target = hadoop_path(spark, path)
    fs.delete(target, True)


def child_names(spark: SparkSession, path: str, prefix: str) -> set[str]:
    """Names of what lies in a folder, if they start with `prefix`; none if there is no such folder."""
    fs, target = hadoop_path(spark, path)
    if not fs.exists(target):
        return set()
    return {name for s in fs.listStatus(target) if (name := s.getPath().getName()).startswith(prefix)}


def pin(spark: SparkSession) -> SparkSession:
    """Make sure `DataFrame.checkpoint()` has its shared directory."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(scratch(spark, "checkpoints"))
    return spark
