"""Shared folder and file-system helpers."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import AbstractContextManager, contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own; on a
    cluster a machine-local folder would be lost with its executor, so there the
    missing setting is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        folder = tempfile.mkdtemp(prefix="tidemark-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh, unused path below the shared folder."""
    return f"{shared_folder(spark)}/tidemark/{label}-{uuid.uuid4().hex}"


def _file_system(spark: SparkSession, path: str):
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _file_system(spark, path)
    return fs.exists(hadoop_path)


def delete_path(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _file_system(spark, path)
    return fs.delete(hadoop_path, True)


def read_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Read a parquet folder, or give an empty frame before its first write."""
    if path_exists(spark, path):
        return spark.read.schema(schema).parquet(path)
    return spark.createDataFrame([], StructType.fromDDL(schema))


@contextmanager
def session_setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """Set a session option for one block and put the old value back."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def many_folders(spark: SparkSession) -> AbstractContextManager[None]:
    """For a rebalanced write into many folders. Each folder gets a file of its own
    whichever task writes it, so packing small shuffle partitions into one task would
    save no file and only take the parallelism away. Hot partitions are still split."""
    return session_setting(spark, "spark.sql.adaptive.coalescePartitions.enabled", "false")


def file_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, sorted; none if there is no such folder."""
    fs, hadoop_path = _file_system(spark, path)
    if fs.getUri().getScheme() == "file":
        target = hadoop_path.toUri().getPath()
        return sorted(n for n in os.listdir(target) if not n.endswith(".crc")) if os.path.isdir(target) else []
    if not fs.exists(hadoop_path):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(hadoop_path))


def create_file(spark: SparkSession, path: str, content: bytes) -> bool:
    """Create a file with its content unless there is one of that name; whether it was created.

    The file system decides who comes first, so of several callers exactly one gets True. HDFS does this atomically; an object
    store has to support conditional writes for it. Hadoop's local file system only looks before it creates, so there
    the operating system is asked for a hard link.
    """
    fs, hadoop_path = _file_system(spark, path)
    if fs.getUri().getScheme() == "file":
        target = hadoop_path.toUri().getPath()
        os.makedirs(os.path.dirname(target), exist_ok=True)
        hidden = f"{os.path.dirname(target)}/_{uuid.uuid4().hex}"
        with open(hidden, "wb") as file:
            file.write(content)
        try:
            os.link(hidden, target)
        except FileExistsError:
            return False
        finally:
            os.remove(hidden)
        return True
    try:
        stream = fs.create(hadoop_path, False)
    except Exception:
        if fs.exists(hadoop_path):
            return False
        raise
    stream.write(bytearray(content))
    stream.close()
    return True


def read_file(spark: SparkSession, path: str) -> bytes:
    """A small file's content."""
    fs, hadoop_path = _file_system(spark, path)
    stream = fs.open(hadoop_path)
    try:
        return bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
    finally:
        stream.close()


def modified_at(spark: SparkSession, path: str) -> float:
    """Epoch seconds of a file's last change."""
    fs, hadoop_path = _file_system(spark, path)
    return fs.getFileStatus(hadoop_path).getModificationTime() / 1000


def put_file(spark: SparkSession, path: str, content: bytes) -> None:
    """Write a small file so that it appears whole, under a name that is new."""
    fs, hadoop_path = _file_system(spark, path)
    hidden = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(hadoop_path.getParent(), f"_{hadoop_path.getName()}")
    stream = fs.create(hidden, True)
    stream.write(bytearray(content))
    stream.close()
    if not fs.rename(hidden, hadoop_path):
        raise OSError(f"{path} could not be put in place")


def move_path(spark: SparkSession, source: str, target: str) -> None:
    fs, hadoop_path = _file_system(spark, source)
    if not fs.rename(hadoop_path, spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target)):
        raise OSError(f"{source} could not become {target}")
