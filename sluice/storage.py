"""Shared scratch folder and a few Hadoop file-system calls.

Everything goes through Hadoop's ``FileSystem`` so that the same code runs on
a local disk, HDFS or an object store.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_CHECKPOINT_DIR = "spark.checkpoint.dir"


def scratch_root(spark: SparkSession) -> str:
    """Folder for intermediate tables: the cluster's checkpoint folder.

    Only a local master may fall back to a temporary folder, since executors
    on other machines could not read it.
    """
    context = spark.sparkContext
    configured = spark.conf.get(_CHECKPOINT_DIR, None) or context.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {_CHECKPOINT_DIR} to a folder that all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="sluice-"))
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the scratch folder; nothing exists there yet."""
    return f"{scratch_root(spark)}/sluice-{name}-{uuid.uuid4().hex}"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Make ``DataFrame.checkpoint`` usable when the session names no folder."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(scratch_root(spark))


def _hadoop_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    return hadoop_path, hadoop_path.getFileSystem(conf)


def exists(spark: SparkSession, path: str) -> bool:
    hadoop_path, fs = _hadoop_path(spark, path)
    return fs.exists(hadoop_path)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the direct children of a folder; empty if there is none."""
    hadoop_path, fs = _hadoop_path(spark, path)
    if not fs.exists(hadoop_path):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(hadoop_path))


def delete(spark: SparkSession, path: str) -> None:
    hadoop_path, fs = _hadoop_path(spark, path)
    fs.delete(hadoop_path, True)


def read_text(spark: SparkSession, path: str) -> str:
    hadoop_path, fs = _hadoop_path(spark, path)
    stream = fs.open(hadoop_path)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def publish_text(spark: SparkSession, path: str, text: str) -> None:
    """Create a small file by writing a draft and renaming it; fails if the file already exists.

    The single writer of a table is what makes this safe: between the look and
    the rename, file systems without an atomic rename would let two writers through.
    """
    jvm = spark.sparkContext._jvm
    target, fs = _hadoop_path(spark, path)
    fs.mkdirs(target.getParent())
    draft = jvm.org.apache.hadoop.fs.Path(target.getParent(), f".draft-{uuid.uuid4().hex}")
    stream = fs.create(draft, False)
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()
    if fs.exists(target) or not fs.rename(draft, target):
        fs.delete(draft, False)
        raise FileExistsError(f"another writer already published {path}")
