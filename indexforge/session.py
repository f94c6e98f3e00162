"""Session helpers: one place for the settings the jobs rely on."""

from __future__ import annotations

import os
import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def build_session(master: str | None = None, app_name: str = "indexforge",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with UTC time, AQE and no UI.

    On a cluster leave ``master`` unset and size ``shuffle_partitions`` to the
    data (≈ input bytes / 128 MB); AQE coalesces small partitions at runtime and
    splits skewed ones in sort-merge joins.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    Read from ``spark.checkpoint.dir`` (or the context's checkpoint dir).  Only
    when neither is set -- local runs and tests -- a fresh folder is created and
    registered, so that ``DataFrame.checkpoint()`` works as well.
    """
    sc = spark.sparkContext
    root = sc.getCheckpointDir()
    if not root:
        root = spark.conf.get("spark.checkpoint.dir", None)
        if not root:
            if not sc.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/S3/...) "
                                   "for checkpoints and intermediate tables")
            root = tempfile.mkdtemp(prefix="indexforge-ckpt-")
        sc.setCheckpointDir(root)
        root = sc.getCheckpointDir() or root
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique sub-folder of the shared checkpoint root."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"


def _file_system(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether the store holds ``path``; a store that cannot be reached raises."""
    fs, p = _file_system(spark, path)
    return fs.exists(p)


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Delete a folder that ``scratch_path`` named, once nothing reads it any more."""
    if not path.startswith(checkpoint_root(spark).rstrip("/") + "/"):
        raise ValueError(f"{path} is not a scratch folder of this session")
    fs, p = _file_system(spark, path)
    fs.delete(p, True)


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder that the caller wrote itself."""
    fs, p = _file_system(spark, path)
    fs.delete(p, True)


def replace_folder(spark: SparkSession, written: str, path: str) -> None:
    """Put the complete folder ``written`` in the place of ``path``."""
    fs, target = _file_system(spark, path)
    fs.delete(target, True)
    if not fs.rename(_file_system(spark, written)[1], target):
        raise OSError(f"{written} could not be renamed to {path}")


def write_small(spark: SparkSession, path: str, text: str, overwrite: bool = True) -> bool:
    """Write a small text file; False if it is there and must not be overwritten."""
    fs, p = _file_system(spark, path)
    if not overwrite and fs.exists(p):
        return False
    try:
        out = fs.create(p, overwrite)
    except Py4JJavaError as e:
        if not overwrite and fs.exists(p):
            return False  # another job was first
        raise OSError(f"{path} could not be written") from e
    out.write(bytearray(text.encode()))
    out.close()
    return True


def read_small(spark: SparkSession, path: str) -> str | None:
    """The text of a small file, or None if there is none."""
    fs, p = _file_system(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def names_in(spark: SparkSession, path: str) -> list[str]:
    """The names in a folder, sorted; none if it is not there."""
    fs, p = _file_system(spark, path)
    return sorted(x.getPath().getName() for x in fs.listStatus(p)) if fs.exists(p) else []


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme so Python file APIs can use a local path."""
    if path.startswith("file:"):
        path = path[len("file:"):]
        while path.startswith("//"):
            path = path[1:]
    return os.path.abspath(path)
