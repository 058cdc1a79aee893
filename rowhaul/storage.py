"""Shared scratch space and the few small driver-side file actions the jobs need.

Everything goes through the Hadoop filesystem API, so paths may be on any
filesystem the cluster mounts. Only markers of a few hundred bytes pass
through here; records never do.
"""

from __future__ import annotations

import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import SparkSession


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can see: ``spark.checkpoint.dir`` when the cluster names one.

    Only a local session (one machine by definition) may fall back to a
    temporary folder of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    root = tempfile.mkdtemp(prefix="rowhaul-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def new_folder(spark: SparkSession, label: str) -> str:
    """A path below the shared root that nothing else uses (not created yet)."""
    return f"{shared_root(spark)}/rowhaul/{label}-{uuid.uuid4().hex}"


@lru_cache(maxsize=4)
def _hadoop(jvm):
    """The classes used here. To find one by name takes several calls to the JVM, which a transfer of many commits would repeat."""
    fs = jvm.org.apache.hadoop.fs
    return fs.Path, fs.FileContext, fs.Options.Rename


def _path(spark: SparkSession, path: str):
    return _hadoop(spark._jvm)[0](path)


def _fs(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    return _fs(spark, path).exists(_path(spark, path))


def delete(spark: SparkSession, path: str) -> None:
    """Remove ``path`` and what is below it; a missing path is fine."""
    _fs(spark, path).delete(_path(spark, path), True)


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Sorted child names of a folder; empty when the folder is missing."""
    if not exists(spark, path):
        return []
    return sorted(s.getPath().getName() for s in _fs(spark, path).listStatus(_path(spark, path)))


def read_small(spark: SparkSession, path: str) -> str:
    """Text of a marker file."""
    stream = _fs(spark, path).open(_path(spark, path))
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()


def write_small(spark: SparkSession, path: str, text: str) -> None:
    """Replace a marker file in one step: write beside it, then rename over it."""
    source, target = _path(spark, f"{path}.tmp"), _path(spark, path)
    configuration = spark.sparkContext._jsc.hadoopConfiguration()
    files = target.getFileSystem(configuration)
    stream = files.create(source, True)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()
    if not files.exists(target) and files.rename(source, target):
        return
    _, contexts, rename = _hadoop(spark._jvm)
    flags = spark.sparkContext._gateway.new_array(rename, 1)
    flags[0] = rename.OVERWRITE
    scheme = target.toUri().getScheme()
    context = contexts.getFileContext(target.toUri(), configuration) if scheme else contexts.getFileContext(configuration)
    context.rename(source, target, flags)
