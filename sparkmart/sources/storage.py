"""Small text files and folders through the Hadoop file system Spark is configured with."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _fs(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    return _fs(spark, path).exists(_path(spark, path))


def list_names(spark: SparkSession, path: str) -> list[str]:
    if not exists(spark, path):
        return []
    return sorted(s.getPath().getName() for s in _fs(spark, path).listStatus(_path(spark, path)))


def read_text(spark: SparkSession, path: str) -> str:
    stream = _fs(spark, path).open(_path(spark, path))
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a new file; fails if it exists, so two writers cannot commit the same version.

    Each writer stages under a name of its own, so none can rename the other's text. The test and the
    rename are not one step on object stores without atomic rename; there a table needs a single writer.
    """
    fs, staged = _fs(spark, path), f"{path}.staged-{uuid.uuid4().hex}"
    stream = fs.create(_path(spark, staged), True)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()
    if fs.exists(_path(spark, path)) or not fs.rename(_path(spark, staged), _path(spark, path)):
        fs.delete(_path(spark, staged), False)
        raise RuntimeError(f"{path} was written by another writer")


def remove(spark: SparkSession, path: str) -> None:
    _fs(spark, path).delete(_path(spark, path), True)
