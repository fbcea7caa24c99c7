"""Small files on the shared file system (local, HDFS or object store), through Hadoop's file system API."""

from __future__ import annotations

import json

from pyspark.sql import SparkSession


def _path(spark: SparkSession, uri: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(uri)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, uri: str) -> bool:
    path, fs = _path(spark, uri)
    return fs.exists(path)


def names(spark: SparkSession, uri: str) -> list[str]:
    """Names in a folder, sorted; none if it does not exist. Hidden and temporary names are left out."""
    path, fs = _path(spark, uri)
    if not fs.exists(path):
        return []
    found = [s.getPath().getName() for s in fs.listStatus(path)]
    return sorted(n for n in found if not n.startswith((".", "_")))


def read_json(spark: SparkSession, uri: str):
    path, fs = _path(spark, uri)
    size = fs.getFileStatus(path).getLen()
    stream = fs.open(path)
    try:
        data = bytearray(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream, size))
    finally:
        stream.close()
    return json.loads(bytes(data).decode())


def write_json(spark: SparkSession, uri: str, value, replace: bool = False) -> None:
    """Write under a temporary name, then rename, so that a reader sees all of it or nothing.

    Without ``replace`` an existing file stays and the call fails.
    """
    path, fs = _path(spark, uri)
    folder, _, name = uri.rpartition("/")
    temporary, _ = _path(spark, f"{folder}/.{name}.tmp")
    fs.mkdirs(path.getParent())
    out = fs.create(temporary, True)
    out.write(bytearray(json.dumps(value, sort_keys=True).encode()))
    out.close()
    if fs.exists(path):
        if not replace:
            raise FileExistsError(uri)
        fs.delete(path, False)
    if not fs.rename(temporary, path):
        raise OSError(f"cannot commit {uri}")


def remove_folder(spark: SparkSession, uri: str) -> None:
    path, fs = _path(spark, uri)
    fs.delete(path, True)
