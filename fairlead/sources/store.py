"""Small files and listings on any storage that Spark reaches, through Hadoop's file systems."""

from __future__ import annotations

import json
from typing import Any

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    at, fs = _at(spark, path)
    return fs.exists(at)


def remove(spark: SparkSession, path: str) -> None:
    at, fs = _at(spark, path)
    fs.delete(at, True)


def make_folder(spark: SparkSession, path: str) -> None:
    at, fs = _at(spark, path)
    fs.mkdirs(at)


def files(spark: SparkSession, folder: str, end: str = "") -> list[str]:
    """Paths of all files under ``folder`` that end so, sorted, each as ``folder`` and what follows; none if it does not exist."""
    at, fs = _at(spark, folder)
    if not fs.exists(at):
        return []
    root = fs.makeQualified(at).toUri().getPath().rstrip("/")
    found, walk = [], fs.listFiles(at, True)
    while walk.hasNext():
        path = walk.next().getPath().toUri().getPath()
        if path.endswith(end):
            found.append(folder.rstrip("/") + path[len(root) :])
    return sorted(found)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Renames a file; one of the target's name is replaced."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    a, fs = _at(spark, source)
    b, _ = _at(spark, target)
    how = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 1)
    how[0] = getattr(hadoop, "Options$Rename").OVERWRITE
    hadoop.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration()).rename(a, b, how)


def read_json(spark: SparkSession, path: str) -> Any:
    """The content of a file, or None if there is none."""
    at, fs = _at(spark, path)
    if not fs.exists(at):
        return None
    stream = fs.open(at)
    try:
        return json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def write_json(spark: SparkSession, data: Any, path: str) -> None:
    """Under another name first, then renamed, so that the file is old or new but never half."""
    at, fs = _at(spark, path + ".part")
    fs.mkdirs(at.getParent())
    stream = fs.create(at, True)
    try:
        stream.write(bytearray(json.dumps(data, indent=2).encode()))
    finally:
        stream.close()
    move(spark, path + ".part", path)
